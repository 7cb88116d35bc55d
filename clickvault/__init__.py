"""clickvault: a Spark-native clickstream medallion engine (bronze -> Silver -> Gold)."""

__version__ = "0.1.0"
