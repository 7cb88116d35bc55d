"""The analyst questions as Spark SQL over registered views.

Analysts query the tables with SQL; ``register_views`` exposes Silver and
the four Gold tables (or any DataFrames standing in for them) under stable
view names, and ``ANALYST_SQL`` holds one statement per question. The
statements follow the same plans as ``clickvault.plans.analyst``
(aggregate-based top-1, a scalar subquery for the averages) and return the
same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_NAMES = [
    "silver",
    "business_metrics",
    "marketing_funnel",
    "marketing_channel",
    "product_performance",
]


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """``createOrReplaceTempView`` for each given frame (keys from VIEW_NAMES)."""
    for name, df in frames.items():
        if name not in VIEW_NAMES:
            raise KeyError(f"unknown view {name!r}")
        df.createOrReplaceTempView(name)


def register_table_views(spark: SparkSession, database: str) -> None:
    """Views over the catalog tables of ``database``."""
    from clickvault.plans.tables import SILVER_TABLE

    frames = {"silver": spark.table(f"{database}.{SILVER_TABLE}")}
    for name in VIEW_NAMES[1:]:
        frames[name] = spark.table(f"{database}.{name}")
    register_views(spark, frames)


def _ranked(table: str, key: str, measure: str, out: str) -> str:
    return (
        f"SELECT {key}, sum({measure}) AS {out} FROM {table} "
        f"GROUP BY {key} ORDER BY {out} DESC, {key}"
    )


ANALYST_SQL = {
    "top_products_by_purchases": """
        SELECT product_id, sum(unique_purchasers) AS total_purchasers
        FROM product_performance GROUP BY product_id
        ORDER BY total_purchasers DESC, product_id LIMIT 10""",
    "best_product_rate_per_day": """
        SELECT event_date, b.product_id, b.country, b.purchase_rate, b.unique_purchasers,
               b.unique_product_viewers
        FROM (SELECT event_date,
                     min_by(named_struct('product_id', product_id, 'country', country,
                                         'purchase_rate', purchase_rate,
                                         'unique_purchasers', unique_purchasers,
                                         'unique_product_viewers', unique_product_viewers),
                            named_struct('r', -purchase_rate, 'p', -unique_purchasers,
                                         'product_id', product_id, 'country', country)) AS b
              FROM product_performance GROUP BY event_date)""",
    "high_views_low_purchases": """
        WITH per AS (
          SELECT product_id, sum(total_product_views) AS total_views,
                 sum(unique_purchasers) AS total_purchasers
          FROM product_performance GROUP BY product_id)
        SELECT * FROM per
        WHERE total_views >= (SELECT avg(total_views) FROM per)
          AND total_purchasers < (SELECT avg(total_purchasers) FROM per)""",
    "users_by_source": _ranked("marketing_channel", "traffic_source", "total_users",
                               "total_users"),
    "purchasers_by_source": _ranked("marketing_channel", "traffic_source", "purchasers",
                                    "purchasers"),
    "sessions_by_source": _ranked("marketing_channel", "traffic_source", "total_sessions",
                                  "total_sessions"),
    "users_by_source_exact": """
        SELECT traffic_source, count(DISTINCT user_id) AS total_users FROM silver
        GROUP BY traffic_source ORDER BY total_users DESC, traffic_source""",
    "sessions_by_source_exact": """
        SELECT traffic_source, count(DISTINCT session_id) AS total_sessions FROM silver
        GROUP BY traffic_source ORDER BY total_sessions DESC, traffic_source""",
    "funnel_users_per_day": """
        SELECT event_date, sum(visitors) AS visitors, sum(product_viewers) AS product_viewers,
               sum(cart_users) AS cart_users, sum(checkout_users) AS checkout_users,
               sum(purchasers) AS purchasers
        FROM marketing_funnel GROUP BY event_date""",
    "funnel_rates_per_day": """
        SELECT event_date,
          CASE WHEN v > 0 THEN round(c * 100 / v, 2) ELSE 0.0 END AS view_to_cart_rate,
          CASE WHEN c > 0 THEN round(k * 100 / c, 2) ELSE 0.0 END AS cart_to_checkout_rate,
          CASE WHEN v > 0 THEN round(p * 100 / v, 2) ELSE 0.0 END AS view_to_purchase_rate,
          CASE WHEN k > 0 THEN round(p * 100 / k, 2) ELSE 0.0 END AS checkout_to_purchase_rate
        FROM (SELECT event_date, sum(product_viewers) AS v, sum(cart_users) AS c,
                     sum(checkout_users) AS k, sum(purchasers) AS p
              FROM marketing_funnel GROUP BY event_date)""",
    "days_by_purchasers": _ranked("business_metrics", "event_date", "purchasers", "purchasers"),
    "late_arrival_profile": """
        SELECT event_date, datediff(to_date(ingestion_timestamp), event_date) AS days_late,
               count(1) AS events
        FROM silver GROUP BY 1, 2""",
}


def run(spark: SparkSession, question: str) -> DataFrame:
    return spark.sql(ANALYST_SQL[question])
