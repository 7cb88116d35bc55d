"""Column layouts of the three layers.

Bronze is read with an explicit all-string schema (never inferred), Silver
and Gold have fixed layouts. Column order here is the order the tables are
written in.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze: one flat JSON object per line, every field kept as text.
BRONZE_COLUMNS = [
    "event_id",
    "user_id",
    "session_id",
    "event_timestamp",
    "ingestion_timestamp",
    "event_type",
    "product_id",
    "device_type",
    "platform",
    "traffic_source",
    "country",
]
BRONZE = T.StructType([T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS])

# Silver event fact, grain event_id, partitioned by event_date.
SILVER_COLUMNS = [
    "event_id",
    "event_timestamp",
    "event_date",
    "event_type",
    "user_id",
    "ingestion_timestamp",
    "platform",
    "product_id",
    "session_id",
    "traffic_source",
    "country",
    "device_type",
]
SILVER_LOAD_TS = "data_transformed_ingested_timestamp"
# Mandatory Silver columns (fixed values of the reference).
SILVER_MANDATORY = [
    "event_id",
    "event_timestamp",
    "event_type",
    "ingestion_timestamp",
    "session_id",
    "user_id",
]
SILVER_DDL = """
    event_id string NOT NULL,
    event_timestamp timestamp_ntz NOT NULL,
    event_type string NOT NULL,
    user_id string NOT NULL,
    ingestion_timestamp timestamp_ntz,
    platform string,
    product_id string,
    session_id string NOT NULL,
    traffic_source string,
    country string,
    device_type string,
    data_transformed_ingested_timestamp timestamp,
    event_date date NOT NULL
"""

# Fill values for optional dimensions (fixed values of the reference).
FILL_DEFAULTS = {
    "country": "unknown",
    "device_type": "unknown",
    "platform": "others",
    "traffic_source": "others",
}

# Funnel stages (fixed values of the reference, lower-case after cleaning).
PAGE_VIEW = "page_view"
PRODUCT_VIEW = "product_view"
ADD_TO_CART = "add_to_cart"
CHECKOUT = "checkout"
PURCHASE = "purchase"


class GoldSpec:
    """Name, grain, surrogate-key inputs and output columns of one Gold table."""

    def __init__(self, name, key_column, grain, key_inputs, measures, rates):
        self.name = name
        self.key_column = key_column
        self.grain = list(grain)
        self.key_inputs = list(key_inputs)
        self.measures = list(measures)
        self.rates = list(rates)

    @property
    def columns(self):
        return [self.key_column, *self.grain, *self.measures, *self.rates]

    def ddl(self):
        types = {"event_date": "date"}
        parts = []
        for c in self.columns:
            if c in self.measures:
                t = "bigint"
            elif c in self.rates:
                t = "double"
            else:
                t = types.get(c, "string")
            parts.append(f"{c} {t}")
        return ",\n    ".join(parts)


# The four Gold tables: name, key column, grain, surrogate-key inputs,
# measures and rates, in output order (fixed values of the reference).
BUSINESS = GoldSpec(
    "business_metrics",
    "business_metric_key",
    ["event_date", "country"],
    ["event_date", "country"],
    ["total_users", "total_sessions", "total_events", "product_viewers",
     "cart_users", "checkout_users", "purchasers"],
    ["view_to_cart_rate", "cart_to_checkout_rate", "checkout_to_purchase_rate"],
)
FUNNEL = GoldSpec(
    "marketing_funnel",
    "marketing_funnel_key",
    ["event_date", "country"],
    ["event_date", "country"],
    ["visitors", "product_viewers", "cart_users", "checkout_users", "purchasers"],
    ["view_to_cart_rate", "cart_to_checkout_rate", "view_to_purchase_rate",
     "checkout_to_purchase_rate"],
)
CHANNEL = GoldSpec(
    "marketing_channel",
    "marketing_channel_key",
    ["event_date", "country", "traffic_source"],
    ["event_date", "country", "traffic_source"],
    ["total_users", "total_sessions", "total_events", "product_viewers",
     "cart_users", "checkout_users", "purchasers"],
    ["purchase_conversion_rate", "events_per_session"],
)
PRODUCT = GoldSpec(
    "product_performance",
    "product_performance_key",
    ["event_date", "country", "product_id"],
    # the product table hashes product before country
    ["event_date", "product_id", "country"],
    ["unique_product_viewers", "total_product_views", "unique_cart_users",
     "unique_checkout_users", "unique_purchasers"],
    ["purchase_rate", "avg_views_per_viewer"],
)
GOLD_SPECS = {s.name: s for s in (BUSINESS, FUNNEL, CHANNEL, PRODUCT)}
