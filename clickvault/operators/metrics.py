"""Stand-alone aggregate operators: distinct users/sessions, stage users,
view counts, and the two rate forms on an arbitrary grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import coalesced_rate, guarded_rate, surrogate_key
from clickvault.operators.gold import STAGES, _user_grain
from clickvault.schemas import CHECKOUT, PRODUCT_VIEW, PURCHASE


def distinct_users_sessions(df: DataFrame, grain: list[str]) -> DataFrame:
    """Exact distinct users and sessions per grain (NULLs not counted)."""
    return _user_grain(df, grain, True).select(*grain, "total_users", "total_sessions")


def stage_users(df: DataFrame, grain: list[str]) -> DataFrame:
    """Distinct users per funnel stage per grain (conditional distinct count)."""
    return _user_grain(df, grain, False).select(*grain, *STAGES)


def product_view_counts(df: DataFrame) -> DataFrame:
    """Per product: product views counted by their (non-NULL) user, and all view rows."""
    pv = F.col("event_type") == PRODUCT_VIEW
    return df.groupBy("product_id").agg(
        F.count(F.when(pv, F.col("user_id"))).alias("total_product_views"),
        F.count_if(pv).alias("view_events"),
    )


def stage_event_counts(df: DataFrame, grain: list[str]) -> DataFrame:
    """Checkout and purchase events per grain."""
    t = F.col("event_type")
    return df.groupBy(*grain).agg(
        F.count_if(t == CHECKOUT).alias("checkout_events"),
        F.count_if(t == PURCHASE).alias("purchase_events"),
    )


def with_guarded_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "checkout_to_purchase_rate", guarded_rate("purchase_events", "checkout_events")
    )


def with_coalesced_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "checkout_to_purchase_rate", coalesced_rate("purchase_events", "checkout_events")
    )


def grain_keys(df: DataFrame, grain: list[str], name: str = "grain_key") -> DataFrame:
    """Distinct grain values with their SHA-256 surrogate key."""
    return df.select(*grain).distinct().withColumn(name, surrogate_key(*grain))
