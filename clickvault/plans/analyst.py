"""Analyst questions over the Gold tables (and exact variants over Silver).

Sums of per-day distinct counts are user-days, not users: a user active on
two days counts twice. Where that matters an ``*_exact`` variant counts
distinct values over Silver instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import days_late, guarded_rate

TOP_PRODUCTS = 10


def top_products_by_purchases(product: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The n products with most purchasers (summed over days and countries).

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its
    own top n, only those reach the final merge.
    """
    return (
        product.groupBy("product_id")
        .agg(F.sum("unique_purchasers").alias("total_purchasers"))
        .orderBy(F.desc("total_purchasers"), F.asc("product_id"))
        .limit(n)
    )


def best_product_rate_per_day(product: DataFrame) -> DataFrame:
    """Per day, the (product, country) row with the highest purchase rate.

    Ties go to more purchasers, then the smaller product_id, then country.
    An aggregate (``min_by`` on a composite order key) instead of a window:
    it combines map-side, so one huge day never sorts whole in one task.
    """
    cols = ["product_id", "country", "purchase_rate", "unique_purchasers",
            "unique_product_viewers"]
    order = F.struct(
        (-F.col("purchase_rate")).alias("r"),
        (-F.col("unique_purchasers")).alias("p"),
        F.col("product_id"),
        F.col("country"),
    )
    best = product.groupBy("event_date").agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_b")
    )
    return best.select("event_date", *[F.col(f"_b.{c}").alias(c) for c in cols])


def high_views_low_purchases(product: DataFrame) -> DataFrame:
    """Products viewed at least as much as the average product but bought
    less than the average product.

    Both averages come from one scalar subquery (a one-row struct, computed
    once and inlined as a literal), so there is no join of every product
    against them.
    """
    per = product.groupBy("product_id").agg(
        F.sum("total_product_views").alias("total_views"),
        F.sum("unique_purchasers").alias("total_purchasers"),
    )
    avg = per.select(
        F.struct(F.avg("total_views").alias("v"), F.avg("total_purchasers").alias("p"))
    ).scalar()
    viewed = F.col("total_views") >= avg.getField("v")
    bought = F.col("total_purchasers") < avg.getField("p")
    return per.where(viewed & bought)


def _ranked_sum(df: DataFrame, key: str, measure: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(measure).alias(out)).orderBy(F.desc(out), F.asc(key))


def users_by_source(channel: DataFrame) -> DataFrame:
    """User-days per traffic source, most first."""
    return _ranked_sum(channel, "traffic_source", "total_users", "total_users")


def purchasers_by_source(channel: DataFrame) -> DataFrame:
    return _ranked_sum(channel, "traffic_source", "purchasers", "purchasers")


def sessions_by_source(channel: DataFrame) -> DataFrame:
    return _ranked_sum(channel, "traffic_source", "total_sessions", "total_sessions")


def users_by_source_exact(silver: DataFrame) -> DataFrame:
    """Distinct users per traffic source over all days."""
    return (
        silver.groupBy("traffic_source")
        .agg(F.count_distinct("user_id").alias("total_users"))
        .orderBy(F.desc("total_users"), F.asc("traffic_source"))
    )


def sessions_by_source_exact(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("traffic_source")
        .agg(F.count_distinct("session_id").alias("total_sessions"))
        .orderBy(F.desc("total_sessions"), F.asc("traffic_source"))
    )


FUNNEL_STAGES = ["visitors", "product_viewers", "cart_users", "checkout_users", "purchasers"]


def funnel_users_per_day(funnel: DataFrame) -> DataFrame:
    """Users at each funnel stage per day (summed over countries)."""
    return funnel.groupBy("event_date").agg(
        *[F.sum(c).alias(c) for c in FUNNEL_STAGES]
    )


def funnel_rates_per_day(funnel: DataFrame) -> DataFrame:
    """Stage conversion rates per day, recomputed from the day's sums."""
    s = funnel_users_per_day(funnel)
    return s.select(
        "event_date",
        guarded_rate("cart_users", "product_viewers").alias("view_to_cart_rate"),
        guarded_rate("checkout_users", "cart_users").alias("cart_to_checkout_rate"),
        guarded_rate("purchasers", "product_viewers").alias("view_to_purchase_rate"),
        guarded_rate("purchasers", "checkout_users").alias("checkout_to_purchase_rate"),
    )


def days_by_purchasers(business: DataFrame) -> DataFrame:
    return _ranked_sum(business, "event_date", "purchasers", "purchasers")


def late_arrival_profile(silver: DataFrame) -> DataFrame:
    """Events per event date and number of days they arrived late."""
    late = days_late("ingestion_timestamp", "event_date").alias("days_late")
    return (
        silver.select("event_date", late)
        .groupBy("event_date", "days_late")
        .agg(F.count(F.lit(1)).alias("events"))
    )
