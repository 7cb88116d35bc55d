"""The four Gold aggregates over Silver rows.

Each Gold table counts distinct users per funnel stage (and distinct
sessions) per grain. Written naively that is five to six
``count(DISTINCT ...)`` per group, which Catalyst rewrites into an Expand
that copies every input row once per distinct expression plus once more.

The default plan here ("user_grain") instead aggregates once to the
(grain, user) level, with one boolean per stage, and counts those rows per
grain. Only the session count needs a second key, so rows are emitted at
most twice (user key and session key) instead of seven times. Both levels
are hash aggregates with map-side combine, so a hot grain (e.g. one
country holding all rows) or a hot user never lands whole in one task.

``method="distinct"`` keeps the literal count-distinct form; tests check
the two agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import coalesced_rate, guarded_rate, surrogate_key
from clickvault.schemas import (
    ADD_TO_CART,
    BUSINESS,
    CHANNEL,
    CHECKOUT,
    FUNNEL,
    PRODUCT,
    PRODUCT_VIEW,
    PURCHASE,
    GoldSpec,
)

STAGES = {
    "product_viewers": PRODUCT_VIEW,
    "cart_users": ADD_TO_CART,
    "checkout_users": CHECKOUT,
    "purchasers": PURCHASE,
}


def _is(stage: str) -> Column:
    return F.col("event_type") == stage


def _finish(spec: GoldSpec, agg: DataFrame, rates: dict[str, Column]) -> DataFrame:
    out = agg.withColumns(rates).withColumn(spec.key_column, surrogate_key(*spec.key_inputs))
    return out.select(*spec.columns)


def stage_level(df: DataFrame, grain: list[str], with_sessions: bool) -> DataFrame:
    """First level: one row per (grain, user) [and (grain, session)].

    ``_k`` is 0 for a user key and 1 for a session key, ``_v`` the key value,
    ``_n`` the number of events, and one boolean per funnel stage.
    """
    user_flags = [_is(s).alias(f"_f_{n}") for n, s in STAGES.items()]
    if with_sessions:
        # Each row is emitted under its user key (kind 0) and its session key
        # (kind 1); the session copy carries no flags.
        keyed = df.select(
            *grain,
            F.inline(
                F.array(
                    F.struct(F.lit(0).alias("_k"), F.col("user_id").alias("_v"), *user_flags),
                    F.struct(
                        F.lit(1).alias("_k"),
                        F.col("session_id").alias("_v"),
                        *[F.lit(False).alias(f"_f_{n}") for n in STAGES],
                    ),
                )
            ),
        )
    else:
        keyed = df.select(*grain, F.lit(0).alias("_k"), F.col("user_id").alias("_v"), *user_flags)
    return keyed.groupBy(*grain, "_k", "_v").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.bool_or(F.col(f"_f_{n}")).alias(n) for n in STAGES],
    )


def rollup_level(level: DataFrame, grain: list[str]) -> DataFrame:
    """A first level re-keyed to a coarser grain.

    A user seen under several traffic sources becomes one row: flags are
    OR-ed and event counts added. This aggregates the (much smaller) level
    rows, not the events again.
    """
    return level.groupBy(*grain, "_k", "_v").agg(
        F.sum("_n").alias("_n"), *[F.bool_or(n).alias(n) for n in STAGES]
    )


def stage_measures(level: DataFrame, grain: list[str], with_sessions: bool) -> DataFrame:
    """Second level: users, sessions, events and stage users per grain."""
    user = (F.col("_k") == 0) & F.col("_v").isNotNull()
    measures = [
        F.count_if(user).alias("total_users"),
        *[F.count_if(user & F.col(n)).alias(n) for n in STAGES],
    ]
    if with_sessions:
        measures += [
            F.count_if((F.col("_k") == 1) & F.col("_v").isNotNull()).alias("total_sessions"),
            F.sum(F.when(F.col("_k") == 0, F.col("_n"))).alias("total_events"),
        ]
    return level.groupBy(*grain).agg(*measures)


def _user_grain(df: DataFrame, grain: list[str], with_sessions: bool) -> DataFrame:
    """Per grain: users, sessions, events and distinct users per stage."""
    return stage_measures(stage_level(df, grain, with_sessions), grain, with_sessions)


def _distinct(df: DataFrame, grain: list[str], with_sessions: bool) -> DataFrame:
    measures = [F.count_distinct("user_id").alias("total_users")]
    if with_sessions:
        measures += [
            F.count_distinct("session_id").alias("total_sessions"),
            F.count(F.lit(1)).alias("total_events"),
        ]
    measures += [
        F.count_distinct(F.when(_is(s), F.col("user_id"))).alias(n) for n, s in STAGES.items()
    ]
    return df.groupBy(*grain).agg(*measures)


def _stage_metrics(df, grain, with_sessions, method):
    if method == "user_grain":
        return _user_grain(df, grain, with_sessions)
    if method == "distinct":
        return _distinct(df, grain, with_sessions)
    raise ValueError(f"unknown method {method!r}")


def business_rates() -> dict[str, Column]:
    return {
        "view_to_cart_rate": guarded_rate("cart_users", "product_viewers"),
        "cart_to_checkout_rate": guarded_rate("checkout_users", "cart_users"),
        "checkout_to_purchase_rate": guarded_rate("purchasers", "checkout_users"),
    }


def funnel_rates() -> dict[str, Column]:
    return {
        "view_to_cart_rate": guarded_rate("cart_users", "product_viewers"),
        "cart_to_checkout_rate": guarded_rate("checkout_users", "cart_users"),
        "view_to_purchase_rate": guarded_rate("purchasers", "product_viewers"),
        "checkout_to_purchase_rate": guarded_rate("purchasers", "checkout_users"),
    }


def day_country_metrics(silver: DataFrame, method: str = "user_grain") -> DataFrame:
    """Shared (event_date, country) aggregate behind business metrics and funnel."""
    return _stage_metrics(silver, BUSINESS.grain, True, method)


def business_from_metrics(agg: DataFrame) -> DataFrame:
    return _finish(BUSINESS, agg, business_rates())


def funnel_from_metrics(agg: DataFrame) -> DataFrame:
    return _finish(FUNNEL, agg.withColumnRenamed("total_users", "visitors"), funnel_rates())


def business_metrics(silver: DataFrame, method: str = "user_grain") -> DataFrame:
    """Gold business_metrics: grain (event_date, country)."""
    return business_from_metrics(day_country_metrics(silver, method))


def marketing_funnel(silver: DataFrame, method: str = "user_grain") -> DataFrame:
    """Gold marketing_funnel: grain (event_date, country); no session count needed."""
    agg = _stage_metrics(silver, FUNNEL.grain, False, method)
    return funnel_from_metrics(agg)


def channel_from_metrics(agg: DataFrame) -> DataFrame:
    rates = {
        "purchase_conversion_rate": guarded_rate("purchasers", "total_users"),
        "events_per_session": guarded_rate("total_events", "total_sessions", scale=1),
    }
    return _finish(CHANNEL, agg, rates)


def marketing_channel(silver: DataFrame, method: str = "user_grain") -> DataFrame:
    """Gold marketing_channel: grain (event_date, country, traffic_source)."""
    return channel_from_metrics(_stage_metrics(silver, CHANNEL.grain, True, method))


def product_performance(silver: DataFrame, method: str = "user_grain") -> DataFrame:
    """Gold product_performance: grain (event_date, country, product_id).

    Rows without a product are left out before grouping; the two ratios
    use the coalesced form, so a product bought but never viewed gets 0.0.
    """
    grain = PRODUCT.grain
    df = silver.where(F.col("product_id").isNotNull())
    pv = _is(PRODUCT_VIEW)
    if method == "user_grain":
        level = df.groupBy(*grain, F.col("user_id").alias("_v")).agg(
            F.count_if(pv).alias("_views"),
            *[F.bool_or(_is(s)).alias(n) for n, s in STAGES.items()],
        )
        agg = product_measures(level)
    elif method == "distinct":
        u = F.col("user_id")
        agg = df.groupBy(*grain).agg(
            F.count_distinct(F.when(pv, u)).alias("unique_product_viewers"),
            F.count(F.when(pv, u)).alias("total_product_views"),
            F.count_distinct(F.when(_is(ADD_TO_CART), u)).alias("unique_cart_users"),
            F.count_distinct(F.when(_is(CHECKOUT), u)).alias("unique_checkout_users"),
            F.count_distinct(F.when(_is(PURCHASE), u)).alias("unique_purchasers"),
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    return product_from_metrics(agg)


def product_measures(level: DataFrame) -> DataFrame:
    """Product grain from (date, country, product, user ``_v``) rows with
    ``_views`` and the stage flags."""
    user = F.col("_v").isNotNull()
    return level.groupBy(*PRODUCT.grain).agg(
        F.count_if(user & F.col("product_viewers")).alias("unique_product_viewers"),
        F.coalesce(F.sum(F.when(user, F.col("_views"))), F.lit(0)).alias("total_product_views"),
        F.count_if(user & F.col("cart_users")).alias("unique_cart_users"),
        F.count_if(user & F.col("checkout_users")).alias("unique_checkout_users"),
        F.count_if(user & F.col("purchasers")).alias("unique_purchasers"),
    )


def product_from_metrics(agg: DataFrame) -> DataFrame:
    rates = {
        "purchase_rate": coalesced_rate("unique_purchasers", "unique_product_viewers"),
        "avg_views_per_viewer": coalesced_rate(
            "total_product_views", "unique_product_viewers", scale=1
        ),
    }
    return _finish(PRODUCT, agg, rates)


BUILDERS = {
    BUSINESS.name: business_metrics,
    FUNNEL.name: marketing_funnel,
    CHANNEL.name: marketing_channel,
    PRODUCT.name: product_performance,
}
