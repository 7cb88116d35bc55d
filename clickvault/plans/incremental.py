"""Gold and lateness kept up to date by what a batch changes.

An upsert takes rows out (those the batch replaces) and puts rows in. Both are
counted with a sign, so a moved or corrected event leaves its old grain and an event
sent again cancels out. Beside each Gold table goes a state with one row per
(grain, user) or (grain, session): how many events it has, and how many of each
funnel stage. Distinct counts change only where one of these counters leaves or
reaches zero, so a batch reads the counters of the keys it changes and the measures
of their grains, and no other event of the day.

All steps are aggregates that combine on the map side, so a hot grain or user never
lands whole in one task. Grains and keys match null-safely. A counter never falls below zero as long as
the state holds exactly the events of the table the batch is merged into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import days_late
from clickvault.operators import gold as G
from clickvault.schemas import BUSINESS, CHANNEL, PRODUCT

KEYS = ["_k", "_v"]
COUNTERS = ["_n", *G.STAGES]
MEASURES = ["total_users", *G.STAGES, "total_sessions", "total_events", "total_views"]

#: Gold table -> (grain, whether sessions are counted)
LEVELS = {
    "business_metrics": (BUSINESS.grain, True),
    "marketing_funnel": (BUSINESS.grain, True),
    "marketing_channel": (CHANNEL.grain, True),
    "product_performance": (PRODUCT.grain, False),
}


def inserted(rows: DataFrame) -> DataFrame:
    """All of ``rows`` as additions (to build a state from nothing)."""
    return rows.withColumn("_sign", F.lit(1).cast("long"))


def signed_changes(silver: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows the merge of ``batch`` takes out of ``silver`` (``_sign`` -1) and puts in (1)."""
    replaced = silver.join(batch.select("event_id"), "event_id", "left_semi")
    return replaced.select(*batch.columns).withColumn("_sign", F.lit(-1).cast("long")).unionByName(
        inserted(batch))


def key_counters(changes: DataFrame, table: str) -> DataFrame:
    """Signed counters per (grain, user) and (grain, session); those that cancel out go."""
    grain, sessions = LEVELS[table]
    if table == "product_performance":
        changes = changes.where(F.col("product_id").isNotNull())
    sign, none = F.col("_sign"), F.lit(0).cast("long")
    stages = [F.when(F.col("event_type") == s, sign).otherwise(none).alias(n)
              for n, s in G.STAGES.items()]
    kinds = [F.struct(F.lit(0).alias("_k"), F.col("user_id").alias("_v"), sign.alias("_n"), *stages)]
    if sessions:
        kinds.append(F.struct(F.lit(1).alias("_k"), F.col("session_id").alias("_v"),
                              sign.alias("_n"), *[none.alias(n) for n in G.STAGES]))
    keyed = changes.select(*grain, F.inline(F.array(*kinds)))
    sums = keyed.groupBy(*grain, *KEYS).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return sums.where(" or ".join(f"{c} <> 0" for c in COUNTERS))


def refresh_state(state: DataFrame, delta: DataFrame, table: str) -> DataFrame:
    """The state after ``delta``; keys without events left go."""
    both = state.unionByName(delta).groupBy(*LEVELS[table][0], *KEYS)
    return both.agg(*[F.sum(c).alias(c) for c in COUNTERS]).where("_n > 0")


def _measures(counted: DataFrame, table: str, present, events, views) -> DataFrame:
    user = (F.col("_k") == 0) & F.col("_v").isNotNull()
    session = (F.col("_k") == 1) & F.col("_v").isNotNull()

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("long"))

    return counted.groupBy(*LEVELS[table][0]).agg(
        total(user, present("_n")).alias("total_users"),
        *[total(user, present(n)).alias(n) for n in G.STAGES],
        total(session, present("_n")).alias("total_sessions"),
        total(F.col("_k") == 0, events).alias("total_events"),
        total(user, views).alias("total_views"))


def measures_of(state: DataFrame, table: str) -> DataFrame:
    """The measures of every grain of a state."""
    return _measures(state, table, lambda c: (F.col(c) > 0).cast("long"), F.col("_n"),
                     F.col("product_viewers"))


def measure_changes(state: DataFrame, delta: DataFrame, table: str) -> DataFrame:
    """What ``delta`` adds to the measures of the grains it changes, from the keys it changes."""
    on = [*LEVELS[table][0], *KEYS]
    old = state.select(*[F.col(c).alias(f"_o_{c}") for c in [*on, *COUNTERS]])
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in on]
    counted = delta.join(old, same, "left")

    def turned(c: str) -> Column:
        before = F.coalesce(F.col(f"_o_{c}"), F.lit(0))
        return (before + F.col(c) > 0).cast("long") - (before > 0).cast("long")

    return _measures(counted, table, turned, F.col("_n"), F.col("product_viewers"))


def refresh_measures(measures: DataFrame, change: DataFrame, table: str) -> DataFrame:
    """The measures after ``change``; grains without events left go."""
    both = measures.unionByName(change).groupBy(*LEVELS[table][0])
    return both.agg(*[F.sum(c).alias(c) for c in MEASURES]).where("total_events > 0")


def gold_of(measures: DataFrame, table: str) -> DataFrame:
    """The Gold table of a grain's measures."""
    if table == "business_metrics":
        return G.business_from_metrics(measures)
    if table == "marketing_funnel":
        return G.funnel_from_metrics(measures)
    if table == "marketing_channel":
        return G.channel_from_metrics(measures)
    return G.product_from_metrics(measures.select(
        *PRODUCT.grain, F.col("product_viewers").alias("unique_product_viewers"),
        F.col("total_views").alias("total_product_views"),
        F.col("cart_users").alias("unique_cart_users"),
        F.col("checkout_users").alias("unique_checkout_users"),
        F.col("purchasers").alias("unique_purchasers")))


def lateness_changes(changes: DataFrame) -> DataFrame:
    """Signed events per event date and days late; what cancels out goes."""
    late = days_late("ingestion_timestamp", "event_date").alias("days_late")
    return changes.select("event_date", late, "_sign").groupBy("event_date", "days_late").agg(
        F.sum("_sign").alias("events")).where("events <> 0")


def refresh_lateness(profile: DataFrame, change: DataFrame) -> DataFrame:
    """The lateness profile after ``change``."""
    return profile.unionByName(change).groupBy("event_date", "days_late").agg(
        F.sum("events").alias("events")).where("events > 0")
