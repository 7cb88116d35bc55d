"""Exact distinct users over any days, from a mergeable state per day.

Daily distinct counts cannot be added up. Here each user (or session) gets a dense
number once, and a day keeps bitmaps of the numbers it saw, one for all and one per
funnel stage, cut into Spark's buckets of 32,768 numbers. Any set of days is then
counted exactly by OR-ing bitmaps, without reading events again.

A day's bitmaps follow the rule of the Gold slices: a touched day is replaced as a
whole (``replace_days``), because a bit cannot be taken out for one moved event.
Null keys count nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.operators.gold import STAGES
from clickvault.plans.refresh import date_set
from clickvault.session import checkpoint_reliably

ALL = "total"
BITMAPS = [ALL, *STAGES]


def number_keys(rows: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number) of every key of ``rows``, after those ``known``; numbers start at 1.

    New keys are numbered by their place in their task, after the keys of the tasks
    before; only the tasks' counts, one row each, come to the driver.
    """
    spark = rows.sparkSession
    new = rows.select(column).where(F.col(column).isNotNull()).distinct()
    start = 0
    if known is not None:
        new = new.join(known.select(column), column, "left_anti")
        start = known.agg(F.max("number")).first()[0] or 0
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # written, so a key keeps its number whenever it is read
    placed = checkpoint_reliably(
        new.select(column, F.spark_partition_id().alias("_task"), place.alias("_place")))
    before = []
    for r in placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect():
        before.append((r["_task"], start))
        start += r["n"]
    base = F.broadcast(spark.createDataFrame(before, "_task int, _before long"))
    numbered = placed.join(base, "_task").select(
        column, (F.col("_before") + F.col("_place") + 1).alias("number"))
    return numbered if known is None else known.unionByName(numbered)


def day_bitmaps(silver: DataFrame, numbers: DataFrame, column: str, dims: list[str]) -> DataFrame:
    """Bitmaps per (event_date, dims, bucket) of the keys seen, in all and by funnel stage.

    Events are first combined to one row per (day, dims, key), so a hot key joins as one row.
    """
    level = silver.groupBy("event_date", *dims, column).agg(
        *[F.bool_or(F.col("event_type") == s).alias(n) for n, s in STAGES.items()])
    at = level.join(numbers, column).withColumn("bucket", F.bitmap_bucket_number("number"))
    bit = F.bitmap_bit_position("number")
    return at.groupBy("event_date", *dims, "bucket").agg(
        F.bitmap_construct_agg(bit).alias(ALL),
        *[F.bitmap_construct_agg(F.when(F.col(n), bit)).alias(n) for n in STAGES])


def replace_days(state: DataFrame, fresh: DataFrame, dates: DataFrame) -> DataFrame:
    """The state with the days of ``dates`` as in ``fresh``."""
    kept = state.join(date_set(dates), "event_date", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def exact_counts(state: DataFrame, dims: list[str]) -> DataFrame:
    """Distinct keys per ``dims`` over all days of ``state``, in all and by stage."""
    merged = state.groupBy(*dims, "bucket").agg(*[F.bitmap_or_agg(c).alias(c) for c in BITMAPS])
    return merged.groupBy(*dims).agg(*[F.sum(F.bitmap_count(c)).alias(c) for c in BITMAPS])


def rolling_counts(state: DataFrame, days: int, dims: list[str]) -> DataFrame:
    """Distinct keys per ``dims`` in the ``days`` days up to each day of the state."""
    ends = date_set(state)  # one row per day
    until = F.explode(F.sequence("event_date", F.date_add("event_date", days - 1)))
    spread = state.withColumn("_end", until).drop("event_date").withColumnRenamed(
        "_end", "event_date").join(ends, "event_date", "left_semi")
    return exact_counts(spread, ["event_date", *dims])
