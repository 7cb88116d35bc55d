"""Late data: upsert a batch into Silver, then refresh Gold for touched dates.

Gold distinct counts cannot be patched incrementally (a late event of a
known user must not add a user), so every date the batch touches is
re-aggregated from *all* its Silver rows, and that date's Gold rows are
replaced as a whole. Dates the batch does not touch are not read.

Touched dates are the batch's own event dates plus the old dates of Silver
rows the batch replaces: an event whose date was corrected must leave its
old day's metrics too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.operators import gold as G
from clickvault.operators.upsert import matched_partition_values, merge_frames
from clickvault.schemas import GOLD_SPECS

SILVER_KEY = ["event_id"]


def touched_dates(target_silver: DataFrame, clean_batch: DataFrame) -> DataFrame:
    """Distinct dates a batch touches in Silver (new dates + dates it moves rows from)."""
    return (
        clean_batch.select("event_date")
        .union(matched_partition_values(target_silver, clean_batch, SILVER_KEY, "event_date"))
        .distinct()
    )


def upsert_silver(target_silver: DataFrame, clean_batch: DataFrame) -> DataFrame:
    """Silver after the batch: a source row replaces the same event_id."""
    return merge_frames(target_silver, clean_batch, SILVER_KEY)


def date_set(dates: DataFrame) -> DataFrame:
    """Distinct dates, marked for broadcast.

    The size bound is proven: one row per calendar day touched. Broadcasting
    it matters for correctness of scale, not just speed: a shuffled join on
    event_date would send every row of a day to a single task.
    """
    return F.broadcast(dates.select("event_date").distinct())


def silver_slice(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """Silver rows of the given dates.

    A broadcast semi join with the date set; on a table partitioned by
    event_date Spark turns it into dynamic partition pruning, and with a
    literal list (``isin``) into static partition filters.
    """
    return silver.join(date_set(dates), "event_date", "left_semi").select(*silver.columns)


def refresh_gold_frame(
    old_gold: DataFrame, new_silver: DataFrame, dates: DataFrame, table: str
) -> DataFrame:
    """Gold ``table`` after replacing the touched dates' slices."""
    build = G.BUILDERS[table]
    fresh = build(silver_slice(new_silver, dates))
    kept = old_gold.join(date_set(dates), "event_date", "left_anti")
    return kept.select(*old_gold.columns).unionByName(fresh)


def merge_gold_frame(old_gold: DataFrame, source_gold: DataFrame, table: str) -> DataFrame:
    """The reference's Gold MERGE: update matched grains, insert new ones, never delete."""
    return merge_frames(old_gold, source_gold, GOLD_SPECS[table].grain)
