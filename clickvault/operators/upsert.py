"""Upsert (MERGE by key) for DataFrames and for partitioned file tables.

Semantics of the reference's ``MERGE ... WHEN MATCHED UPDATE ALL / WHEN
NOT MATCHED INSERT``: a source row replaces the target row with the same
key, other source rows are inserted, target rows without a partner stay.
Keys match with ``=``, so a NULL key never matches.

As a DataFrame that is one full outer join on the keys, whatever the layout
of the target, so a merge means the same for frames, plain and bucketed
tables: a target key that is there twice is replaced twice, as SQL
``MERGE ... UPDATE`` does.

On tables the engine has no row-level MERGE for plain Parquet, so
``upsert_partitioned_table`` replaces the partitions the batch touches by Spark's
dynamic partition overwrite (an option of the table, not of the session) and drops
partitions the merge empties. When the table is bucketed by the merge key, the
table side of the join is read without a shuffle and written back bucket by
bucket. Which partitions hold the batch's keys is looked up in a slim index table
(key, partition value) when the table has one.

Spark stages an overwrite and moves it in partition by partition when all tasks are
done. A run that dies before that leaves the table as it was. One that dies within
the moves leaves some partitions new; the same batch again gives the clean result,
because a source row replaces every copy of its key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Final state of ``target`` after merging ``source`` on ``keys``.

    One full outer join on the keys. On a table bucketed by the keys it reads
    the table side without a shuffle and its output stays partitioned by
    bucket, so the merged rows can be written back without another. A marker
    column tells source rows apart, so a NULL-key source row (which matches
    nothing) still comes out as itself.
    """
    cols = target.columns
    t = target.alias("_t")
    s = source.select(*cols).withColumn("_from_source", F.lit(True)).alias("_s")
    cond = [F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in keys]
    joined = t.join(s, cond, "full_outer")
    from_source = F.col("_s._from_source").isNotNull()
    return joined.select(
        *[F.when(from_source, F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in cols]
    )


def matched_partition_values(
    target: DataFrame, source: DataFrame, keys: list[str], partition_col: str
) -> DataFrame:
    """Partition values of target rows the source will replace.

    A source row may move its key to another partition (an event whose date
    was corrected); the old partition must then be rewritten as well.
    """
    return (
        target.select(*keys, partition_col)
        .join(source.select(*keys), on=list(keys), how="left_semi")
        .select(partition_col)
        .distinct()
    )


def _collect_values(df: DataFrame, column: str) -> list:
    # Bounded: one value per touched partition (a date), never data rows.
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def table_buckets(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a bucketed table, else None."""
    info = {
        r[0]: r[1]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        if r[0] in ("Num Buckets", "Bucket Columns")
    }
    if "Num Buckets" not in info:
        return None
    cols = [c.strip().strip("`") for c in info["Bucket Columns"].strip("[]").split(",")]
    return int(info["Num Buckets"]), cols


def overwrite_partitions(
    spark: SparkSession,
    table: str,
    new_rows: DataFrame,
    partition_col: str,
    emptied: list,
) -> None:
    """Replace the partitions of ``table`` that ``new_rows`` has; drop those of ``emptied``.

    ``new_rows`` must hold the complete new content of its partitions. The
    table must carry the option ``partitionOverwriteMode = dynamic``
    (``create_tables`` sets it), so no session setting matters; then
    ``new_rows`` may read the table itself.
    """
    out = new_rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(table).schema])
    if not table_buckets(spark, table):
        # REBALANCE on the partition column: AQE cuts a hot date into chunks
        # of the advisory size and merges small ones, so each date gets a
        # few right-sized files instead of one file per (task, date)
        out = out.hint("rebalance", partition_col)
    out.write.insertInto(table, overwrite=True)
    drop_partitions(spark, table, partition_col, emptied)


def drop_partitions(spark: SparkSession, table: str, partition_col: str, values: list) -> None:
    for v in values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = '{v}')")
    spark.catalog.refreshTable(table)


def replaced_rows(spark: SparkSession, table: str, slice_: DataFrame, source: DataFrame,
                  keys: list[str]) -> DataFrame:
    """``slice_`` without the rows ``source`` replaces, and all of ``source``.

    Every copy of a source key goes, so a merge that was cut off half-way can be run
    again. On a bucketed table the slice is read by bucket and the source is dealt
    out in the same way: each task holds one bucket, and only the source moves.
    """
    buckets = table_buckets(spark, table)
    new = source.select(*slice_.columns)
    if buckets:
        new = new.repartition(buckets[0], *buckets[1])
    return slice_.join(source.select(*keys), list(keys), "left_anti").select(
        *slice_.columns).union(new)


def append_index(spark: SparkSession, index: str, source: DataFrame, keys: list[str],
                 partition_col: str) -> None:
    """Add the (key, partition value) pairs of ``source`` that the index lacks.

    Pairs are only added: one that no longer holds costs a partition rewrite too many
    when its key comes again, never a wrong row.
    """
    pairs = source.select(*keys, partition_col)
    new = pairs.join(spark.table(index), [*keys, partition_col], "left_anti")
    buckets = table_buckets(spark, index)
    if buckets:
        new = new.repartition(buckets[0], *buckets[1])
    new.select(*spark.table(index).columns).write.insertInto(index)


def upsert_partitioned_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: list[str],
    partition_col: str,
    index: str | None = None,
    before_write: Callable[[list], None] | None = None,
) -> list:
    """MERGE ``source`` into ``table`` by ``keys``; returns the touched partitions.

    Touched = partitions of the source rows + old partitions of matched
    rows, looked up in ``index`` (in the table itself without one). Only those
    are read (partition pruning), merged and rewritten; the rest of the table
    is not touched. The index gets the new pairs, and ``before_write`` the touched
    partitions, before any row of the table changes.
    """
    # another session (e.g. an earlier micro-batch) may have rewritten files
    for t in filter(None, (table, index)):
        spark.catalog.refreshTable(t)
    target = spark.table(table)
    own = _collect_values(source, partition_col)
    held = _collect_values(
        matched_partition_values(spark.table(index or table), source, keys, partition_col),
        partition_col)
    touched = sorted({*own, *held})
    if not touched:
        return []
    # an old partition is emptied when the source takes all its rows
    old = [v for v in touched if v not in set(own)]
    left = target.where(F.col(partition_col).isin(old)).select(*keys, partition_col).join(
        source.select(*keys), list(keys), "left_anti") if old else None
    kept = set(_collect_values(left, partition_col)) if old else set()
    if index:
        append_index(spark, index, source, keys, partition_col)
    if before_write is not None:
        before_write(touched)
    slice_ = target.where(F.col(partition_col).isin(touched))
    overwrite_partitions(
        spark, table, replaced_rows(spark, table, slice_, source, keys), partition_col,
        [v for v in old if v not in kept])
    return touched
