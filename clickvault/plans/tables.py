"""The write path on catalog tables: DDL, batch load, Gold refresh.

``load_batch`` is what one landed file triggers:

1. clean the bronze batch (one shuffle) and write it to a folder of its own
   below the shared checkpoint folder, so validation and write read it once
   and a lost executor never re-reads the landing files; the folder goes when
   the batch is done;
2. run the Silver suite in one pass and stop before writing if it fails;
3. note the touched dates as pending for each Gold table, then upsert into Silver,
   rewriting only touched ``event_date`` partitions. The dates that hold the
   batch's ids are found in ``silver_event_index``, a slim table of ids and
   dates, bucketed by id and added to before each merge;
4. re-aggregate the four Gold tables for their pending dates from all their
   Silver rows, gate each on its own suite, replace those date slices. A date
   stays pending for a table whose gate refused it, or that a run did not come
   to, and is tried again with the next load, for that table alone.

Tables are Parquet, partitioned by ``event_date`` (Gold too, so a date
slice can be replaced without touching other dates). With a catalog that
supports row-level MERGE (Iceberg/Delta) step 3 could be a ``MERGE INTO``
instead; the partition overwrite here gives the same final state.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickvault.operators import gold as G
from clickvault.operators import quality as Q
from clickvault.operators.upsert import (
    drop_partitions,
    overwrite_partitions,
    table_buckets,
    upsert_partitioned_table,
)
from clickvault.plans.silver import (
    observed_counts,
    observed_defects,
    silver_clean_observed,
    stage_counts,
    with_load_timestamp,
)
from clickvault.schemas import GOLD_SPECS, SILVER_DDL, SILVER_LOAD_TS
from clickvault.session import checkpoint_dir, remove_folder
from clickvault.sources.bronze import REJECT_COLUMNS, accepted, rejects

SILVER_TABLE = "user_interactions_processed"
INDEX_TABLE = "silver_event_index"
PENDING_TABLE = "gold_pending_dates"
REJECTS_TABLE = "bronze_rejects"
INDEX_BUCKETS = 8
#: rows that make a bucket worth a task, and rows of all days that a bucket should hold at most
TASK_ROWS, BUCKET_ROWS = 250_000, 1_000_000
#: a rewrite replaces the partitions it writes, whatever the session's setting
OVERWRITE = "OPTIONS ('partitionOverwriteMode' = 'dynamic')"
log = logging.getLogger("clickvault")


def silver_table(database: str) -> str:
    return f"{database}.{SILVER_TABLE}"


def index_table(database: str) -> str:
    return f"{database}.{INDEX_TABLE}"


def pending_table(database: str) -> str:
    return f"{database}.{PENDING_TABLE}"


def rejects_table(database: str) -> str:
    return f"{database}.{REJECTS_TABLE}"


def gold_table(database: str, name: str) -> str:
    return f"{database}.{name}"


def buckets_for(rows: int, cores: int) -> int:
    """Buckets of a Silver table that is loaded with ``rows`` rows by ``cores`` cores.

    A merge writes each bucket in one task, so there are two for every core when the rows
    fill them, and more when a bucket would grow too large for a task.
    """
    return max(INDEX_BUCKETS, min(2 * cores, rows // TASK_ROWS), -(-rows // BUCKET_ROWS))


def create_tables(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    silver_buckets: int | None = None,
    gold_database: str | None = None,
) -> None:
    """Create the database, the Silver table and the four Gold tables if absent.

    Silver is partitioned by event_date and bucketed by event_id: the upsert
    joins every batch with Silver on event_id, and with both sides bucketed
    the same way only the batch is shuffled, never the table. Size the
    buckets so one bucket of one day is a good file size, e.g. daily volume
    / 128 MB (``session.silver_buckets_for``; a few thousand at 100 TB a year).
    ``None``, the default, leaves Silver without buckets.
    Gold tables go to ``gold_database`` when given (Silver and Gold kept in
    separate databases), else next to Silver.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    gold_db = gold_database or database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold_db}")
    bucketing = (
        f" CLUSTERED BY (event_id) INTO {int(silver_buckets)} BUCKETS" if silver_buckets else ""
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {silver_table(database)} ({SILVER_DDL}) "
        f"USING parquet {OVERWRITE} PARTITIONED BY (event_date){bucketing}"
    )
    if not spark.catalog.tableExists(index_table(database)):
        spark.sql(
            f"CREATE TABLE {index_table(database)} (event_id string, event_date date) USING parquet "
            f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {int(silver_buckets or INDEX_BUCKETS)} BUCKETS"
        )
        rebuild_index(spark, database)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {pending_table(database)} (event_date date, gold_table string) "
        f"USING parquet {OVERWRITE} PARTITIONED BY (gold_table)"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {rejects_table(database)} "
        "(file string, line string, reason string, fields int, rejected_at timestamp) USING parquet"
    )
    for spec in GOLD_SPECS.values():
        cols = [c for c in spec.ddl().split(",\n    ") if not c.startswith("event_date ")]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {gold_table(gold_db, spec.name)} "
            f"({', '.join(cols)}, event_date date) USING parquet {OVERWRITE} "
            "PARTITIONED BY (event_date)"
        )


def rebuild_index(spark: SparkSession, database: str) -> None:
    """Write the id index anew from Silver: one file per bucket, without pairs that no longer hold."""
    n = table_buckets(spark, index_table(database))[0]
    pairs = spark.table(silver_table(database)).select("event_id", "event_date")
    pairs.repartition(n, "event_id").write.insertInto(index_table(database), overwrite=True)


# ------------------------------------------------------------------- pending dates
def pending_dates(spark: SparkSession, database: str) -> dict[str, list]:
    """Dates each Gold table has yet to see; bounded by days and tables."""
    spark.catalog.refreshTable(pending_table(database))
    out: dict[str, list] = {}
    for r in spark.table(pending_table(database)).distinct().collect():
        out.setdefault(r["gold_table"], []).append(r["event_date"])
    return {name: sorted(dates) for name, dates in out.items()}


def _add_pending(spark: SparkSession, database: str, dates: list) -> None:
    rows = [(d, name) for d in dates for name in GOLD_SPECS]
    spark.createDataFrame(rows, "event_date date, gold_table string").coalesce(1).write.insertInto(
        pending_table(database))


def _clear_pending(spark: SparkSession, database: str, done: dict[str, list]) -> None:
    """Take the dates of ``done`` (by table) off; a table without any loses its partition."""
    have = pending_dates(spark, database)
    left = {name: sorted(set(dates) - set(done.get(name, []))) for name, dates in have.items()}
    changed = {name: dates for name, dates in left.items() if dates != have[name]}
    rows = [(d, name) for name, dates in changed.items() for d in dates]
    if rows:
        spark.createDataFrame(rows, "event_date date, gold_table string").coalesce(1) \
            .write.insertInto(pending_table(database), overwrite=True)
    drop_partitions(spark, pending_table(database), "gold_table",
                    [name for name, dates in changed.items() if not dates])


def parse_manifest(text: str | None) -> list:
    """Dates of a touched-date manifest (``"2026-09-19, 2026-09-20"``).

    An empty or missing manifest is an error, as in the reference: a Gold
    refresh without dates would silently do nothing.
    """
    if not text or not text.strip():
        raise KeyError("the touched-date manifest is missing or empty")
    return sorted({dt.date.fromisoformat(p.strip()) for p in text.split(",") if p.strip()})


def format_manifest(dates) -> str:
    return ",".join(str(d) for d in sorted(dates))


def scan_silver_dates(spark: SparkSession, database: str, dates: list) -> DataFrame:
    """Silver rows of the given dates; a partition filter, so only those
    date folders are listed and read."""
    spark.catalog.refreshTable(silver_table(database))
    return spark.table(silver_table(database)).where(F.col("event_date").isin(list(dates)))


@dataclass
class BatchReport:
    touched_dates: list = field(default_factory=list)
    silver_suite: list = field(default_factory=list)
    gold_suites: dict = field(default_factory=dict)
    gold_failures: dict = field(default_factory=dict)
    stage_counts: dict | None = None
    observed: dict = field(default_factory=dict)
    defects: dict = field(default_factory=dict)
    gold_counts: dict = field(default_factory=dict)


def refresh_gold(
    spark: SparkSession,
    database: str,
    dates: list | dict[str, list],
    method: str = "user_grain",
    parallel: bool = True,
    gold_database: str | None = None,
    counts: dict | None = None,
) -> tuple[dict, dict]:
    """Replace the Gold slices of ``dates``; each table is gated on its own.

    ``dates`` holds for all four tables, or gives each table's own (a table
    that is not in it is left alone).

    Returns (suite rows per table, failures per table). A table whose suite
    fails is left unchanged; the others are still written (the four tables
    are independent, as in the reference, whose four Gold jobs run side by
    side). With ``parallel`` the four validate-and-write chains are
    submitted from threads, so their Spark jobs share the executors instead
    of queueing one after the other. ``counts``, when given, is filled with
    each table's rows: Silver rows of the slice, rows built, rows written.
    """
    by_table = dates if isinstance(dates, dict) else dict.fromkeys(GOLD_SPECS, dates)
    by_table = {name: sorted(ds) for name, ds in by_table.items() if ds}
    if not by_table:
        return {}, {}
    every = sorted({d for ds in by_table.values() for d in ds})
    slice_ = scan_silver_dates(spark, database, every)
    # a pruned count of whole files, from their footers
    slice_rows = slice_.count() if counts is not None else None
    level = None
    if method == "user_grain":
        # one pass over the events for three tables: the per-source user and
        # session level gives the channel table, and rolled up to
        # (date, country) the business and funnel tables
        level = G.stage_level(slice_, G.CHANNEL.grain, True).persist(StorageLevel.MEMORY_AND_DISK)
        channel = G.channel_from_metrics(G.stage_measures(level, G.CHANNEL.grain, True))
        day_country = G.stage_measures(
            G.rollup_level(level, G.BUSINESS.grain), G.BUSINESS.grain, True
        )
    else:
        channel = G.marketing_channel(slice_, method)
        day_country = G.day_country_metrics(slice_, method)
    shared = day_country.persist(StorageLevel.MEMORY_AND_DISK)
    results = {
        "business_metrics": G.business_from_metrics(shared),
        "marketing_funnel": G.funnel_from_metrics(shared.drop("total_sessions", "total_events")),
        "marketing_channel": channel,
        "product_performance": G.product_performance(slice_, method),
    }

    def refresh_one(name: str, fresh: DataFrame):
        # Gold is recomputable from committed Silver, so persisting (not
        # checkpointing) is enough to validate and write it from one pass
        mine = by_table[name]
        if mine != every:
            fresh = fresh.where(F.col("event_date").isin(mine))
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            suite = Q.run_suite(fresh, Q.SUITES[name])
            if counts is not None:
                built = fresh.count()
                counts[name] = {"slice_rows": slice_rows, "built": built, "written": 0}
            rows = Q.enforce(suite, name)
            target = gold_table(gold_database or database, name)
            present = {r[0] for r in fresh.select("event_date").distinct().collect()}
            overwrite_partitions(spark, target, fresh, "event_date", [d for d in mine if d not in present])
            if counts is not None:
                counts[name]["written"] = built
            return name, rows, None
        except Q.DataQualityError as e:
            _log_rules(name, e.rows)
            return name, None, e
        finally:
            fresh.unpersist()

    results = {name: df for name, df in results.items() if name in by_table}
    try:
        if level is not None:
            # filled once, before four threads ask for them
            level.count()
        shared.count()
        if parallel:
            with ThreadPoolExecutor(max_workers=len(results)) as pool:
                outcomes = list(pool.map(lambda kv: refresh_one(*kv), results.items()))
        else:
            outcomes = [refresh_one(n, f) for n, f in results.items()]
    finally:
        shared.unpersist()
        if level is not None:
            level.unpersist()
    suites = {n: rows for n, rows, err in outcomes if err is None}
    failures = {n: err for n, rows, err in outcomes if err is not None}
    # a table that its gate refused keeps its dates pending
    _clear_pending(spark, database, {n: by_table[n] for n in suites})
    for n in sorted(suites):
        log.info("gold %s: %d date(s) refreshed, all rules passed", n, len(by_table[n]))
    for n, err in sorted(failures.items()):
        log.error("gold %s: left unchanged, %s", n, err)
    return suites, failures


def load_batch(
    spark: SparkSession,
    bronze: DataFrame,
    database: str,
    method: str = "user_grain",
    with_stage_counts: bool = False,
    raise_on_gold_failure: bool = True,
    gold_database: str | None = None,
    silver_only: bool = False,
) -> BatchReport:
    """Bronze batch -> Silver upsert -> Gold refresh of the touched dates.

    ``report.observed`` holds row counts after each cleaning stage, taken
    during the checkpoint job at no extra cost; ``with_stage_counts`` adds
    the full report with duplicate groups (two more aggregations).

    A failing Silver suite raises before anything is written. A failing Gold
    suite leaves that table unchanged; with ``raise_on_gold_failure`` it
    raises after the other tables were written, otherwise the failures are
    only recorded in ``report.gold_failures``. ``silver_only`` stops after
    the Silver upsert; ``report.touched_dates`` is then the manifest for a
    separate ``refresh_gold`` run.
    """
    report = BatchReport()
    if with_stage_counts:
        report.stage_counts = stage_counts(bronze).first().asDict()
        log.info("silver stage counts: %s", report.stage_counts)
    clean, obs = silver_clean_observed(bronze)
    clean = with_load_timestamp(clean)
    batch = f"{checkpoint_dir(spark).rstrip('/')}/batch-{uuid.uuid4().hex}"
    try:
        clean.write.parquet(batch)
        report.observed = observed_counts(obs)  # filled by the write
        report.defects = observed_defects(obs)
        log.info("silver rows per stage: %s; defects: %s", report.observed, report.defects)
        _load_clean(spark, spark.read.schema(clean.schema).parquet(batch), database, report)
    finally:
        remove_folder(spark, batch)
    if silver_only:
        return report
    # the batch's dates, and what earlier runs did not bring to a table
    report.gold_suites, report.gold_failures = refresh_gold(
        spark, database, pending_dates(spark, database), method, gold_database=gold_database, counts=report.gold_counts
    )
    log.info("gold rows: %s", report.gold_counts)
    if report.gold_failures and raise_on_gold_failure:
        raise GoldValidationError(report)
    return report


def load_landed(spark: SparkSession, landed: DataFrame, database: str, **kw) -> BatchReport:
    """Load files read by ``read_landed``: lines that are no JSON objects go to the rejects table.

    They are counted as ``rejected_lines``, apart from rows that lack an id. The
    files count in the order they landed. A load that is run again adds no reject twice.
    """
    new = rejects(landed)
    known = spark.table(rejects_table(database)).select(*REJECT_COLUMNS)
    count = Observation("rejects")
    lines = new.observe(count, F.count(F.lit(1)).alias("rows")).join(known, REJECT_COLUMNS, "left_anti")
    lines.withColumn("rejected_at", F.current_timestamp()).write.insertInto(rejects_table(database))
    report = load_batch(spark, accepted(landed), database, **kw)
    report.observed["rejected_lines"] = count.get["rows"]
    return report


def _load_clean(spark: SparkSession, clean: DataFrame, database: str, report: BatchReport) -> None:
    """Gate the cleaned batch and upsert it into Silver."""
    try:
        report.silver_suite = Q.enforce(Q.run_suite(clean, Q.SILVER_SUITE), "silver")
    except Q.DataQualityError as e:
        _log_rules("silver", e.rows)
        log.error("silver validation failed, nothing written: %s", e)
        raise
    _log_rules("silver", report.silver_suite)
    table = silver_table(database)
    report.touched_dates = upsert_partitioned_table(
        spark, table, clean, ["event_id"], "event_date", index_table(database),
        before_write=lambda dates: _add_pending(spark, database, dates),
    )
    log.info("silver upserted; touched dates: %s", format_manifest(report.touched_dates))


def _log_rules(suite: str, rows: list) -> None:
    for r in rows:
        log.log(logging.INFO if r["success"] else logging.ERROR, "%s rule %s %s: %s", suite,
                r["expectation"], r["kwargs"], "success" if r["success"] else "failed")


class GoldValidationError(Exception):
    def __init__(self, report: BatchReport):
        self.report = report
        names = ", ".join(sorted(report.gold_failures))
        super().__init__(f"Gold validation failed for: {names} (other tables were written)")
