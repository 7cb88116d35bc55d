"""Bronze-shaped batches derived from the driver's ``events`` table.

The ``events`` table (event_id, ts, user_id, event_type, ...) has none of
the clickstream columns nor any defects, so this adapter derives them,
deterministically from event_id, with the defects the cleaning must handle:
padded/lower-case ids, NULL mandatory values, mixed case, exact copies and
same-id retries. All rows of ``events`` are used; the rules below only
choose the text of each column (and emit a second copy for the two copy
classes).

Timestamps are written as ISO text, as in landed JSON, so the Silver cast
is exercised too. The same rules are spelled out in SQL in
``clickvault.oracle.sql`` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.schemas import BRONZE_COLUMNS

# Fixed values of the fixture (see FIXTURES.md §5), kept together:
# event_type mapping of the events table onto the funnel vocabulary.
EVENT_TYPE_MAP = {
    "signup": "page_view",
    "view": "product_view",
    "click": "Add_To_Cart ",
    "error": "checkout",
    "purchase": "purchase",
}
# value by event_id % 3, % 4, % 7 and user_id % 4 (None = NULL).
DEVICES = ["Mobile", "desktop", None]
PLATFORMS = ["android", "IOS", "web", None]
SOURCES = ["google", " Email", "direct", "unknown", "organic", "facebook", None]
COUNTRIES = [" india", "BRAZIL ", "united states", None]
# event_id % 100 classes that are landed twice.
EXACT_COPY_CLASS = 13
RETRY_CLASS = 63

# Day the second (late) batch starts in the fixture's two-batch replay.
LATE_BATCH_START = dt.date(2024, 1, 16)



def _pick(values: list, idx: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        if v is None:
            continue
        expr = (F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v)))
    return expr


def _iso(ts: Column) -> Column:
    # zone-free text of a timestamp_ntz, ISO 'T' separator as in landed JSON
    return F.translate(ts.cast("string"), " ", "T")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """All-string bronze rows (11 columns) derived from ``events``."""
    i = F.col("event_id")
    retry_copy = (F.col("_r") == 2) & (i % 100 == RETRY_CLASS)
    twice = (i % 100).isin(EXACT_COPY_CLASS, RETRY_CLASS)
    base = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias(
            "_r"
        ),
    )
    pad6 = F.format_string("%06d", i)
    etype = F.col("event_type")
    type_expr = None
    for k, v in EVENT_TYPE_MAP.items():
        type_expr = F.when(etype == k, v) if type_expr is None else type_expr.when(etype == k, v)
    ts = F.col("ts")
    ingested = (
        F.when(retry_copy, ts + F.expr("INTERVAL 300 SECONDS"))
        .when(i % 40 == 5, ts + F.expr("INTERVAL 2 DAYS"))
        .otherwise(ts + F.expr("INTERVAL 60 SECONDS"))
    )
    cols = {
        "event_id": F.when(i % 50 == 7, F.concat(F.lit(" evt"), pad6, F.lit(" "))).otherwise(
            F.concat(F.lit("EVT"), pad6)
        ),
        "user_id": F.when(
            i % 200 != 11, F.concat(F.lit("u"), F.format_string("%06d", F.col("user_id")))
        ),
        "session_id": F.when(
            i % 200 != 23,
            F.concat(
                F.lit("S"),
                F.col("user_id").cast("string"),
                F.lit("D"),
                F.dayofmonth(ts).cast("string"),
            ),
        ),
        "event_timestamp": F.when(i % 1000 != 31, _iso(ts)),
        "ingestion_timestamp": _iso(ingested),
        "event_type": type_expr,
        "product_id": F.when(
            (etype != "signup") & ~((etype == "purchase") & (i % 300 < 3)),
            F.concat(F.lit("p"), F.format_string("%04d", i % 50)),
        ),
        "device_type": F.when(retry_copy, F.lit("Tablet")).otherwise(_pick(DEVICES, i % 3)),
        "platform": _pick(PLATFORMS, i % 4),
        "traffic_source": _pick(SOURCES, i % 7),
        "country": _pick(COUNTRIES, F.col("user_id") % 4),
    }
    return base.select(*[cols[c].alias(c) for c in BRONZE_COLUMNS])


def _ingestion_date(bronze: DataFrame) -> Column:
    return F.to_date(F.col("ingestion_timestamp").try_cast("timestamp_ntz"))


def first_batch(bronze: DataFrame, late_start: dt.date = LATE_BATCH_START) -> DataFrame:
    """Files landed before ``late_start`` (rows without ingestion time included)."""
    d = _ingestion_date(bronze)
    return bronze.where(F.coalesce(d < F.lit(late_start), F.lit(True)))


def second_batch(bronze: DataFrame, late_start: dt.date = LATE_BATCH_START) -> DataFrame:
    """Files landed from ``late_start`` on, plus a re-send of the previous day's file.

    Rows landed late carry event dates already loaded by the first batch,
    and the re-sent file matches ids already in Silver, so the upsert's
    update branch and the Gold refresh of old dates are both exercised.
    """
    d = _ingestion_date(bronze)
    return bronze.where(d >= F.lit(late_start - dt.timedelta(days=1)))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows for a test-data scale directory."""
    events = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return bronze_from_events(events)
