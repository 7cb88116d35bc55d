"""Silver cleaning steps: standardize, de-duplicate, drop and default NULLs.

Every step is a DataFrame -> DataFrame function. The order the batch job
uses is standardize -> exact dedup -> id dedup -> mandatory NULLs ->
product rule -> defaults (see ``clickvault.plans.silver``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions import columns as C
from clickvault.schemas import (
    FILL_DEFAULTS,
    PAGE_VIEW,
    SILVER_COLUMNS,
    SILVER_MANDATORY,
)
from clickvault.session import checkpoint_reliably

# Survivor order for rows sharing an event_id: latest ingestion first, then
# the other columns, each descending with NULLs last. ``max`` over a struct
# compares field by field with NULL lowest, which is exactly that order.
SURVIVOR_ORDER = [c for c in SILVER_COLUMNS if c not in ("event_id", "ingestion_timestamp")]
SURVIVOR_ORDER.insert(0, "ingestion_timestamp")
#: repeated ids (8 bytes each) that are broadcast at most
MOST_REPEATED = 1_000_000


def standardize(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Type the timestamps, normalise text case/spaces, derive event_date.

    One projection, so Catalyst keeps it in a single codegen stage and the
    scan reads only the eleven bronze columns (and those of ``keep``).
    """
    ets = C.to_timestamp_ntz("event_timestamp")
    return bronze.select(
        *keep,
        C.upper_trim("event_id").alias("event_id"),
        ets.alias("event_timestamp"),
        F.to_date(ets).alias("event_date"),
        C.lower_trim("event_type").alias("event_type"),
        C.upper_trim("user_id").alias("user_id"),
        C.to_timestamp_ntz("ingestion_timestamp").alias("ingestion_timestamp"),
        C.lower_trim("platform").alias("platform"),
        C.upper_trim("product_id").alias("product_id"),
        C.upper_trim("session_id").alias("session_id"),
        C.lower_trim("traffic_source").alias("traffic_source"),
        C.title_trim("country").alias("country"),
        C.lower_trim("device_type").alias("device_type"),
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of fully identical rows (NULLs compare equal)."""
    return df.dropDuplicates()


def exact_duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_event_ids(df: DataFrame) -> DataFrame:
    """event_ids carried by more than one distinct row."""
    return (
        df.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    )


def dedup_by_id(df: DataFrame) -> DataFrame:
    """One row per event_id (all NULL ids form one group), deterministic.

    Written as an aggregate, not a window: Spark combines each key on the
    map side before the shuffle, so an event_id repeated in a third of the
    rows reaches the reducer as one row per map task instead of one huge
    sorted group.
    """
    payload = F.struct(*[F.col(c) for c in SURVIVOR_ORDER])
    return (
        df.groupBy("event_id")
        .agg(F.max(payload).alias("_s"))
        .select("event_id", *[F.col(f"_s.{c}").alias(c) for c in SURVIVOR_ORDER])
        .select(*SILVER_COLUMNS)
    )


def dedup_by_id_two_phase(df: DataFrame, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """``dedup_by_id`` that orders and shuffles only rows whose event_id is repeated.

    A hash aggregate over 8-byte digests of the ids finds the repeated ones; all other
    rows pass as they are. A digest shared by two ids only sends a row the longer way.
    The repeated digests are broadcast up to ``most_repeated``; with more of them
    all rows take the one-phase plan. ``df`` is read three times, so it should be
    cheap to read, e.g. staged.
    """
    named = df.withColumn("_id", F.xxhash64("event_id"))
    repeated = checkpoint_reliably(
        named.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id"))
    if repeated.count() > most_repeated:
        return dedup_by_id(df)
    once = named.join(F.broadcast(repeated), "_id", "left_anti").select(*SILVER_COLUMNS)
    again = named.join(F.broadcast(repeated), "_id", "left_semi")
    return once.unionByName(dedup_by_id(again))


def dedup_by_id_and_file(df: DataFrame, landed: str) -> DataFrame:
    """One row per event_id and file: what ``dedup_by_id`` keeps of each file alone."""
    payload = F.struct(*[F.col(c) for c in SURVIVOR_ORDER])
    return df.groupBy("event_id", landed).agg(F.max(payload).alias("_s")).select(
        landed, "event_id", *[F.col(f"_s.{c}").alias(c) for c in SURVIVOR_ORDER])


def last_file_by_id(df: DataFrame, landed: str) -> DataFrame:
    """One row per event_id: that of the file that landed last."""
    rest = [c for c in df.columns if c not in ("event_id", landed)]
    return df.groupBy("event_id").agg(F.max(F.struct(landed, *rest)).alias("_s")).select(
        "event_id", *[F.col(f"_s.{c}").alias(c) for c in rest]).select(*SILVER_COLUMNS)


def drop_null_mandatory(df: DataFrame, mandatory=SILVER_MANDATORY) -> DataFrame:
    """Drop rows with a NULL in any mandatory column."""
    return df.dropna(how="any", subset=list(mandatory))


def product_rule(df: DataFrame) -> DataFrame:
    """Keep page views always, other events only when they carry a product."""
    # an event without a type is no page view and needs a type to be kept
    typed = F.col("event_type").isNotNull()
    return df.where(typed & ((F.col("event_type") == PAGE_VIEW) | F.col("product_id").isNotNull()))


def product_rule_violations(df: DataFrame) -> DataFrame:
    """Rows the product rule removes."""
    return df.where((F.col("event_type") != PAGE_VIEW) & F.col("product_id").isNull())


def fill_defaults(df: DataFrame, defaults=FILL_DEFAULTS) -> DataFrame:
    """Replace NULL (not empty text) in the optional dimensions."""
    return df.fillna(dict(defaults))


def null_profile(df: DataFrame, cols=SILVER_MANDATORY) -> DataFrame:
    """NULL count per column, one row, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
