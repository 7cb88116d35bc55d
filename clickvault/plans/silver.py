"""Bronze -> Silver batch plan and its stage report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickvault.operators import cleaning as K
from clickvault.schemas import PAGE_VIEW, SILVER_COLUMNS, SILVER_LOAD_TS, SILVER_MANDATORY
from clickvault.sources.bronze import LANDED


def silver_clean(bronze: DataFrame) -> DataFrame:
    """The cleaned batch, 12 Silver columns, one row per event_id.

    The exact-duplicate pass is not planned separately: copies of a row are
    identical, so the id de-duplication picks the same survivor with or
    without it. The whole chain is one shuffle (on event_id, map-side
    combined); everything else is narrow.
    """
    std = K.standardize(bronze)
    return K.fill_defaults(K.product_rule(K.drop_null_mandatory(K.dedup_by_id(std))))


def silver_clean_observed(bronze: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    """``silver_clean`` with row counts observed after each stage.

    Beside them: the NULLs of each mandatory column among the rows that the
    drop sees, and the rows that break the product rule. The counts are collected by whichever action first runs the plan (the
    checkpoint in ``load_batch``), so logging them costs no extra pass. The
    duplicate-group counts of ``stage_counts`` need aggregations of their
    own and are not included.

    With a ``_landed`` column each file is cleaned as a batch of its own, and of
    the rows left of an event_id that of the last file is taken, as if the files
    were loaded one after the other. That costs a second narrow shuffle.
    """
    if LANDED in bronze.columns:
        return _files_clean_observed(bronze)
    obs = {n: Observation(n) for n in OBSERVED_STAGES}
    one = F.count(F.lit(1)).alias("rows")
    std = K.standardize(bronze).observe(obs["bronze_rows"], one)
    by_id = K.dedup_by_id(std).observe(obs["after_id_dedup"], one, *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in SILVER_MANDATORY])
    broken = (F.col("event_type") != PAGE_VIEW) & F.col("product_id").isNull()
    nonnull = K.drop_null_mandatory(by_id).observe(
        obs["after_mandatory_nulls"], one, F.count_if(broken).alias("product_rule_violations"))
    kept = K.product_rule(nonnull).observe(obs["after_product_rule"], one)
    return K.fill_defaults(kept), obs


def _files_clean_observed(bronze: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    obs = {n: Observation(n) for n in OBSERVED_STAGES}
    one = F.count(F.lit(1)).alias("rows")
    std = K.standardize(bronze, (LANDED,)).observe(obs["bronze_rows"], one)
    by_id = K.dedup_by_id_and_file(std, LANDED).observe(obs["after_id_dedup"], one, *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in SILVER_MANDATORY])
    broken = (F.col("event_type") != PAGE_VIEW) & F.col("product_id").isNull()
    nonnull = K.drop_null_mandatory(by_id).observe(
        obs["after_mandatory_nulls"], one, F.count_if(broken).alias("product_rule_violations"))
    kept = K.product_rule(nonnull).observe(obs["after_product_rule"], one)
    return K.last_file_by_id(K.fill_defaults(kept), LANDED), obs


OBSERVED_STAGES = ["bronze_rows", "after_id_dedup", "after_mandatory_nulls", "after_product_rule"]


def observed_counts(obs: dict[str, Observation]) -> dict[str, int]:
    return {n: o.get["rows"] for n, o in obs.items()}


def observed_defects(obs: dict[str, Observation]) -> dict[str, int]:
    """NULLs by mandatory column and product-rule violations of the observed batch."""
    return {k: v for o in obs.values() for k, v in o.get.items() if k != "rows"}


def with_load_timestamp(df: DataFrame) -> DataFrame:
    """Stamp the Silver load time (session-zone timestamp)."""
    return df.withColumn(SILVER_LOAD_TS, F.current_timestamp())


def stage_counts(bronze: DataFrame) -> DataFrame:
    """Row counts after each cleaning stage, in one row.

    Two aggregations (all columns, then event_id), both combined on the map
    side, then one global aggregate: the report costs about as much as the
    cleaning itself, not one job per logged number.
    """
    std = K.standardize(bronze)
    rows = std.groupBy(*SILVER_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    payload = F.struct(*[F.col(c) for c in K.SURVIVOR_ORDER])
    per_id = rows.groupBy("event_id").agg(
        F.sum("_n").alias("_rows"),
        F.count(F.lit(1)).alias("_distinct_rows"),
        F.count_if(F.col("_n") > 1).alias("_dup_groups"),
        F.max(payload).alias("_s"),
    )
    s = lambda c: F.col(f"_s.{c}")
    mandatory_ok = F.col("event_id").isNotNull()
    for c in SILVER_MANDATORY:
        if c != "event_id":
            mandatory_ok = mandatory_ok & s(c).isNotNull()
    product_ok = (s("event_type") == PAGE_VIEW) | s("product_id").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))  # noqa: E731 - 0 for an empty batch
    return per_id.agg(
        total("_rows").alias("bronze_rows"),
        total("_dup_groups").alias("exact_duplicate_groups"),
        total("_distinct_rows").alias("after_exact_dedup"),
        F.count_if(F.col("_distinct_rows") > 1).alias("repeated_event_ids"),
        F.count(F.lit(1)).alias("after_id_dedup"),
        F.count_if(mandatory_ok).alias("after_mandatory_nulls"),
        F.count_if(mandatory_ok & product_ok).alias("after_product_rule"),
    )
