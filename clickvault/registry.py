"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole test tables of that directory (through the bronze adapter).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.operators import cleaning as K
from clickvault.operators import gold as G
from clickvault.operators import metrics as M
from clickvault.operators import quality as Q
from clickvault.oracle import sql as O
from clickvault.plans import analyst as A
from clickvault.plans import distinct as D
from clickvault.plans import incremental as I
from clickvault.plans import refresh as R
from clickvault.plans import silver as S
from clickvault.plans import tables as T
from clickvault.schemas import BRONZE_COLUMNS, GOLD_SPECS, SILVER_COLUMNS
from clickvault.session import (
    checkpoint_dir,
    checkpoint_reliably,
    ensure_checkpoint_dir,
    remove_folder,
)
from clickvault.sources import bronze as L
from clickvault.sources import fixture as FX
from clickvault.sources.fixture import bronze_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_clean(bronze_view(spark, sf_dir))


def std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.standardize(bronze_view(spark, sf_dir))


# ------------------------------------------------------------------ Silver


@register("silver_standardize", O.BASE + "SELECT * FROM std")
def q_silver_standardize(spark, sf_dir):
    return std(spark, sf_dir)


@register("silver_dedup_exact", O.BASE + "SELECT DISTINCT * FROM std")
def q_silver_dedup_exact(spark, sf_dir):
    return K.drop_exact_duplicates(std(spark, sf_dir))


@register(
    "exact_duplicate_groups",
    O.BASE + f"SELECT *, count(*) AS copies FROM std GROUP BY ALL HAVING count(*) > 1",
)
def q_exact_duplicate_groups(spark, sf_dir):
    return K.exact_duplicate_groups(std(spark, sf_dir))


@register(
    "duplicate_event_ids",
    O.BASE
    + "SELECT event_id, count(*) AS copies FROM (SELECT DISTINCT * FROM std) "
    "GROUP BY event_id HAVING count(*) > 1",
)
def q_duplicate_event_ids(spark, sf_dir):
    return K.duplicate_event_ids(K.drop_exact_duplicates(std(spark, sf_dir)))


@register("silver_dedup_by_id", O.BASE + "SELECT * FROM byid")
def q_silver_dedup_by_id(spark, sf_dir):
    return K.dedup_by_id(K.drop_exact_duplicates(std(spark, sf_dir)))


@register("silver_dedup_two_phase", O.BASE + "SELECT * FROM byid")
def q_silver_dedup_two_phase(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return K.dedup_by_id_two_phase(std(spark, sf_dir))


@register(
    "null_profile",
    O.BASE
    + "SELECT "
    + ", ".join(
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}"
        for c in ["event_id", "event_timestamp", "event_type", "ingestion_timestamp",
                  "session_id", "user_id"]
    )
    + " FROM byid",
)
def q_null_profile(spark, sf_dir):
    return K.null_profile(K.dedup_by_id(std(spark, sf_dir)))


@register("silver_drop_nulls", O.BASE + "SELECT * FROM nonnull")
def q_silver_drop_nulls(spark, sf_dir):
    return K.drop_null_mandatory(K.dedup_by_id(std(spark, sf_dir)))


@register("silver_product_rule", O.BASE + "SELECT * FROM prod")
def q_silver_product_rule(spark, sf_dir):
    return K.product_rule(K.drop_null_mandatory(K.dedup_by_id(std(spark, sf_dir))))


@register(
    "product_rule_violations",
    O.BASE + "SELECT * FROM nonnull WHERE event_type <> 'page_view' AND product_id IS NULL",
)
def q_product_rule_violations(spark, sf_dir):
    return K.product_rule_violations(K.drop_null_mandatory(K.dedup_by_id(std(spark, sf_dir))))


@register("silver_fill_defaults", O.BASE + "SELECT * FROM silver")
def q_silver_fill_defaults(spark, sf_dir):
    return K.fill_defaults(
        K.product_rule(K.drop_null_mandatory(K.dedup_by_id(std(spark, sf_dir))))
    )


@register("silver_clean", O.BASE + "SELECT * FROM silver")
def q_silver_clean(spark, sf_dir):
    return silver(spark, sf_dir)


@register(
    "silver_stage_counts",
    O.BASE
    + f"""SELECT
  (SELECT count(*) FROM std) AS bronze_rows,
  (SELECT count(*) FROM (SELECT *, count(*) AS c FROM std GROUP BY ALL HAVING count(*) > 1))
    AS exact_duplicate_groups,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM std)) AS after_exact_dedup,
  (SELECT count(*) FROM (SELECT event_id FROM (SELECT DISTINCT * FROM std)
     GROUP BY event_id HAVING count(*) > 1)) AS repeated_event_ids,
  (SELECT count(*) FROM byid) AS after_id_dedup,
  (SELECT count(*) FROM nonnull) AS after_mandatory_nulls,
  (SELECT count(*) FROM prod) AS after_product_rule""",
)
def q_silver_stage_counts(spark, sf_dir):
    return S.stage_counts(bronze_view(spark, sf_dir))


# -------------------------------------------------------------------- Gold

for _name, _cte in [
    ("gold_business_metrics", "gold_business"),
    ("gold_marketing_funnel", "gold_funnel"),
    ("gold_marketing_channel", "gold_channel"),
    ("gold_product_performance", "gold_product"),
]:
    _builder = G.BUILDERS[_name.removeprefix("gold_")]

    def _q(spark, sf_dir, _b=_builder):
        return _b(silver(spark, sf_dir))

    register(_name, O.BASE_GOLD + f"SELECT * FROM {_cte}")(_q)


# ------------------------------------------------ rates, keys, distinct counts
PRODUCT_DAY = ["event_date", "product_id"]
STAGE_EVENTS_SQL = (
    "SELECT event_date, product_id, "
    "CAST(count_if(event_type = 'checkout') AS BIGINT) AS checkout_events, "
    "CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_events FROM silver "
    "GROUP BY event_date, product_id"
)


@register(
    "rate_guarded",
    O.BASE
    + f"SELECT *, {O.guarded('purchase_events', 'checkout_events')} AS checkout_to_purchase_rate "
    f"FROM ({STAGE_EVENTS_SQL})",
)
def q_rate_guarded(spark, sf_dir):
    return M.with_guarded_rate(M.stage_event_counts(silver(spark, sf_dir), PRODUCT_DAY))


@register(
    "rate_coalesced",
    O.BASE
    + f"SELECT *, {O.coalesced('purchase_events', 'checkout_events')} "
    f"AS checkout_to_purchase_rate FROM ({STAGE_EVENTS_SQL})",
)
def q_rate_coalesced(spark, sf_dir):
    return M.with_coalesced_rate(M.stage_event_counts(silver(spark, sf_dir), PRODUCT_DAY))


@register(
    "surrogate_keys",
    O.BASE
    + "SELECT *, "
    + O.key("event_date", "country", "traffic_source")
    + " AS grain_key FROM (SELECT DISTINCT event_date, country, traffic_source FROM std)",
)
def q_surrogate_keys(spark, sf_dir):
    # over standardized rows, NULL grain values included (concat_ws skips them)
    return M.grain_keys(std(spark, sf_dir), ["event_date", "country", "traffic_source"])


@register(
    "distinct_users_sessions",
    O.BASE
    + "SELECT event_date, count(DISTINCT user_id) AS total_users, "
    "count(DISTINCT session_id) AS total_sessions FROM silver GROUP BY event_date",
)
def q_distinct_users_sessions(spark, sf_dir):
    return M.distinct_users_sessions(silver(spark, sf_dir), ["event_date"])


@register(
    "stage_users",
    O.BASE + f"SELECT event_date, {O.STAGE_AGGS} FROM silver GROUP BY event_date",
)
def q_stage_users(spark, sf_dir):
    return M.stage_users(silver(spark, sf_dir), ["event_date"])


@register(
    "product_view_counts",
    O.BASE
    + "SELECT product_id, count(CASE WHEN event_type = 'product_view' THEN user_id END) "
    "AS total_product_views, CAST(count_if(event_type = 'product_view') AS BIGINT) "
    "AS view_events "
    "FROM silver GROUP BY product_id",
)
def q_product_view_counts(spark, sf_dir):
    return M.product_view_counts(silver(spark, sf_dir))


# ------------------------------------------------------------- quality rules
def _rules_query(name, frame_fn, rules, oracle_src_sql):
    register(name, oracle_src_sql + O.suite_sql("_t", rules))(
        lambda spark, sf_dir: Q.run_suite(frame_fn(spark, sf_dir), rules)
    )


def _src(base: str, select: str) -> str:
    # append one more CTE named _t to a WITH prefix
    return base.rstrip().rstrip("\n") + f",\n_t AS ({select})\n"


_rules_query(
    "expect_unique",
    lambda s, d: K.drop_exact_duplicates(std(s, d)),
    [Q.expect_unique("event_id")],
    _src(O.BASE, "SELECT DISTINCT * FROM std"),
)
_rules_query(
    "expect_not_null",
    lambda s, d: K.dedup_by_id(std(s, d)),
    [Q.expect_not_null(c) for c in
     ["event_id", "event_timestamp", "event_type", "user_id", "session_id"]],
    _src(O.BASE, "SELECT * FROM byid"),
)
_rules_query(
    "expect_not_null_where",
    lambda s, d: K.drop_null_mandatory(K.dedup_by_id(std(s, d))),
    [Q.expect_not_null("product_id", row_condition='event_type != "page_view"')],
    _src(O.BASE, "SELECT * FROM nonnull"),
)
_rules_query(
    "expect_between",
    lambda s, d: G.marketing_channel(silver(s, d)),
    [Q.expect_between("purchase_conversion_rate", 0, 100),
     Q.expect_between("events_per_session", 0, None),
     Q.expect_between("total_events", None, 5)],
    _src(O.BASE_GOLD, "SELECT * FROM gold_channel"),
)
_rules_query("suite_silver", silver, Q.SILVER_SUITE, _src(O.BASE, "SELECT * FROM silver"))
for _name, _table, _cte in [
    ("suite_business", "business_metrics", "gold_business"),
    ("suite_funnel", "marketing_funnel", "gold_funnel"),
    ("suite_channel", "marketing_channel", "gold_channel"),
    ("suite_product", "product_performance", "gold_product"),
]:
    _rules_query(
        _name,
        lambda s, d, _b=G.BUILDERS[_table]: _b(silver(s, d)),
        Q.SUITES[_table],
        _src(O.BASE_GOLD, f"SELECT * FROM {_cte}"),
    )


# ------------------------------------------------ upserts and late batches
def replay(spark, sf_dir):
    """(silver after batch 1, clean batch 2) of the fixture's two-batch replay."""
    bronze = bronze_view(spark, sf_dir)
    return (
        S.silver_clean(FX.first_batch(bronze)),
        S.silver_clean(FX.second_batch(bronze)),
    )


@register("upsert_silver", O.REPLAY + "SELECT * FROM final_silver")
def q_upsert_silver(spark, sf_dir):
    s1, b2 = replay(spark, sf_dir)
    return R.upsert_silver(s1, b2)


@register("upsert_idempotent", O.REPLAY + "SELECT * FROM final_silver")
def q_upsert_idempotent(spark, sf_dir):
    s1, b2 = replay(spark, sf_dir)
    return R.upsert_silver(R.upsert_silver(s1, b2), b2)


@register("touched_dates", O.REPLAY + "SELECT event_date FROM touched")
def q_touched_dates(spark, sf_dir):
    s1, b2 = replay(spark, sf_dir)
    return R.touched_dates(s1, b2)


@register("scan_silver_dates", O.REPLAY + "SELECT * FROM final_slice")
def q_scan_silver_dates(spark, sf_dir):
    s1, b2 = replay(spark, sf_dir)
    return R.silver_slice(R.upsert_silver(s1, b2), R.touched_dates(s1, b2))


for _name, _table, _cte in [
    ("business", "business_metrics", "gold_business"),
    ("funnel", "marketing_funnel", "gold_funnel"),
    ("channel", "marketing_channel", "gold_channel"),
    ("product", "product_performance", "gold_product"),
]:
    _grain = " AND ".join(f"o.{c} = n.{c}" for c in GOLD_SPECS[_table].grain)

    def _upsert(spark, sf_dir, _t=_table):
        s1, b2 = replay(spark, sf_dir)
        new_silver = R.upsert_silver(s1, b2)
        touched = R.touched_dates(s1, b2)
        source = G.BUILDERS[_t](R.silver_slice(new_silver, touched))
        return R.merge_gold_frame(G.BUILDERS[_t](s1), source, _t)

    register(
        f"upsert_gold_{_name}",
        O.REPLAY
        + f"SELECT * FROM g1_{_cte} o WHERE NOT EXISTS "
        f"(SELECT 1 FROM gs_{_cte} n WHERE {_grain}) UNION ALL SELECT * FROM gs_{_cte}",
    )(_upsert)

    def _refresh(spark, sf_dir, _t=_table):
        s1, b2 = replay(spark, sf_dir)
        return R.refresh_gold_frame(
            G.BUILDERS[_t](s1), R.upsert_silver(s1, b2), R.touched_dates(s1, b2), _t
        )

    # the refreshed table must equal a one-shot rebuild over the final Silver
    _rname = "gold_refresh_after_late" if _name == "business" else f"gold_refresh_{_name}"
    register(_rname, O.REPLAY + f"SELECT * FROM gf_{_cte}")(_refresh)


# --------------------------------------------- kept up to date by changes alone
for _table, _cte in [
    ("business_metrics", "gold_business"),
    ("marketing_funnel", "gold_funnel"),
    ("marketing_channel", "gold_channel"),
    ("product_performance", "gold_product"),
]:
    def _incremental(spark, sf_dir, _t=_table):
        s1, b2 = replay(spark, sf_dir)
        state = I.key_counters(I.inserted(s1), _t)
        delta = I.key_counters(I.signed_changes(s1, b2), _t)
        change = I.measure_changes(state, delta, _t)
        return I.gold_of(I.refresh_measures(I.measures_of(state, _t), change, _t), _t)

    register(f"gold_incremental_{_cte.removeprefix('gold_')}",
             O.REPLAY + f"SELECT * FROM gf_{_cte}")(_incremental)


@register(
    "late_arrival_incremental",
    O.REPLAY
    + "SELECT event_date, CAST(date_diff('day', event_date, CAST(ingestion_timestamp AS DATE)) "
    "AS INTEGER) AS days_late, count(*) AS events FROM final_silver GROUP BY ALL",
)
def q_late_arrival_incremental(spark, sf_dir):
    s1, b2 = replay(spark, sf_dir)
    return I.refresh_lateness(
        A.late_arrival_profile(s1), I.lateness_changes(I.signed_changes(s1, b2)))


# --------------------------------------------- exact distinct counts over many days
SOURCE = ["traffic_source"]
_ALL_STAGES = "count(DISTINCT user_id) AS total, " + O.STAGE_AGGS


def day_state(spark, sf_dir, column):
    ensure_checkpoint_dir(spark)
    rows = silver(spark, sf_dir)
    return D.day_bitmaps(rows, D.number_keys(rows, column), column, SOURCE)


@register(
    "users_by_source_bitmaps",
    O.BASE + f"SELECT traffic_source, {_ALL_STAGES} FROM silver GROUP BY traffic_source",
)
def q_users_by_source_bitmaps(spark, sf_dir):
    return D.exact_counts(day_state(spark, sf_dir, "user_id"), SOURCE)


@register(
    "sessions_by_source_bitmaps",
    O.BASE + "SELECT traffic_source, count(DISTINCT session_id) AS total FROM silver "
    "GROUP BY traffic_source",
)
def q_sessions_by_source_bitmaps(spark, sf_dir):
    return D.exact_counts(day_state(spark, sf_dir, "session_id"), SOURCE).select(*SOURCE, "total")


@register(
    "users_rolling_week",
    O.BASE
    + f"SELECT d.event_date, traffic_source, {_ALL_STAGES} "
    "FROM (SELECT DISTINCT event_date FROM silver) d "
    "JOIN silver s ON s.event_date BETWEEN d.event_date - 6 AND d.event_date "
    "GROUP BY d.event_date, traffic_source",
)
def q_users_rolling_week(spark, sf_dir):
    return D.rolling_counts(day_state(spark, sf_dir, "user_id"), 7, SOURCE)


@register(
    "users_by_source_after_late",
    O.REPLAY + f"SELECT traffic_source, {_ALL_STAGES} FROM final_silver GROUP BY traffic_source",
)
def q_users_by_source_after_late(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    s1, b2 = replay(spark, sf_dir)
    users = D.number_keys(s1, "user_id")
    state = D.day_bitmaps(s1, users, "user_id", SOURCE)
    dates = R.touched_dates(s1, b2)
    users = D.number_keys(b2, "user_id", users)
    fresh = D.day_bitmaps(R.silver_slice(R.upsert_silver(s1, b2), dates), users, "user_id", SOURCE)
    return D.exact_counts(D.replace_days(state, fresh, dates), SOURCE)


# ------------------------------------------------------------- the table path
def loaded_tables(spark, sf_dir, pick):
    """``pick(database)`` after both batches are loaded into real tables, which then go."""
    ensure_checkpoint_dir(spark)
    db = "clickvault_" + uuid.uuid4().hex
    bronze = bronze_view(spark, sf_dir)
    rows = FX.load_table(spark, sf_dir, "events").count()  # from the footers
    T.create_tables(
        spark, db, silver_buckets=T.buckets_for(rows, spark.sparkContext.defaultParallelism))
    try:
        for batch in (FX.first_batch(bronze), FX.second_batch(bronze)):
            T.load_batch(spark, batch, db, raise_on_gold_failure=False)
        return checkpoint_reliably(pick(db))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


@register("table_path_silver", O.REPLAY + "SELECT * FROM final_silver")
def q_table_path_silver(spark, sf_dir):
    return loaded_tables(
        spark, sf_dir, lambda db: spark.table(T.silver_table(db)).select(*SILVER_COLUMNS))


@register("table_path_channel", O.REPLAY + "SELECT * FROM gf_gold_channel")
def q_table_path_channel(spark, sf_dir):
    return loaded_tables(
        spark, sf_dir, lambda db: spark.table(T.gold_table(db, "marketing_channel")).select(
            *GOLD_SPECS["marketing_channel"].columns))


# ------------------------------------------------------------ landed JSON lines
def landed_lines(spark, sf_dir):
    """The bronze rows landed as JSON lines and read back; some lines are cut off."""
    ensure_checkpoint_dir(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    bronze = bronze_view(spark, sf_dir)
    number = F.regexp_extract("event_id", "[0-9]+", 0).cast("long")
    cut = F.concat(F.lit('{"event_id": "'), F.trim("event_id"), F.lit('", "user_id"'))
    line = F.when(number % 97 == 0, cut).otherwise(F.to_json(F.struct(*bronze.columns)))
    bronze.select(line.alias("value")).write.text(path)
    return L.read_landed(spark, path), path


def landed_query(spark, sf_dir, pick):
    landed, path = landed_lines(spark, sf_dir)
    try:
        return checkpoint_reliably(pick(landed))
    finally:
        remove_folder(spark, path)


_CUT = "CAST(regexp_extract(event_id, '[0-9]+') AS BIGINT) % 97 = 0"


@register("landed_rejects", "WITH " + O.BRONZE_CTE + """
SELECT '{"event_id": "' || trim(event_id) || '", "user_id"' AS line, 'cut off' AS reason,
       CAST(0 AS INTEGER) AS fields FROM bronze WHERE """ + _CUT)
def q_landed_rejects(spark, sf_dir):
    return landed_query(spark, sf_dir, lambda d: L.rejects(d).drop("file"))


@register("landed_scan", "WITH " + O.BRONZE_CTE + f"""
SELECT {", ".join(BRONZE_COLUMNS)} FROM bronze WHERE NOT ({_CUT})""")
def q_landed_scan(spark, sf_dir):
    return landed_query(spark, sf_dir, lambda d: L.accepted(d).select(*BRONZE_COLUMNS))


# --------------------------------------------------------- analyst questions
def gold(spark, sf_dir, table):
    return G.BUILDERS[table](silver(spark, sf_dir))


@register(
    "top_products_by_purchases",
    O.BASE_GOLD
    + f"SELECT product_id, {O.sum_big('unique_purchasers', 'total_purchasers')} "
    "FROM gold_product GROUP BY product_id ORDER BY total_purchasers DESC, product_id LIMIT 10",
)
def q_top_products(spark, sf_dir):
    return A.top_products_by_purchases(gold(spark, sf_dir, "product_performance"))


@register(
    "best_product_rate_per_day",
    O.BASE_GOLD
    + "SELECT event_date, product_id, country, purchase_rate, unique_purchasers, "
    "unique_product_viewers FROM (SELECT *, row_number() OVER (PARTITION BY event_date "
    "ORDER BY purchase_rate DESC, unique_purchasers DESC, product_id, country) AS rn "
    "FROM gold_product) WHERE rn = 1",
)
def q_best_product_rate(spark, sf_dir):
    return A.best_product_rate_per_day(gold(spark, sf_dir, "product_performance"))


@register(
    "high_views_low_purchases",
    O.BASE_GOLD
    + f""", per AS (SELECT product_id, {O.sum_big('total_product_views', 'total_views')},
  {O.sum_big('unique_purchasers', 'total_purchasers')} FROM gold_product GROUP BY product_id)
SELECT * FROM per WHERE total_views >= (SELECT avg(total_views) FROM per)
  AND total_purchasers < (SELECT avg(total_purchasers) FROM per)""",
)
def q_high_views_low_purchases(spark, sf_dir):
    return A.high_views_low_purchases(gold(spark, sf_dir, "product_performance"))


def _by_source_sql(measure: str, out: str) -> str:
    return (
        O.BASE_GOLD
        + f"SELECT traffic_source, {O.sum_big(measure, out)} FROM gold_channel "
        f"GROUP BY traffic_source ORDER BY {out} DESC, traffic_source"
    )


@register("users_by_source", _by_source_sql("total_users", "total_users"))
def q_users_by_source(spark, sf_dir):
    return A.users_by_source(gold(spark, sf_dir, "marketing_channel"))


@register("purchasers_by_source", _by_source_sql("purchasers", "purchasers"))
def q_purchasers_by_source(spark, sf_dir):
    return A.purchasers_by_source(gold(spark, sf_dir, "marketing_channel"))


@register("sessions_by_source", _by_source_sql("total_sessions", "total_sessions"))
def q_sessions_by_source(spark, sf_dir):
    return A.sessions_by_source(gold(spark, sf_dir, "marketing_channel"))


@register(
    "users_by_source_exact",
    O.BASE + "SELECT traffic_source, count(DISTINCT user_id) AS total_users FROM silver "
    "GROUP BY traffic_source",
)
def q_users_by_source_exact(spark, sf_dir):
    return A.users_by_source_exact(silver(spark, sf_dir))


@register(
    "sessions_by_source_exact",
    O.BASE + "SELECT traffic_source, count(DISTINCT session_id) AS total_sessions FROM silver "
    "GROUP BY traffic_source",
)
def q_sessions_by_source_exact(spark, sf_dir):
    return A.sessions_by_source_exact(silver(spark, sf_dir))


_FUNNEL_SUMS = ", ".join(O.sum_big(c) for c in A.FUNNEL_STAGES)


@register(
    "funnel_users_per_day",
    O.BASE_GOLD + f"SELECT event_date, {_FUNNEL_SUMS} FROM gold_funnel GROUP BY event_date",
)
def q_funnel_users_per_day(spark, sf_dir):
    return A.funnel_users_per_day(gold(spark, sf_dir, "marketing_funnel"))


@register(
    "funnel_rates_per_day",
    O.BASE_GOLD
    + f"""SELECT event_date,
  {O.guarded('cart_users', 'product_viewers')} AS view_to_cart_rate,
  {O.guarded('checkout_users', 'cart_users')} AS cart_to_checkout_rate,
  {O.guarded('purchasers', 'product_viewers')} AS view_to_purchase_rate,
  {O.guarded('purchasers', 'checkout_users')} AS checkout_to_purchase_rate
FROM (SELECT event_date, {_FUNNEL_SUMS} FROM gold_funnel GROUP BY event_date)""",
)
def q_funnel_rates_per_day(spark, sf_dir):
    return A.funnel_rates_per_day(gold(spark, sf_dir, "marketing_funnel"))


@register(
    "days_by_purchasers",
    O.BASE_GOLD
    + f"SELECT event_date, {O.sum_big('purchasers')} FROM gold_business GROUP BY event_date",
)
def q_days_by_purchasers(spark, sf_dir):
    return A.days_by_purchasers(gold(spark, sf_dir, "business_metrics"))


@register(
    "late_arrival_profile",
    O.BASE
    + "SELECT event_date, CAST(date_diff('day', event_date, CAST(ingestion_timestamp AS DATE)) "
    "AS INTEGER) AS days_late, count(*) AS events FROM silver GROUP BY ALL",
)
def q_late_arrival_profile(spark, sf_dir):
    return A.late_arrival_profile(silver(spark, sf_dir))
