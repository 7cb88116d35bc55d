"""State kept from batch to batch: counters, lateness, bitmaps, and the two-phase dedup."""

import pytest
from pyspark.sql import functions as F

from clickvault.operators import cleaning as K
from clickvault.plans import distinct as D
from clickvault.plans import incremental as I
from clickvault.plans import refresh as R
from clickvault.registry import replay, std
from clickvault.schemas import SILVER_COLUMNS
from fixture_dirs import SF_SMALL
from test_plans import _plan, _rows


@pytest.fixture(scope="module")
def batches(spark, scratch):
    out = []
    for name, df in zip(("silver", "batch"), replay(spark, SF_SMALL)):
        df.write.parquet(f"{scratch}/incremental-{name}")
        out.append(spark.read.parquet(f"{scratch}/incremental-{name}"))
    return out


@pytest.mark.parametrize("table", ["marketing_channel", "product_performance"])
def test_state_equals_rebuilt_state(spark, batches, table):
    s1, b2 = batches
    final = R.upsert_silver(s1, b2)
    state = I.key_counters(I.inserted(s1), table)
    delta = I.key_counters(I.signed_changes(s1, b2), table)
    assert delta.where("_n < 0").count() or delta.count()
    new = I.refresh_state(state, delta, table)
    assert _rows(new.select(*state.columns)) == _rows(I.key_counters(I.inserted(final), table))
    # the batch sent again changes nothing
    assert I.key_counters(I.signed_changes(final, b2), table).count() == 0


def test_moved_event_leaves_its_old_grain(spark, batches):
    s1, _ = batches
    one = s1.orderBy("event_id").limit(1).withColumn("event_date", F.lit("2031-05-05").cast("date"))
    changes = I.signed_changes(s1, one)
    assert sorted(r["_sign"] for r in changes.select("_sign").collect()) == [-1, 1]
    late = I.refresh_lateness(
        I.lateness_changes(I.inserted(s1)), I.lateness_changes(changes))
    final = R.upsert_silver(s1, one)
    assert _rows(late) == _rows(I.lateness_changes(I.inserted(final)))


def test_incremental_reads_state_and_delta_only(spark, batches, scratch):
    s1, b2 = batches
    t = "business_metrics"
    state = I.key_counters(I.inserted(s1), t)
    frames = {"state": state, "measures": I.measures_of(state, t),
              "delta": I.key_counters(I.signed_changes(s1, b2), t)}
    kept = {}
    for name, df in frames.items():
        df.write.parquet(f"{scratch}/kept-{name}")
        kept[name] = spark.read.parquet(f"{scratch}/kept-{name}")
    gold = I.gold_of(I.refresh_measures(
        kept["measures"], I.measure_changes(kept["state"], kept["delta"], t), t), t)
    plan = _plan(gold)
    assert "incremental-silver" not in plan and plan.count("FileScan") == 3


def test_two_phase_dedup_orders_repeated_ids_only(spark):
    rows = std(spark, SF_SMALL)
    hot = rows.orderBy("event_id").limit(1).select(
        *[F.lit(None).cast("string").alias(c) if c == "event_id" else F.col(c)
          for c in SILVER_COLUMNS if c != "device_type"],
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(500)), lambda x: x.cast("string")))
        .alias("device_type"))
    hot = hot.select(*SILVER_COLUMNS)
    for df in (rows, rows.unionByName(hot), rows.limit(0)):
        assert _rows_null(K.dedup_by_id_two_phase(df)) == _rows_null(K.dedup_by_id(df))
        assert _rows_null(K.dedup_by_id_two_phase(df, 0)) == _rows_null(K.dedup_by_id(df))
    plan = _plan(K.dedup_by_id_two_phase(rows))
    assert "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("LeftAnti") < plan.index("SortAggregate") < plan.index("LeftSemi")


def _rows_null(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_numbers_are_dense_and_stay(spark):
    first = spark.createDataFrame([(x,) for x in "abcab"] + [(None,)], "k string").repartition(3)
    known = D.number_keys(first, "k")
    got = dict(map(tuple, known.collect()))
    assert sorted(got) == ["a", "b", "c"] and sorted(got.values()) == [1, 2, 3]
    more = dict(map(tuple, D.number_keys(
        spark.createDataFrame([("b",), ("x",), ("y",)], "k string"), "k", known).collect()))
    assert {k: more[k] for k in got} == got and sorted(more.values()) == [1, 2, 3, 4, 5]
    assert D.number_keys(first.limit(0), "k").count() == 0
