"""Runs that end half-way: the same batch again gives what a clean run gives."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from clickvault.operators import quality as Q
from clickvault.operators import upsert as U
from clickvault.plans import tables as T
from clickvault.sources.bronze import read_bronze_json
from test_handwritten import batch1, land

MOVED = "2026-09-21"


class Crash(Exception):
    pass


def moved_batch():
    """The first batch with its events of the 19th two days later: all of them move."""
    return [r | {"event_timestamp": r["event_timestamp"].replace("2026-09-19", MOVED)}
            if r.get("event_timestamp") else r for r in batch1()]


def state(spark, db):
    out = {}
    for name in [T.SILVER_TABLE, *T.GOLD_SPECS]:
        df = spark.table(f"{db}.{name}")
        cols = [c for c in df.columns if c != T.SILVER_LOAD_TS]
        out[name] = sorted(map(repr, df.select(*cols).collect()))
    return out


def load(spark, scratch, db, rows):
    return T.load_batch(spark, read_bronze_json(spark, land(scratch, rows)), db,
                        raise_on_gold_failure=False)


def fresh(spark, scratch, buckets=None):
    db = "rec_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db, silver_buckets=buckets)
    load(spark, scratch, db, batch1())
    return db


def crash_at(monkeypatch, module, name, n):
    """The n-th call of ``module.name`` fails before it does anything."""
    real, calls = getattr(module, name), []

    def run(*a, **k):
        calls.append(a)
        if len(calls) == n:
            raise Crash
        return real(*a, **k)

    monkeypatch.setattr(module, name, run)


@pytest.fixture(scope="module")
def want(spark, scratch):
    db = fresh(spark, scratch)
    load(spark, scratch, db, moved_batch())
    return state(spark, db)


@pytest.mark.parametrize("module,name,n,buckets", [
    (U, "append_index", 1, None),  # nothing written
    (U, "overwrite_partitions", 1, 4),  # index and pending dates written, Silver not
    (U, "drop_partitions", 1, 4),  # the old date of Silver still holds what moved
    (T, "overwrite_partitions", 1, None),  # Silver done, no Gold table
    (T, "overwrite_partitions", 3, None),  # two Gold tables done
    (T, "_clear_pending", 1, 4),  # all written, dates still pending
])
def test_rerun_equals_a_clean_run(spark, scratch, monkeypatch, want, module, name, n, buckets):
    db = fresh(spark, scratch, buckets)
    with monkeypatch.context() as m:
        m.setattr(T, "ThreadPoolExecutor", OneAfterTheOther)
        crash_at(m, module, name, n)
        with pytest.raises(Crash):
            load(spark, scratch, db, moved_batch())
    load(spark, scratch, db, moved_batch())
    assert state(spark, db) == want
    assert T.pending_dates(spark, db) == {}


def test_rerun_after_half_of_the_moves(spark, scratch, want):
    """Spark moved the new date in and died: the events are in their old date as well."""
    db = fresh(spark, scratch, 4)
    table = T.silver_table(db)
    moved = spark.table(table).where("event_date = '2026-09-19'").withColumns(
        {"event_date": F.expr(f"date'{MOVED}'"), "event_timestamp": F.expr("event_timestamp + interval 2 days")})
    rows = spark.createDataFrame(moved.collect(), spark.table(table).schema)
    U.append_index(spark, T.index_table(db), rows, ["event_id"], "event_date")
    rows.write.insertInto(table)
    load(spark, scratch, db, moved_batch())
    assert state(spark, db) == want


class OneAfterTheOther:
    def __init__(self, max_workers):
        pass

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False

    map = staticmethod(map)


def test_folders_do_not_grow(spark, scratch):
    """Loads of the same batch again leave no batch folder and as many index rows."""
    shared = T.checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    db = fresh(spark, scratch)
    rows = spark.table(T.index_table(db)).count()
    for _ in range(2):
        load(spark, scratch, db, batch1())
    assert spark.table(T.index_table(db)).count() == rows
    assert [n for n in set(os.listdir(shared)) - before if n.startswith("batch-")] == []


def test_dates_stay_pending_until_gold_has_seen_them(spark, scratch):
    db = fresh(spark, scratch)
    rep = T.load_batch(spark, read_bronze_json(spark, land(scratch, moved_batch())), db,
                       silver_only=True)
    dates = [dt.date(2026, 9, 19), dt.date(2026, 9, 21)]
    assert T.pending_dates(spark, db) == dict.fromkeys(T.GOLD_SPECS, dates)
    T.refresh_gold(spark, db, rep.touched_dates[:1])
    assert T.pending_dates(spark, db) == dict.fromkeys(T.GOLD_SPECS, dates[1:])
    T.refresh_gold(spark, db, {"marketing_channel": rep.touched_dates[1:]})
    assert "marketing_channel" not in T.pending_dates(spark, db)
    assert len(T.pending_dates(spark, db)) == 3


def test_only_the_refused_table_is_tried_again(spark, scratch, monkeypatch, want):
    db = fresh(spark, scratch)
    real = Q.enforce

    def refuse(suite, name):
        if name == "marketing_funnel":
            raise Q.DataQualityError(name, suite.collect())
        return real(suite, name)

    with monkeypatch.context() as m:
        m.setattr(Q, "enforce", refuse)
        rep = load(spark, scratch, db, moved_batch())
    assert list(rep.gold_failures) == list(T.pending_dates(spark, db)) == ["marketing_funnel"]
    assert state(spark, db) != want
    # the next load touches nothing, and brings the pending dates to the one table
    rep = load(spark, scratch, db, [])
    assert list(rep.gold_suites) == ["marketing_funnel"]
    assert state(spark, db) == want and T.pending_dates(spark, db) == {}


def test_index_lookup_reads_no_silver_history(spark, scratch, monkeypatch):
    """Silver is read at the touched dates only; the index finds a moved event's old date."""
    db = fresh(spark, scratch, 4)
    seen = []
    real = U.matched_partition_values
    monkeypatch.setattr(U, "matched_partition_values",
                        lambda target, *a: seen.append(sorted(target.columns)) or real(target, *a))
    rep = load(spark, scratch, db, moved_batch())
    assert seen == [["event_date", "event_id"]]  # the index, not Silver
    assert dt.date(2026, 9, 19) in rep.touched_dates
    have = {tuple(r) for r in spark.table(T.silver_table(db)).select("event_id", "event_date").collect()}
    pairs = [tuple(r) for r in spark.table(T.index_table(db)).select("event_id", "event_date").collect()]
    assert have <= set(pairs) and len(pairs) == len(set(pairs))
    T.rebuild_index(spark, db)
    assert sorted(map(tuple, spark.table(T.index_table(db)).collect())) == sorted(have)
