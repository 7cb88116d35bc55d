"""Rules, one-pass suites and the gates."""

import uuid

import pytest

from clickvault.operators import quality as Q
from clickvault.plans import tables as T
from clickvault.sources.bronze import read_bronze_json
from test_handwritten import batch1, land, row


def _frame(spark):
    return spark.createDataFrame(
        [("a", 1.0, "x"), ("a", 150.0, None), ("b", None, "x"), (None, -1.0, None),
         (None, 5.0, "y")],
        "k string, rate double, t string",
    )


def test_rule_semantics(spark):
    rules = [
        Q.expect_unique("k"),
        Q.expect_not_null("t"),
        Q.expect_not_null("t", row_condition='k != "a"'),
        Q.expect_between("rate", 0, 100),
        Q.expect_between("rate", 0, None),
        Q.expect_unique("t"),
    ]
    got = [(r.rule_index, r.element_count, r.unexpected_count, r.success)
           for r in Q.run_suite(_frame(spark), rules).orderBy("rule_index").collect()]
    assert got == [
        (0, 5, 2, False),   # 'a' twice; NULLs are not duplicates
        (1, 5, 2, False),
        (2, 1, 0, True),    # domain: k = 'b' only (NULL k excluded)
        (3, 5, 2, False),   # 150 and -1; NULL not judged
        (4, 5, 1, False),
        (5, 5, 2, False),
    ]


def test_enforce_raises(spark):
    res = Q.run_suite(_frame(spark), [Q.expect_not_null("k"), Q.expect_not_null("rate")])
    with pytest.raises(Q.DataQualityError) as e:
        Q.enforce(res, "demo")
    assert e.value.failures[0]["column_name"] == "k"
    assert Q.enforce(Q.run_suite(_frame(spark), [Q.expect_not_null("t", 'k = "b"')]), "ok")


def test_empty_frame_passes(spark):
    empty = _frame(spark).limit(0)
    rows = Q.run_suite(empty, [Q.expect_unique("k"), Q.expect_not_null("t")]).collect()
    assert all(r.success and r.element_count == 0 for r in rows)


def test_gold_gate_blocks_only_failing_table(spark, scratch):
    db = "gate_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db)
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    before = {n: spark.table(T.gold_table(db, n)).count() for n in
              ("business_metrics", "marketing_funnel", "marketing_channel", "product_performance")}
    # two cart users but one viewer on a new day: view_to_cart_rate = 200
    b = [
        row("EVT100", "product_view", "P0001", user="U7", ts="2026-09-21T10:00:00"),
        row("EVT101", "add_to_cart", "P0001", user="U7", ts="2026-09-21T10:00:00"),
        row("EVT102", "add_to_cart", "P0001", user="U8", ts="2026-09-21T10:00:00"),
    ]
    with pytest.raises(T.GoldValidationError) as e:
        T.load_batch(spark, read_bronze_json(spark, land(scratch, b)), db)
    failed = set(e.value.report.gold_failures)
    assert failed == {"business_metrics", "marketing_funnel"}
    for name, n in e.value.report.gold_counts.items():
        assert n["written"] == (0 if name in failed else n["built"]) and n["built"] > 0
    for name, err in e.value.report.gold_failures.items():
        assert len(err.rows) == len(Q.SUITES[name]) > len(err.failures)
    # Silver took the batch, the failing Gold tables kept their old content,
    # the passing ones got the new day
    assert spark.table(T.silver_table(db)).count() == 9
    assert spark.table(T.gold_table(db, "business_metrics")).count() == before["business_metrics"]
    assert spark.table(T.gold_table(db, "marketing_channel")).count() == (
        before["marketing_channel"] + 1)


def test_silver_gate_writes_nothing(spark, scratch, monkeypatch):
    db = "sgate_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db)
    # make the Silver suite impossible to pass: require a column to be NULL-free
    # that the batch leaves NULL
    monkeypatch.setattr(Q, "SILVER_SUITE", Q.SILVER_SUITE + [Q.expect_not_null("product_id")])
    monkeypatch.setattr(T.Q, "SILVER_SUITE", Q.SILVER_SUITE)
    with pytest.raises(Q.DataQualityError):
        T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    assert spark.table(T.silver_table(db)).count() == 0
    assert spark.table(T.gold_table(db, "business_metrics")).count() == 0
