"""Random small batches: Spark equals a brute-force Python model."""

import datetime as dt

import model
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickvault.operators import gold as G
from clickvault.plans import silver as S
from clickvault.schemas import BRONZE, BRONZE_COLUMNS, SILVER_COLUMNS



def rare_none(values):
    # NULL in about one row of eight, so most rows survive the mandatory filter
    return st.sampled_from([*values, *values, *values, None]) if len(values) < 3 else \
        st.sampled_from([*values, None])


TEXT = rare_none(["a", "A", " a", "b ", "", "x y", "uNITED  states-of x "])
IDS = rare_none(["e1", "E1", " e1 ", "e2", "E3"])
GOOD_TS = st.builds(
    lambda d, m: (dt.datetime(2026, 9, 18) + dt.timedelta(days=d, minutes=m)).isoformat(),
    st.integers(0, 2), st.sampled_from([0, 1, 30, 1439]),
)
TS = st.one_of(GOOD_TS, GOOD_TS, GOOD_TS, GOOD_TS, GOOD_TS, GOOD_TS,
               st.just("not-a-date"), st.none())
TYPES = rare_none(["page_view", "Product_View", "add_to_cart ", "checkout", "purchase", "other"])
ROW = st.fixed_dictionaries({
    "event_id": IDS,
    "user_id": rare_none(["u1", "U1", "u2"]),
    "session_id": rare_none(["s1", "s2"]),
    "event_timestamp": TS,
    "ingestion_timestamp": TS,
    "event_type": TYPES,
    "product_id": rare_none(["p1", "P2"]),
    "device_type": TEXT,
    "platform": TEXT,
    "traffic_source": TEXT,
    "country": TEXT,
})


def _frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in BRONZE_COLUMNS) for r in rows], BRONZE)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=16))
def test_silver_and_business_metrics_match_model(spark, rows):
    bronze = _frame(spark, rows)
    silver = S.silver_clean(bronze)
    got = sorted(tuple(r[c] for c in SILVER_COLUMNS) for r in silver.collect())
    want = sorted(tuple(r[c] for c in SILVER_COLUMNS) for r in model.silver(rows))
    assert got == want
    for method in ("user_grain", "distinct"):
        gold = sorted(tuple(r) for r in G.business_metrics(silver, method).collect())
        assert gold == sorted(model.business_metrics(model.silver(rows)))


KEYS = st.sampled_from(["a", "b", "c", None])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(KEYS, st.integers(0, 5)), max_size=8),
       st.lists(st.tuples(KEYS, st.integers(6, 9)), max_size=6, unique_by=lambda t: t[0]))
def test_merge_matches_model(spark, target, source):
    from clickvault.operators.upsert import merge_frames

    t = spark.createDataFrame(target, "k string, v int")
    s = spark.createDataFrame(source, "k string, v int")
    got = sorted(map(tuple, merge_frames(t, s, ["k"]).collect()), key=repr)
    by_key = {k: v for k, v in source if k is not None}
    # every target row with a source row's (non-NULL) key is replaced, source rows
    # without a partner are inserted; NULL keys never match
    want = [(k, by_key.get(k, v)) for k, v in target]
    here = {k for k, _ in target}
    want += [(k, v) for k, v in source if k is None or k not in here]
    assert got == sorted(want, key=repr)


VALUES = st.one_of(st.none(), st.integers(-3, 120))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(KEYS, VALUES, st.sampled_from(["x", "y", None])), max_size=12))
def test_quality_rules_match_model(spark, rows):
    from clickvault.operators import quality as Q

    df = spark.createDataFrame(rows, "k string, v int, t string")
    rules = [Q.expect_unique("k"), Q.expect_not_null("v"),
             Q.expect_not_null("k", row_condition='t = "x"'),
             Q.expect_between("v", 0, 100), Q.expect_between("v", None, 10),
             Q.expect_unique("t", row_condition="v > 3")]
    got = [(r.element_count, r.unexpected_count, r.success)
           for r in Q.run_suite(df, rules).orderBy("rule_index").collect()]

    def unique(col, dom):
        vals = [r[col] for r in rows if dom(r)]
        dup = [x for x in vals if x is not None and vals.count(x) > 1]
        return len(vals), len(dup)

    everything = (lambda r: True)
    want = [
        unique(0, everything),
        (len(rows), sum(r[1] is None for r in rows)),
        (sum(r[2] == "x" for r in rows), sum(r[2] == "x" and r[0] is None for r in rows)),
        (len(rows), sum(r[1] is not None and not 0 <= r[1] <= 100 for r in rows)),
        (len(rows), sum(r[1] is not None and r[1] > 10 for r in rows)),
        unique(2, lambda r: r[1] is not None and r[1] > 3),
    ]
    assert got == [(e, u, u == 0) for e, u in want]
