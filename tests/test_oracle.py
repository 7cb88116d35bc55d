"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from clickvault import registry
from clickvault.oracle.compare import compare
from fixture_dirs import SF_SMALL

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert QUERIES.items() <= E.queries().items() and ORACLES.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(
        spark, duck_small, QUERIES[name], ORACLES[name], SF_SMALL, strict_order=True,
        exact_types=True,
    )
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "business_metric_key"


def test_fixture_stage_counts(spark):
    # measured counts of the bronze adapter (FIXTURES.md §5)
    r = QUERIES["silver_stage_counts"](spark, SF_SMALL).first().asDict()
    assert r == {
        "bronze_rows": 1020,
        "exact_duplicate_groups": 10,
        "after_exact_dedup": 1010,
        "repeated_event_ids": 10,
        "after_id_dedup": 1000,
        "after_mandatory_nulls": 989,
        "after_product_rule": 987,
    }


def test_fixture_measurements_sf001(spark):
    """The figures FIXTURES.md §5 records for the adapter at sf0.01."""
    from fixture_dirs import SF_MID

    counts = QUERIES["silver_stage_counts"](spark, SF_MID).first().asDict()
    assert list(counts.values()) == [10200, 100, 10100, 100, 10000, 9890, 9877]
    nulls = QUERIES["null_profile"](spark, SF_MID).first().asDict()
    assert (nulls["event_timestamp"], nulls["session_id"], nulls["user_id"]) == (10, 50, 50)
    late = {}
    for r in QUERIES["late_arrival_profile"](spark, SF_MID).collect():
        late[r.days_late] = late.get(r.days_late, 0) + r.events
    assert late == {0: 9620, 1: 7, 2: 250}
    rows = {n: QUERIES[n](spark, SF_MID).count() for n in (
        "gold_business_metrics", "gold_marketing_funnel", "gold_marketing_channel",
        "gold_product_performance")}
    assert list(rows.values()) == [120, 120, 840, 4590]


ROUNDING_QUERIES = sorted(
    n for n in ORACLES
    if n.startswith(("gold_", "rate_", "funnel_rates", "upsert_gold", "best_product"))
)


@pytest.fixture(scope="module")
def duck_mid():
    from clickvault.oracle.compare import duck_connect
    from fixture_dirs import SF_MID

    return duck_connect(SF_MID)


@pytest.mark.parametrize("name", ROUNDING_QUERIES)
def test_rate_queries_match_oracle_sf001(spark, duck_mid, name):
    """Rates and their rounding at the driver's correctness scale (sf0.01)."""
    from fixture_dirs import SF_MID

    ok, msg = compare(spark, duck_mid, QUERIES[name], ORACLES[name], SF_MID,
                      strict_order=True, exact_types=True)
    assert ok, f"{name}: {msg}"
