"""The SQL form of the analyst questions equals the DataFrame form."""

import pytest

from clickvault.operators import gold as G
from clickvault.plans import analyst as A
from clickvault.plans import analyst_sql as AS
from clickvault.plans import silver as S
from clickvault.sources import fixture as FX
from fixture_dirs import SF_SMALL

GOLD_INPUT = {
    "top_products_by_purchases": "product_performance",
    "best_product_rate_per_day": "product_performance",
    "high_views_low_purchases": "product_performance",
    "users_by_source": "marketing_channel",
    "purchasers_by_source": "marketing_channel",
    "sessions_by_source": "marketing_channel",
    "users_by_source_exact": "silver",
    "sessions_by_source_exact": "silver",
    "funnel_users_per_day": "marketing_funnel",
    "funnel_rates_per_day": "marketing_funnel",
    "days_by_purchasers": "business_metrics",
    "late_arrival_profile": "silver",
}


@pytest.fixture(scope="module")
def frames(spark):
    silver = S.silver_clean(FX.bronze_view(spark, SF_SMALL)).cache()
    f = {"silver": silver}
    for name, build in G.BUILDERS.items():
        f[name] = build(silver).cache()
    AS.register_views(spark, f)
    return f


@pytest.mark.parametrize("question", sorted(AS.ANALYST_SQL))
def test_sql_equals_dataframe(spark, frames, question):
    via_sql = AS.run(spark, question)
    via_df = getattr(A, question)(frames[GOLD_INPUT[question]])
    assert via_sql.columns == via_df.columns
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))


def test_unknown_view_rejected(spark, frames):
    with pytest.raises(KeyError):
        AS.register_views(spark, {"nope": frames["silver"]})
