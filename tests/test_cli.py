"""Job entry points: load prints the manifest that refresh takes."""

import uuid

from clickvault.__main__ import main
from clickvault.plans import tables as T
from test_handwritten import batch1, land


def test_load_then_refresh(spark, scratch, capsys):
    db = "cli_" + uuid.uuid4().hex[:8]
    out = main(["load", "--database", db, "--input", land(scratch, batch1()), "--stage-counts"],
               spark=spark)
    assert out["processed_dates"] == "2026-09-19"
    assert out["observed"]["after_product_rule"] == 6
    assert out["stage_counts"]["bronze_rows"] == 16
    assert not out["gold_failures"]
    assert spark.table(T.silver_table(db)).count() == 6
    out = main(["refresh", "--database", db, "--dates", out["processed_dates"]], spark=spark)
    assert out["refreshed"] == sorted(
        ["business_metrics", "marketing_funnel", "marketing_channel", "product_performance"])
    assert '"refreshed"' in capsys.readouterr().out

    # analysts query the tables with SQL through registered views
    from clickvault.plans import analyst_sql as AS

    AS.register_table_views(spark, db)
    days = AS.run(spark, "days_by_purchasers").collect()
    assert [(str(r.event_date), r.purchasers) for r in days] == [("2026-09-19", 1)]


def test_separate_gold_database(spark, scratch):
    silver_db, gold_db = "s_" + uuid.uuid4().hex[:8], "g_" + uuid.uuid4().hex[:8]
    out = main(["load", "--database", silver_db, "--gold-database", gold_db,
                "--input", land(scratch, batch1())], spark=spark)
    assert out["processed_dates"] == "2026-09-19"
    assert spark.table(T.gold_table(gold_db, "business_metrics")).count() == 3
    assert not spark.catalog.tableExists(T.gold_table(silver_db, "business_metrics"))


def test_silver_job_then_gold_job(spark, scratch):
    db = "two_" + uuid.uuid4().hex[:8]
    out = main(["load", "--database", db, "--silver-only", "--input", land(scratch, batch1())],
               spark=spark)
    assert spark.table(T.silver_table(db)).count() == 6
    assert spark.table(T.gold_table(db, "business_metrics")).count() == 0
    main(["refresh", "--database", db, "--dates", out["processed_dates"]], spark=spark)
    assert spark.table(T.gold_table(db, "business_metrics")).count() == 3
