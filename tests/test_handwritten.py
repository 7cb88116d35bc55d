"""The 16-row handwritten batch and its follow-up batches (FIXTURES.md §6),
landed as JSON lines and loaded into real partitioned tables."""

import contextlib
import datetime as dt
import io
import json
import os
import uuid

import pytest

from clickvault.plans import silver as S
from clickvault.plans import tables as T
from clickvault.operators import gold as G
from clickvault.schemas import SILVER_MANDATORY
from clickvault.sources.bronze import read_bronze_json

DAY = "2026-09-19"


def _one_minute_later(ts):
    try:
        return (dt.datetime.fromisoformat(ts) + dt.timedelta(minutes=1)).isoformat()
    except (TypeError, ValueError):
        return ts


def row(event_id, event_type, product=None, *, user="U1", session="S1", ts=f"{DAY}T10:00:00",
        ingested=None, device="mobile", platform="web", source="google", country="India",
        **drop):
    """One bronze record; defaults as in FIXTURES.md §6. ``drop`` names
    columns to set to NULL (e.g. ``user_id=None``); ingestion defaults to one
    minute after the event."""
    r = {
        "event_id": event_id,
        "user_id": user,
        "session_id": session,
        "event_timestamp": ts,
        "ingestion_timestamp": ingested or _one_minute_later(ts),
        "event_type": event_type,
        "product_id": product,
        "device_type": device,
        "platform": platform,
        "traffic_source": source,
        "country": country,
    }
    for k in drop:
        r[k] = None
    return r


def batch1():
    p2 = row("EVT002", "product_view", "P0001")
    return [
        row(" evt001 ", "Page_View ", None, country=" india", platform="IOS"),
        p2,
        dict(p2),
        dict(p2, event_id="evt002"),
        row("EVT003", "add_to_cart", "P0001", ingested=f"{DAY}T10:05:00"),
        row("EVT003", "add_to_cart", "P0002", ingested=f"{DAY}T10:09:00"),
        row("EVT004", "product_view", "P0001", user_id=None),
        row("EVT005", "product_view", "P0001", session_id=None),
        row("EVT006", "product_view", "P0001", ingested=f"{DAY}T10:01:00", event_timestamp=None),
        row("EVT007", "purchase", None),
        row("EVT008", "page_view", "P0009"),
        row("EVT009", "checkout", "P0001", country=None, device=None, platform=None, source=None),
        row("EVT010", "purchase", "P0001", country=""),
        row(None, "product_view", "P0001"),
        row(None, "product_view", "P0002"),
        row("EVT011", "product_view", "P0001", ts="not-a-date", ingested=f"{DAY}T10:01:00"),
    ]


def land(scratch, rows):
    d = os.path.join(scratch, "landing", uuid.uuid4().hex)
    os.makedirs(d)
    with open(os.path.join(d, "batch.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return d


def test_silver_stages_and_values(spark, scratch):
    bronze = read_bronze_json(spark, land(scratch, batch1()))
    counts = S.stage_counts(bronze).first().asDict()
    assert counts == {
        "bronze_rows": 16,
        "exact_duplicate_groups": 1,
        "after_exact_dedup": 14,
        "repeated_event_ids": 2,
        "after_id_dedup": 12,
        "after_mandatory_nulls": 7,
        "after_product_rule": 6,
    }
    silver = {r.event_id: r for r in S.silver_clean(bronze).collect()}
    assert sorted(silver) == ["EVT001", "EVT002", "EVT003", "EVT008", "EVT009", "EVT010"]
    e1 = silver["EVT001"]
    assert (e1.event_type, e1.country, e1.platform, e1.product_id) == (
        "page_view", "India", "ios", None)
    assert silver["EVT003"].product_id == "P0002"  # latest ingestion survives
    assert silver["EVT008"].product_id == "P0009"
    e9 = silver["EVT009"]
    assert (e9.country, e9.device_type, e9.platform, e9.traffic_source) == (
        "unknown", "unknown", "others", "others")
    assert silver["EVT010"].country == ""
    assert silver["EVT001"].event_timestamp == dt.datetime(2026, 9, 19, 10, 0)
    assert silver["EVT001"].event_date == dt.date(2026, 9, 19)


def test_gold_values(spark, scratch):
    silver = S.silver_clean(read_bronze_json(spark, land(scratch, batch1())))
    for method in ("user_grain", "distinct"):
        bm = {r.country: r for r in G.business_metrics(silver, method).collect()}
        got = {
            c: (r.total_users, r.total_sessions, r.total_events, r.product_viewers,
                r.cart_users, r.checkout_users, r.purchasers, r.view_to_cart_rate,
                r.cart_to_checkout_rate, r.checkout_to_purchase_rate)
            for c, r in bm.items()
        }
        assert got == {
            "India": (1, 1, 4, 1, 1, 0, 0, 100.0, 0.0, 0.0),
            "unknown": (1, 1, 1, 0, 0, 1, 0, 0.0, 0.0, 0.0),
            "": (1, 1, 1, 0, 0, 0, 1, 0.0, 0.0, 0.0),
        }
        pp = {(r.country, r.product_id): r for r in G.product_performance(silver, method).collect()}
        assert sorted(pp) == [("", "P0001"), ("India", "P0001"), ("India", "P0002"),
                              ("India", "P0009"), ("unknown", "P0001")]
        bought = pp[("", "P0001")]
        assert (bought.unique_purchasers, bought.unique_product_viewers, bought.purchase_rate) == (
            1, 0, 0.0)


def _silver_rows(spark, db):
    return {r.event_id: r for r in spark.table(T.silver_table(db)).collect()}


def _gold(spark, db, name):
    return {
        tuple(getattr(r, c) for c in ("event_date", "country")): r
        for r in spark.table(T.gold_table(db, name)).collect()
    }


def test_table_loads_late_and_moved_events(spark, scratch):
    db = "hw_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db)
    rep = T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db,
                       with_stage_counts=True)
    assert rep.touched_dates == [dt.date(2026, 9, 19)]
    assert rep.observed == {"bronze_rows": 16, "after_id_dedup": 12,
                            "after_mandatory_nulls": 7, "after_product_rule": 6}
    assert rep.defects.pop("product_rule_violations") == 7 - 6
    assert set(rep.defects) == {f"null_{c}" for c in SILVER_MANDATORY}
    assert max(rep.defects.values()) <= 12 - 7 <= sum(rep.defects.values())
    assert set(rep.gold_counts) == set(T.GOLD_SPECS)
    for name, n in rep.gold_counts.items():
        assert n["slice_rows"] == 6
        assert n["built"] == n["written"] == spark.table(T.gold_table(db, name)).count()
    assert rep.stage_counts["exact_duplicate_groups"] == 1
    assert len(_silver_rows(spark, db)) == 6
    assert all(r.data_transformed_ingested_timestamp is not None
               for r in _silver_rows(spark, db).values())
    d19, d18 = dt.date(2026, 9, 19), dt.date(2026, 9, 18)
    assert _gold(spark, db, "business_metrics")[(d19, "India")].product_viewers == 1

    b2 = [
        row("EVT002", "product_view", "P0001", country="Brazil", ingested="2026-09-20T08:00:00"),
        row("EVT012", "product_view", "P0003", ts="2026-09-18T23:00:00",
            ingested="2026-09-20T08:00:00"),
    ]
    path2 = land(scratch, b2)
    rep = T.load_batch(spark, read_bronze_json(spark, path2), db)
    assert rep.touched_dates == [d18, d19]
    silver = _silver_rows(spark, db)
    assert len(silver) == 7 and silver["EVT002"].country == "Brazil"
    bm = _gold(spark, db, "business_metrics")
    assert bm[(d19, "India")].product_viewers == 0
    assert bm[(d19, "Brazil")].product_viewers == 1
    assert (d18, "India") in bm
    snapshot = {k: v.asDict() for k, v in bm.items()}

    # the same batch again changes nothing
    T.load_batch(spark, read_bronze_json(spark, path2), db)
    assert len(_silver_rows(spark, db)) == 7
    assert {k: v.asDict() for k, v in _gold(spark, db, "business_metrics").items()} == snapshot

    # EVT009 moves to 09-17: its old date is refreshed and (09-19, unknown) goes away
    b3 = [row("EVT009", "checkout", "P0001", ts="2026-09-17T10:00:00", country=None,
              device=None, platform=None, source=None, ingested="2026-09-20T09:00:00")]
    rep = T.load_batch(spark, read_bronze_json(spark, land(scratch, b3)), db)
    assert rep.touched_dates == [dt.date(2026, 9, 17), d19]
    bm = _gold(spark, db, "business_metrics")
    assert (d19, "unknown") not in bm and (dt.date(2026, 9, 17), "unknown") in bm

    # and to 09-16: 09-17 is emptied and its partition must disappear
    b4 = [row("EVT009", "checkout", "P0001", ts="2026-09-16T10:00:00",
              ingested="2026-09-20T10:00:00")]
    T.load_batch(spark, read_bronze_json(spark, land(scratch, b4)), db)
    silver = _silver_rows(spark, db)
    assert len(silver) == 7
    assert silver["EVT009"].event_date == dt.date(2026, 9, 16)
    bm = _gold(spark, db, "business_metrics")
    assert not any(k[0] == dt.date(2026, 9, 17) for k in bm)
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {T.silver_table(db)}").collect()]
    assert "event_date=2026-09-17" not in parts


def test_manifest():
    assert T.parse_manifest(" 2026-09-19, 2026-09-18 ,2026-09-19") == [
        dt.date(2026, 9, 18), dt.date(2026, 9, 19)]
    with pytest.raises(KeyError):
        T.parse_manifest("")
    with pytest.raises(KeyError):
        T.parse_manifest(None)
    assert T.format_manifest([dt.date(2026, 9, 19), dt.date(2026, 9, 18)]) == (
        "2026-09-18,2026-09-19")


def test_scan_silver_dates_prunes_partitions(spark, scratch):
    db = "scan_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db)
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    df = T.scan_silver_dates(spark, db, [dt.date(2026, 9, 19)])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [(event_date" in plan
    assert "user_interactions_processed/event_date=2026-09-19]" in plan
    assert df.count() == 6


def test_bucketed_silver_is_not_shuffled_for_the_id_lookup(spark, scratch):
    from clickvault.operators.upsert import matched_partition_values, table_buckets

    db = "bk_" + uuid.uuid4().hex[:8]
    # more buckets than shuffle partitions, as on a cluster: Spark then keeps
    # the table's bucketing and moves only the batch
    T.create_tables(spark, db, silver_buckets=16)
    assert table_buckets(spark, T.silver_table(db)) == (16, ["event_id"])
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    batch = S.silver_clean(read_bronze_json(spark, land(scratch, batch1())))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = matched_partition_values(
            spark.table(T.silver_table(db)), batch, ["event_id"], "event_date")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            lookup.explain()
        lines = buf.getvalue().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    scan = next(i for i, ln in enumerate(lines) if "user_interactions_processed" in ln)
    assert "Bucketed: true" in lines[scan]
    assert not any("Exchange" in ln for ln in lines[join:scan])


def test_empty_batch_changes_nothing(spark, scratch):
    db = "empty_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db)
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    before = sorted(tuple(r) for r in spark.table(T.gold_table(db, "business_metrics")).collect())
    rep = T.load_batch(spark, read_bronze_json(spark, land(scratch, [])), db,
                       with_stage_counts=True)
    assert rep.touched_dates == [] and rep.observed["bronze_rows"] == 0
    assert set(rep.stage_counts.values()) == {0}
    assert len(_silver_rows(spark, db)) == 6
    after = sorted(tuple(r) for r in spark.table(T.gold_table(db, "business_metrics")).collect())
    assert after == before


def test_bucketed_upsert_writes_one_file_per_bucket_and_date(spark, scratch):
    import glob

    db = "bf_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db, silver_buckets=16)
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    b2 = [row("EVT002", "product_view", "P0001", country="Brazil", ingested="2026-09-20T08:00:00"),
          row("EVT012", "product_view", "P0003", ts="2026-09-18T23:00:00",
              ingested="2026-09-20T08:00:00")]
    T.load_batch(spark, read_bronze_json(spark, land(scratch, b2)), db)
    silver = _silver_rows(spark, db)
    assert len(silver) == 7 and silver["EVT002"].country == "Brazil"
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {T.silver_table(db)}").where(
        "col_name = 'Location'").first()["data_type"].removeprefix("file:")
    for part in glob.glob(os.path.join(location, "event_date=*")):
        files = glob.glob(os.path.join(part, "*.parquet"))
        # at most one file per bucket, and no more than rows in the date
        assert 0 < len(files) <= 16, (part, len(files))


def test_bucketed_merge_plan_moves_only_the_batch(spark, scratch):
    from clickvault.operators.upsert import merge_frames

    db = "bm_" + uuid.uuid4().hex[:8]
    T.create_tables(spark, db, silver_buckets=16)
    T.load_batch(spark, read_bronze_json(spark, land(scratch, batch1())), db)
    batch = S.with_load_timestamp(S.silver_clean(read_bronze_json(spark, land(scratch, batch1()))))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_frames(spark.table(T.silver_table(db)), batch, ["event_id"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            merged.explain()
        lines = buf.getvalue().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = next(i for i, ln in enumerate(lines) if "FullOuter" in ln)
    scan = next(i for i, ln in enumerate(lines) if "user_interactions_processed" in ln)
    assert "Bucketed: true" in lines[scan]
    assert not any("Exchange" in ln for ln in lines[join:scan])
