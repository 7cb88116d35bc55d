"""Measure the plan choices behind the defaults on larger synthetic data.

Not a registered query: it only times alternative plans of the same
operator on ``spark.range``-generated rows, where data work dominates the
per-stage overhead of the small test tables.

    python tools/scale_probe.py [rows]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def timed(df, repeat=3) -> float:
    df.write.format("noop").mode("overwrite").save()
    best = float("inf")
    for _ in range(repeat):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - t)
    return round(best, 2)


def main() -> None:
    from clickvault.operators import gold as G
    from clickvault.session import local_session

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = local_session(cores=8, scratch=tempfile.mkdtemp(prefix="probe-"))

    # id de-duplication: every key twice; then one key holding a third of rows
    rows = spark.range(n).select(
        (F.col("id") % (n // 2)).cast("string").alias("k"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0, id % 86400)")
        .alias("ing"),
        F.concat(F.lit("u"), (F.col("id") % 1000).cast("string")).alias("u"),
        F.concat(F.lit("s"), (F.col("id") % 7777).cast("string")).alias("s"),
    ).repartition(16).cache()
    rows.count()
    cols = ["ing", "u", "s"]
    order = W.partitionBy("k").orderBy(*[F.col(c).desc_nulls_last() for c in cols])
    hot = rows.withColumn("k", F.when(F.col("u") < "u4", F.lit("HOT")).otherwise(F.col("k")))
    for label, df in (("uniform", rows), ("one hot key", hot)):
        agg = timed(df.groupBy("k").agg(F.max(F.struct(*cols)).alias("m")))
        win = timed(df.withColumn("rn", F.row_number().over(order)).where("rn = 1"))
        print(f"id dedup, {label}: max(struct) {agg}s, window row_number {win}s", flush=True)

    # Gold: user-grain plan vs count(DISTINCT) (Expand)
    types = F.array(*[F.lit(t) for t in
                      ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]])
    events = spark.range(n).select(
        F.expr("date'2026-09-19' + cast(id % 7 as int)").alias("event_date"),
        F.when(F.col("id") % 10 < 8, F.lit("India")).otherwise(F.lit("Brazil")).alias("country"),
        F.concat(F.lit("U"), ((F.col("id") * 7919) % 200000).cast("string")).alias("user_id"),
        F.concat(F.lit("S"), ((F.col("id") * 104729) % 600000).cast("string")).alias("session_id"),
        F.element_at(types, (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
        F.concat(F.lit("P"), (F.col("id") % 500).cast("string")).alias("product_id"),
        F.concat(F.lit("src"), (F.col("id") % 6).cast("string")).alias("traffic_source"),
    ).repartition(16).cache()
    events.count()
    for name in ("business_metrics", "marketing_channel", "product_performance"):
        a = timed(G.BUILDERS[name](events, "user_grain"))
        b = timed(G.BUILDERS[name](events, "distinct"))
        print(f"gold {name}: user_grain {a}s, count(DISTINCT) {b}s", flush=True)

    # refresh of channel + business + funnel: three builds vs one rolled-up level
    def three_builds():
        for build in (G.marketing_channel, G.business_metrics, G.marketing_funnel):
            build(events).write.format("noop").mode("overwrite").save()

    def one_level():
        level = G.stage_level(events, G.CHANNEL.grain, True).persist()
        G.channel_from_metrics(G.stage_measures(level, G.CHANNEL.grain, True)) \
            .write.format("noop").mode("overwrite").save()
        day = G.stage_measures(G.rollup_level(level, G.BUSINESS.grain), G.BUSINESS.grain, True)
        day = day.persist()
        G.business_from_metrics(day).write.format("noop").mode("overwrite").save()
        G.funnel_from_metrics(day.drop("total_sessions", "total_events")) \
            .write.format("noop").mode("overwrite").save()
        day.unpersist()
        level.unpersist()

    for label, fn in (("three builds", three_builds), ("one rolled-up level", one_level)):
        fn()
        t = time.perf_counter()
        fn()
        print(f"refresh channel+business+funnel, {label}: {time.perf_counter() - t:.2f}s",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
