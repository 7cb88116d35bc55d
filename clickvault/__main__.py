"""Job entry points, for ``spark-submit`` or ``python -m clickvault``.

    load     --database lake --input /landing/2026-09-19/      bronze -> Silver -> Gold
    refresh  --database lake --dates 2026-09-18,2026-09-19     Gold slices from a manifest
    pickup   --database lake --landing /landing/ [--continuous] new files, once each

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
catalog and ``spark.checkpoint.dir`` are whatever the submitting cluster
configures. ``load`` prints the touched-date manifest that ``refresh``
takes, the hand-over between the Silver and Gold jobs.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickvault")
    sub = p.add_subparsers(dest="cmd", required=True)
    p.add_argument("--silver-buckets", type=int,
                   help="buckets of a Silver table that is created by this run")
    p.add_argument("--daily-bytes", type=int,
                   help="expected Silver volume a day, to choose the buckets from")
    load = sub.add_parser("load", help="load one landed bronze batch")
    load.add_argument("--database", required=True)
    load.add_argument("--input", required=True, nargs="+")
    load.add_argument("--stage-counts", action="store_true")
    load.add_argument("--gold-database")
    load.add_argument("--silver-only", action="store_true",
                      help="stop after Silver; print the manifest for `refresh`")
    ref = sub.add_parser("refresh", help="refresh Gold for a touched-date manifest")
    ref.add_argument("--database", required=True)
    ref.add_argument("--dates", required=True)
    ref.add_argument("--gold-database")
    pick = sub.add_parser("pickup", help="process new files of a landing folder")
    pick.add_argument("--database", required=True)
    pick.add_argument("--landing", required=True)
    pick.add_argument("--continuous", action="store_true")
    pick.add_argument("--max-files-per-trigger", type=int)
    pick.add_argument("--gold-database")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from clickvault.plans import tables as T
    from clickvault.session import silver_buckets_for
    from clickvault.sources.bronze import read_bronze_json
    from clickvault.streaming.pickup import start_pickup

    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"clickvault-{args.cmd}").getOrCreate()
    buckets = args.silver_buckets
    if buckets is None and args.daily_bytes is not None:
        buckets = silver_buckets_for(args.daily_bytes)
    T.create_tables(
        spark, args.database, silver_buckets=buckets, gold_database=args.gold_database
    )
    if args.cmd == "load":
        rep = T.load_batch(
            spark,
            read_bronze_json(spark, args.input),
            args.database,
            with_stage_counts=args.stage_counts,
            raise_on_gold_failure=False,
            gold_database=args.gold_database,
            silver_only=args.silver_only,
        )
        out = {
            "processed_dates": T.format_manifest(rep.touched_dates),
            "observed": rep.observed,
            "defects": rep.defects,
            "gold_counts": rep.gold_counts,
            "stage_counts": rep.stage_counts,
            "gold_failures": {k: str(v) for k, v in rep.gold_failures.items()},
        }
    elif args.cmd == "refresh":
        dates = T.parse_manifest(args.dates)
        suites, failures = T.refresh_gold(
            spark, args.database, dates, gold_database=args.gold_database
        )
        out = {
            "refreshed": sorted(suites),
            "gold_failures": {k: str(v) for k, v in failures.items()},
        }
    else:
        q = start_pickup(
            spark,
            args.landing,
            args.database,
            available_now=not args.continuous,
            max_files_per_trigger=args.max_files_per_trigger,
            gold_database=args.gold_database,
        )
        q.awaitTermination()
        failures = [(i, t, str(e)) for i, r in enumerate(q.reports)
                    for t, e in sorted(r.gold_failures.items())]
        out = {
            "batches": len(q.reports),
            "gold_failures": {f"batch {i}: {t}": e for i, t, e in failures},
        }
    print(json.dumps(out, default=str))
    if out.get("gold_failures"):
        out["exit_code"] = 2
    return out


if __name__ == "__main__":
    import logging

    logging.basicConfig(level=logging.INFO, format="[%(name)s] %(message)s (%(levelname)s)")
    result = main()
    sys.exit(result.get("exit_code", 0))
