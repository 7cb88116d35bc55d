"""The table path in a plain session, as a submitted job gets it: no overwrite mode set."""

import os
import subprocess
import sys

from fixture_dirs import ROOT, SF_SMALL

JOB = """
import sys
from pyspark.sql import SparkSession
scratch, sf = sys.argv[1:]
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", scratch + "/ck")
         .config("spark.sql.warehouse.dir", scratch + "/wh").getOrCreate())
assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
from clickvault.plans import silver as S, tables as T
from clickvault.sources import fixture as FX
from clickvault.operators import gold as G
bronze = FX.bronze_view(spark, sf)
for db, buckets in (("plain", None), ("bucketed", 4)):
    T.create_tables(spark, db, silver_buckets=buckets)
    for batch in (FX.first_batch(bronze), FX.second_batch(bronze)):
        T.load_batch(spark, batch, db, raise_on_gold_failure=False)
    one_shot = S.silver_clean(bronze)
    silver = spark.table(T.silver_table(db))
    cols = [c for c in one_shot.columns]
    assert silver.count() == one_shot.count() == 987, silver.count()
    assert silver.select(*cols).exceptAll(one_shot).isEmpty()
    channel = spark.table(T.gold_table(db, "marketing_channel"))
    want = G.marketing_channel(one_shot)
    assert channel.count() == want.count() == 610, channel.count()
    assert channel.select(*want.columns).exceptAll(want).isEmpty()
print("DONE")
"""


def test_two_batches_equal_one_shot_in_a_plain_session(tmp_path):
    out = subprocess.run(
        [sys.executable, "-c", JOB, str(tmp_path), SF_SMALL], capture_output=True, text=True,
        cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, timeout=600)
    assert out.stdout.strip().endswith("DONE"), out.stderr[-2000:]
