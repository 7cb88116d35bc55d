"""New landed files start the batch load (Structured Streaming).

A file-source stream over the landing folder sees each new JSON file once
(the source's file log lives in the stream's checkpoint). Each micro-batch
is handed to ``load_landed`` through ``foreachBatch``: the Silver/Gold logic
needs exact distinct counts and partition rewrites, which are batch
operations, and late events are never dropped, so no watermark is used. The files
of a micro-batch count in the order they landed, as if each were loaded alone, and
their unreadable lines go to the rejects table.

``available_now=True`` processes what has landed and stops (one scheduled
run per arrival window); ``False`` keeps polling every ``interval``.

Restart safety: if the driver dies after a micro-batch was written but
before the stream committed it, the batch is handed to ``load_landed`` again
on restart. The upsert by event_id and the whole-slice Gold refresh are
idempotent, and dates that had not reached a Gold table are refreshed with the batch.
"""

from __future__ import annotations

import os
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickvault.plans.tables import load_landed
from clickvault.session import checkpoint_dir
from clickvault.sources.bronze import CORRUPT, LANDED_SCHEMA, with_landing

KEPT_REPORTS = 100


def bronze_stream(
    spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files as ``read_landed`` reads them: rows with their files, unreadable lines as text."""
    reader = spark.readStream.schema(LANDED_SCHEMA).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_landing(reader.json(landing_dir))


def start_pickup(
    spark: SparkSession,
    landing_dir: str,
    database: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
    stop_on_gold_failure: bool = False,
    gold_database: str | None = None,
) -> StreamingQuery:
    """Start the landing-folder stream; returns the running query.

    A Silver validation failure stops the stream (the batch was not written
    and will be retried on restart). A Gold validation failure leaves that
    table's dates as they were and is recorded in the batch report; the
    stream goes on with the next files, as independent per-file runs would,
    unless ``stop_on_gold_failure``.
    """
    loc = checkpoint_location or os.path.join(
        checkpoint_dir(spark), "streams", f"{database}_bronze_pickup"
    )
    reports: deque = deque(maxlen=KEPT_REPORTS)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        reports.append(
            load_landed(
                batch.sparkSession, batch, database,
                raise_on_gold_failure=stop_on_gold_failure,
                gold_database=gold_database,
            )
        )

    writer = (
        bronze_stream(spark, landing_dir, max_files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", loc)
        .queryName(f"{database}_bronze_pickup")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval
    )
    query = writer.start()
    query.reports = reports  # the last batch reports of this driver, for callers/tests
    return query
