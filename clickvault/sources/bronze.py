"""Landed JSON-lines batches (bronze), with what cannot be read kept apart.

The schema is fixed and all text, never inferred: inference costs an extra pass over
the files, and a single malformed line would change the column set. Numbers in the
JSON are kept as their text. Partition-style folders (``ingestion_date=...``) would
add a column by partition discovery; the projections keep the fixed layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickvault.schemas import BRONZE, BRONZE_COLUMNS

CORRUPT = "_corrupt_record"
LANDED = "_landed"  # (modification time, file): the order in which files came
LANDED_SCHEMA = T.StructType([*BRONZE.fields, T.StructField(CORRUPT, T.StringType(), True)])
REJECT_COLUMNS = ["file", "line", "reason", "fields"]


def read_bronze_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The eleven bronze columns of JSON-lines files; a malformed line is an all-NULL row.

    The mandatory-column filter then removes such a row. ``read_landed`` tells it apart.
    """
    return spark.read.schema(BRONZE).option("mode", "PERMISSIVE").json(path).select(
        *BRONZE_COLUMNS
    )


def with_landing(files: DataFrame) -> DataFrame:
    """Rows read by ``LANDED_SCHEMA``, each with the file it came in and its place in time."""
    return files.select(
        *BRONZE_COLUMNS, CORRUPT,
        F.struct(F.col("_metadata.file_modification_time").alias("at"),
                 F.col("_metadata.file_path").alias("file")).alias(LANDED))


def read_landed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Bronze columns, the text of a line that is no JSON object, and the file of each row."""
    reader = spark.read.schema(LANDED_SCHEMA).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT)
    return with_landing(reader.json(path))


def accepted(landed: DataFrame) -> DataFrame:
    """The rows of readable lines, with their files."""
    return landed.where(F.col(CORRUPT).isNull()).select(*BRONZE_COLUMNS, LANDED)


def rejects(landed: DataFrame) -> DataFrame:
    """file, line, reason and number of fields read of every line that could not be read in full."""
    line = F.trim(CORRUPT)
    reason = F.when(~line.startswith("{"), "no object").when(
        ~line.endswith("}"), "cut off").otherwise("malformed")
    fields = F.size(F.array_compact(F.array(*BRONZE_COLUMNS)))
    return landed.where(F.col(CORRUPT).isNotNull()).select(
        F.col(f"{LANDED}.file").alias("file"), F.col(CORRUPT).alias("line"), reason.alias("reason"),
        fields.alias("fields"))


def write_bronze_json(df: DataFrame, path: str) -> None:
    """Land a bronze DataFrame as JSON lines (used by tests and replays)."""
    df.write.mode("overwrite").json(path)
