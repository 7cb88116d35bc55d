"""Session settings and lineage cutting.

Lineage is cut only with reliable checkpoints in the folder the cluster
names in ``spark.checkpoint.dir`` (a shared file system). That folder is
read from the session; ``local_session`` sets one only when none is set,
which is the test/bench situation.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF, None
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder configured for this session."""
    sc = spark.sparkContext
    d = _configured_dir(spark)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if sc.getCheckpointDir() is not None:  # set on the context by the caller
        return sc.getCheckpointDir()
    raise RuntimeError(
        f"{CHECKPOINT_CONF} is not set; configure a folder on shared storage "
        "that every executor can reach"
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only on a local master that names none."""
    sc = spark.sparkContext
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickvault-"))
        return sc.getCheckpointDir()


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder of this library's own, in whatever store Spark reaches it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint_reliably(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "clickvault",
    scratch: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if not _configured_dir(spark) and sc.getCheckpointDir() is None:
        # only where none is set (local tests and bench): a cluster names
        # its shared folder itself
        base = scratch or tempfile.mkdtemp(prefix="clickvault-")
        sc.setCheckpointDir(os.path.join(base, "checkpoints"))
    checkpoint_dir(spark)
    return spark


MB = 1024 * 1024


def silver_buckets_for(daily_bytes: int, target_file_bytes: int = 128 * MB) -> int:
    """Bucket count so one bucket of one day is about one target-sized file.

    Rounded up to a power of two (bucket counts cannot change later without
    a rewrite, and powers of two let a table be joined with one built at
    half or double the count). At least 8.
    """
    n = max(8, -(-daily_bytes // target_file_bytes))
    return 1 << (n - 1).bit_length()


def recommended_conf(
    batch_bytes: int,
    total_cores: int,
    partition_bytes: int = 128 * MB,
) -> dict[str, str]:
    """Session settings for a batch of ``batch_bytes`` on ``total_cores``.

    Shuffle partitions start at max(batch / partition size, 3 x cores), so
    each reduce task handles about one partition's worth of data and spills
    rather than fails if a partition grows; AQE then coalesces small ones
    and splits skewed ones at run time. Scan splits and the advisory size
    use the same partition size.
    """
    shuffle = max(-(-batch_bytes // partition_bytes), 3 * total_cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
    }
