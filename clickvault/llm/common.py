"""Shared helpers of the operators: scratch tables, shared files, word hashing.

Intermediate tables and files go under the folder the session names in
``spark.checkpoint.dir`` (a file system all executors share). Tasks write
their files there through ``pyarrow.fs`` under a name of their own attempt,
and a materialised manifest names the files that count, so a retried or
speculative task never leaves a file that is read twice.
"""

from __future__ import annotations

import ctypes
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.session import checkpoint_dir, checkpoint_reliably


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder; a temporary one only on a local master without a setting."""
    sc = spark.sparkContext
    try:
        d = checkpoint_dir(spark)
    except RuntimeError:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickvault-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package once per context, as a zip in the shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_clickvault_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    uri = f"{scratch_uri(spark, 'package')}/clickvault.zip"
    fs, path = open_fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data.getvalue())
    sc.addPyFile(uri)
    sc._clickvault_shipped = True


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TASK_ROWS = 2_000  # rows handed to a Python task at a time while a table is written


class Scratch:
    """Parquet tables of one run below the shared folder, dropped together at its end."""

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark, self.root = spark, scratch_uri(spark, name)

    def uri(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: cuts the lineage, survives lost executors.

        The plan is not run again, so its shuffle files go as soon as the table is written.
        """
        conf = self.spark.conf
        want = {CLEAN_SHUFFLES: "true", ARROW_ROWS: str(TASK_ROWS)}
        before = {k: conf.get(k, None) for k in want}
        for k, v in want.items():
            conf.set(k, v)
        try:
            df.write.mode("overwrite").parquet(self.uri(name))
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(self.uri(name))

    def drop(self, name: str | None = None) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.uri(name) if name else self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)

    def finish(self, df: DataFrame) -> DataFrame:
        """Checkpoint the (small) result, then drop every table of the run."""
        out = checkpoint_reliably(df)
        self.drop()
        return out


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared URI (``file:/x`` and plain paths included)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name no other task attempt uses."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: functions that empty a memo of a worker process
MEMOS: list = []


def release_memory(memos: bool = False) -> None:
    """Give back to the system what Arrow and the C library keep for later in this worker.

    A worker goes on with tasks of other stages; with ``memos`` those that do not need what
    the last stage remembered drop it.
    """
    for empty in MEMOS if memos else ():
        empty()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run, rows: int | None = None):
    """A task function that starts without memos of other stages and ends without free memory.

    With ``rows`` it is given its batches in parts of so many rows at most.
    """
    def task(batches):
        release_memory(memos=True)
        yield from run(batches if rows is None else parts(batches, rows))
        release_memory()

    return task


def parts(batches, rows: int):
    """Arrow batches cut into parts of at most ``rows`` rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def number_rows(df: DataFrame, order: list, scratch: Scratch, name: str, col: str) -> DataFrame:
    """``df`` with the number of each row (from 1) in ``order``.

    The rows are range-sorted and written with their places in their ranges; only the
    ranges' counts, one row each, are added up outside. Rows of equal order in one hot
    group are split when ``order`` ends with a column that tells them apart.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(partitions_for(spark), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = scratch.write(
        ranges.withColumn("_range", F.spark_partition_id()).withColumn("_place", place), name)
    before, at = [], 0
    for r in placed.groupBy("_range").agg(F.max("_place").alias("last")).orderBy("_range").collect():
        before.append((r["_range"], at))
        at += r["last"] + 1
    base = spark.createDataFrame(before, "_range int, _before long")
    return placed.join(F.broadcast(base), "_range").withColumn(
        col, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")


# ------------------------------------------------------------------ Arrow text
CHUNK_BYTES = 1 << 18


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column, "")
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` text bytes (a longer row stands alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


# ---------------------------------------------------------------- word hashing
_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C13)
_INV = np.uint64(pow(int(_BASE), -1, 2**64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POW = {"b": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["b"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("b", _BASE), ("i", _INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["b"][:n], _POW["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray, offsets: np.ndarray,
               is_other: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word ``[^\\x20\\x09-\\x0D]+`` in the rows' bytes.

    ``is_other`` marks the bytes outside words where words are something else.
    """
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~is_other[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word
    ends[:-1] &= starts[1:] | ~ends[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word; ``lower`` folds A-Z first."""
    b, inv = _powers(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * b[: len(buf)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * inv[starts])


def combine_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Order-sensitive hash of several aligned hash arrays."""
    h = parts[0]
    for p in parts[1:]:
        h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + p)
    return h


# -------------------------------------------------------- connected components
def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long).

    ``component`` is the smallest node reachable. Each round maps every node
    to the smallest of itself and its neighbours (an aggregate that combines
    on the map side) and contracts the graph by that map, which at least
    halves the nodes that still have edges; the maps are then composed.
    """
    e = scratch.write(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), f"{name}-e0")
    maps, i = None, 0
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        m = scratch.write(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
            .select("node", F.least("node", "_m").alias("to")), f"{name}-m{i}")
        ma = m.select(F.col("node").alias("a"), F.col("to").alias("x"))
        mb = m.select(F.col("node").alias("b"), F.col("to").alias("y"))
        nxt = (e.join(ma, "a").join(mb, "b").where("x <> y")
               .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if maps is None:
            maps = m.select("node", F.col("to").alias("component"))
        else:
            step = m.select(F.col("node").alias("component"), F.col("to").alias("_n"))
            maps = maps.join(step, "component", "left").select(
                "node", F.coalesce("_n", "component").alias("component"))
        maps = scratch.write(maps, f"{name}-l{i}")
        i += 1
        e = scratch.write(nxt, f"{name}-e{i}")
    return maps if maps is not None else e.select(
        F.col("a").alias("node"), F.col("b").alias("component"))
