"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one, centred on the mean of all, padded and
turned by a fixed random rotation; the signs of the result, packed to bits, are
its code. Two scalars correct the estimate: the length of the centred vector and
the cosine between it and its code. The inner product of a query with a vector
is estimated from the bits and these scalars, and its error is bounded (with
high probability; ``epsilon`` sets how high). A vector is reranked with its
original components, in double precision, when its upper bound reaches the
query's k-th best so far, where the k-th best lower bound counts as well.

The index is one table over all rows. Each task scans its part of it once
per block of queries, read from the shared folder, and gives out its k best per
query; these are merged by a ranked window with a partial limit before the
shuffle. Nothing is broadcast but the mean, and no pair is listed that the
bounds rule out.

Vectors that are null, zero, hold null or non-finite components or have not
the most frequent length (the larger one on ties) take no part, nor do rows
without id. A query's candidates are all rows of another id; rows that repeat
an id stand for themselves as candidates and are one query (the first by its
components). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch, open_fs

EPSILON = 1.9
SEED = 7
QUERY_BLOCK = 1024
CHUNK = 4096


def rotation(dim: int, code_bits: int) -> np.ndarray:
    """The first ``dim`` columns of a random orthogonal matrix of ``code_bits`` rows."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((code_bits, code_bits)))
    return (q * np.sign(np.diag(r)))[:, :dim].astype(np.float64)


def code_bits_for(dim: int) -> int:
    """Twice the dimension, in whole 64-bit words."""
    return max(64, -(-2 * dim // 64) * 64)


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), fine.alias("_f"))
    rows = rows.where("vec_id is not null and v is not null and _f").drop("_f").where(
        F.exists("v", lambda x: x != 0))
    best = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (best["d"] if best else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten()).reshape(n, -1) if n else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    # scaling first keeps the squares of very large or small components finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sums(batches):
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            u = _unit(_matrix(batch.column("v")))
            total = u.sum(axis=0) if total is None else total + u.sum(axis=0)
            n += len(u)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(total), pa.array([n] * len(total))],
            names=["i", "s", "n"])


def encode(x: np.ndarray, mean: np.ndarray, turn: np.ndarray):
    """(packed codes, length of the centred vector, cosine to the code) of each row."""
    r = _unit(x) - mean
    length = np.sqrt((r * r).sum(axis=1))
    o = (r / np.where(length > 0, length, 1)[:, None]) @ turn.T
    bits = o > 0
    cosine = np.abs(o).sum(axis=1) / np.sqrt(turn.shape[0])
    return np.packbits(bits, axis=1), length, np.maximum(cosine, 1e-6)


def _index(mean: np.ndarray):
    def run(batches):
        turn = rotation(len(mean), code_bits_for(len(mean)))
        for batch in batches:
            if not batch.num_rows:
                continue
            code, length, cosine = encode(_matrix(batch.column("v")), mean, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"),
                 pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(length), pa.array(cosine)],
                names=["vec_id", "v", "code", "length", "cosine"])

    return run


def build_index(vectors: DataFrame, sc: Scratch) -> tuple[DataFrame, np.ndarray]:
    """Index table over all ``vectors`` and their mean direction."""
    sums = (vectors.select("v").mapInArrow(_sums, "i int, s double, n long")
            .groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    mean = np.array([r["s"] / r["n"] for r in sums])
    schema = "vec_id long, v array<double>, code binary, length double, cosine double"
    return sc.write(vectors.mapInArrow(_index(mean), schema), "index"), mean


class Best:
    """The k best (score, id) of each query of a block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        n = len(self.score)
        rows = np.concatenate([np.repeat(np.arange(n), self.k), q])
        s = np.concatenate([self.score.ravel(), score])
        i = np.concatenate([self.id.ravel(), ids])
        order = np.lexsort((i, -s, rows))
        rows, s, i = rows[order], s[order], i[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        self.score, self.id = s[keep].reshape(n, self.k), i[keep].reshape(n, self.k)


def cosine_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def search_block(qid, qv, ids, vecs, code, length, cosine, mean, turn, k, epsilon, best):
    """Scan indexed vectors for a block of queries, chunk by chunk; returns how many were reranked."""
    bits = turn.shape[0]
    qu = _unit(qv)
    turned = (qu @ turn.T).astype(np.float32) / np.float32(np.sqrt(bits))
    base = qu @ mean
    reranked = 0
    for a in range(0, len(ids), CHUNK):
        b = min(a + CHUNK, len(ids))
        signs = np.unpackbits(code[a:b], axis=1).astype(np.float32) * 2 - 1
        scale = (length[a:b] / cosine[a:b])[None, :]
        estimate = (turned @ signs.T) * scale + base[:, None]
        off = np.sqrt(np.maximum(1 - cosine[a:b] ** 2, 0) / cosine[a:b] ** 2 / (bits - 1))
        error = (epsilon * off * length[a:b] + 1e-5)[None, :]
        own = qid[:, None] == ids[a:b][None, :]
        estimate[own] = -np.inf
        least = best.score[:, -1]
        if b - a >= k:
            lower = np.partition(estimate - error, b - a - k, axis=1)[:, b - a - k]
            least = np.maximum(least, lower)
        near = (estimate + error >= least[:, None]) & ~own
        q, v = np.nonzero(near)
        reranked += len(q)
        for s in range(0, len(q), 1 << 16):
            qs, vs = q[s : s + (1 << 16)], v[s : s + (1 << 16)] + a
            best.add(qs, ids[vs], cosine_pairs(qv[qs], vecs[vs]))
    return reranked


def _query_blocks(uri: str, block: int):
    fs, base = open_fs(uri)
    for info in sorted(fs.get_file_info(pafs.FileSelector(base)), key=lambda f: f.path):
        if info.is_file and info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(block, columns=["vec_id", "v"]):
                    if batch.num_rows:
                        yield np.asarray(batch.column("vec_id")), _matrix(batch.column("v"))


def _search(uri: str, mean: np.ndarray, k: int, epsilon: float, block: int):
    def run(batches):
        turn = rotation(len(mean), code_bits_for(len(mean)))
        parts = [(np.asarray(b.column("vec_id")), _matrix(b.column("v")).astype(np.float64),
                  np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8)
                  .reshape(b.num_rows, -1), np.asarray(b.column("length")),
                  np.asarray(b.column("cosine"))) for b in batches if b.num_rows]
        if not parts:
            return
        cols = [np.concatenate(c) for c in zip(*parts)]
        del parts
        for qid, qv in _query_blocks(uri, block):
            best = Best(len(qid), k)
            n = search_block(qid, qv, *cols, mean, turn, k, epsilon, best)
            found = np.isfinite(best.score)
            q = np.repeat(qid, k).reshape(-1, k)[found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array(best.id[found]), pa.array(best.score[found]),
                 pa.array([n] + [0] * (len(q) - 1), pa.int64()) if len(q) else pa.array([], pa.int64())],
                names=["query_id", "vec_id", "score", "reranked"])

    return run


def nearest(table: DataFrame, is_query, k: int = 5, epsilon: float = EPSILON,
            id_col: str = "vec_id", vec_col: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by cosine of the rows where ``is_query``.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = table.sparkSession
    sc = Scratch(spark, "onebit")
    vectors = valid_vectors(table, id_col, vec_col)
    index, mean = build_index(vectors, sc)
    if not len(mean):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    sc.write(queries, "queries")
    found = index.mapInArrow(
        _search(sc.uri("queries"), mean, k, epsilon, block),
        "query_id long, vec_id long, score double, reranked long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return sc.finish(out.select("query_id", "rank", "vec_id", "score"))
