"""Target-distribution importance resampling by an Aho-Corasick dictionary.

Features of a text are its words and its pairs of adjacent words (joined by one
space); a feature's bucket is the CRC-32 of its bytes modulo ``buckets``. Bucket
counts of the corpus and of the target texts give each bucket a gain, a document's
weight is the mean gain of its features, and the documents with the highest weight
plus Gumbel noise are drawn: sampling without replacement in proportion to the ratio
of the target's and the corpus's feature distributions.

How buckets are found without hashing text twice:

1. A task takes its texts some megabytes at a time. Bytes are folded by one table
   (A-Z to a-z, everything that is no word byte to a space). The distinct words of that
   part, each between two delimiters, are the patterns of an Aho-Corasick automaton;
   a pattern's payload is the word's CRC and length. The dictionary is bounded by the
   part and knows all its words, so the scan misses none.
2. One scan emits payloads in text order; adjacent words share the delimiter between
   them. The CRC of a pair comes from the payloads alone: appending n bytes is a linear
   map of the CRC, applied as byte tables for the powers of two in n.
3. Buckets of each document are written once as 16- or 32-bit numbers. Counting and
   scoring read those; texts are scanned once.

Bucket counts (one number per bucket) are all that goes through the driver. Ranks come
from a range sort and the ranges' counts.

Null and word-free texts have no features and weight 0. A null doc_id draws its noise
from an empty id; rows that repeat a doc_id are documents of their own with the same
noise, and among equal scores and ids any order holds. Fewer than ``1 / share`` eligible
documents draw none. Extra columns are ignored; empty tables give no rows, and an empty
target counts 0 in all buckets.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import (
    Scratch,
    number_rows,
    row_chunks,
    string_buffers,
)

SCAN_BYTES = 4 << 20  # text per automaton
ROW_END = 10  # stands between texts; no word byte and no delimiter of a pattern

_FOLD = np.full(256, 32, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _FOLD[_low:_high] = np.arange(_low, _high)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD = _FOLD.tobytes()


@lru_cache(maxsize=64)
def _zeros_table(power: int) -> np.ndarray:
    """(4, 256): what each byte of a CRC becomes after 2**power zero bytes are appended."""
    if power == 0:
        # one zero byte: the shift register steps eight times
        base = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            base = np.where(base & 1, (base >> 1) ^ np.uint32(0xEDB88320), base >> 1)
        low = np.arange(256, dtype=np.uint32)
        return np.stack([base, low, low << 8, low << 16]).astype(np.uint32)
    half = _zeros_table(power - 1)
    return np.stack([_through(half, part) for part in half])


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 0xFF] ^ table[1][crc >> 8 & 0xFF]
            ^ table[2][crc >> 16 & 0xFF] ^ table[3][crc >> 24])


def append_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from theirs and the second one's length."""
    out, length = first.astype(np.uint32), np.asarray(length, np.int64)
    for power in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> power & 1)
        out[at] = _through(_zeros_table(power), out[at])
    return out ^ second.astype(np.uint32)


_SPACE_CRC = np.uint32(zlib.crc32(b" "))


def scan(folded: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, CRC, length) of every word between delimiters, in text order, by an automaton."""
    words = list(set(folded.split()))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, w in enumerate(words):
        find.add_word(f" {w.decode('latin-1')} ", i)
    find.make_automaton()
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    length = np.array([len(w) for w in words], np.int64)
    found = np.fromiter(chain.from_iterable(find.iter(folded.decode("latin-1"))), np.int64)
    end, payload = found[::2], found[1::2]
    return end, crc[payload], length[payload]


def text_features(column, buckets: int):
    """(number of words, features' buckets) of each row of a text column."""
    buf, offsets = string_buffers(column)
    mark = b" %c " % ROW_END
    for i, j in row_chunks(offsets, SCAN_BYTES):
        texts = [buf[a:b].tobytes().translate(_FOLD) for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1])]
        # the end of row k in the joined text
        ends = np.cumsum([len(t) + len(mark) for t in texts])
        end, crc, length = scan(b" " + mark.join(texts) + b" ")
        row = np.searchsorted(ends, end - length, side="right")
        pair = np.flatnonzero(row[1:] == row[:-1])
        both = append_crc(append_crc(crc[pair], np.full(len(pair), _SPACE_CRC), np.ones(len(pair))),
                          crc[pair + 1], length[pair + 1])
        one, two = crc % np.uint32(buckets), both % np.uint32(buckets)
        at = np.searchsorted(row, np.arange(j - i + 1))
        at_two = np.searchsorted(row[pair], np.arange(j - i + 1))
        for r in range(j - i):
            yield int(at[r + 1] - at[r]), np.concatenate(
                [one[at[r] : at[r + 1]], two[at_two[r] : at_two[r + 1]]])


def _bucket_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def _features(buckets: int):
    kind = _bucket_type(buckets)

    def run(batches):
        for batch in batches:
            first, n, data = 0, [], []
            for words, features in text_features(batch.column("text"), buckets):
                n.append(words)
                data.append(features.astype(kind).tobytes())
                if len(n) >= 2000 or first + len(n) == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(first, len(n)), pa.array(n, pa.int64()),
                         pa.array(data, pa.binary())], names=["doc_id", "n_words", "buckets"])
                    first, n, data = first + len(n), [], []

    return run


def feature_buckets(texts: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """doc_id, n_words and the buckets of all features of each row's ``text``."""
    return texts.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(
        _features(buckets), "doc_id long, n_words long, buckets binary")


def _count(buckets: int):
    kind = _bucket_type(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column("buckets"):
                total += np.bincount(np.frombuffer(data.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features lie in each bucket, over all rows."""
    sums = features.select("buckets").mapInArrow(_count(buckets), "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: 1000 times the log of target share over source share, one added to each."""
    k = len(source)
    s_all, t_all = int(source.sum()) + k, int(target.sum()) + k
    return np.array([
        math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, fixed by its id and the seed."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gains: np.ndarray, seed: int):
    kind = _bucket_type(len(gains))

    def run(batches):
        for batch in batches:
            n, weight = [], []
            for data in batch.column("buckets"):
                at = np.frombuffer(data.as_py(), kind)
                n.append(len(at))
                weight.append(int(gains[at].sum()) // len(at) if len(at) else 0)
            score = [w + noise(d, seed) for w, d in zip(weight, batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()),
                 pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def resample(docs: DataFrame, target: DataFrame, target_id: str, buckets: int = 10_000,
             share: tuple[int, int] = (25, 100), min_words: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every document."""
    sc = Scratch(docs.sparkSession, "importance")
    features = sc.write(feature_buckets(docs, "doc_id", buckets), "features")
    goal = bucket_counts(feature_buckets(target, target_id, buckets), buckets)
    gains = bucket_gains(bucket_counts(features, buckets), goal)
    scored = sc.write(
        features.mapInArrow(
            _score(gains, seed),
            "doc_id long, n_words long, n_features long, weight long, score long")
        .withColumn("_row", F.monotonically_increasing_id()), "scored")
    sc.drop("features")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()]
    ranked = number_rows(scored.where(able), order, sc, "ranked", "_n")
    rank = F.when(F.col("_n") <= drawn, F.col("_n"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return sc.finish(
        ranked.select(*columns, rank.alias("rank")).union(
            scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))))
