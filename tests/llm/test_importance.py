"""Importance resampling against brute force over whole tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

from clickvault.llm import importance, queries
from test_brute import SF, awkward

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def features(text, buckets=10_000):
    w = WORD.findall((text or "").translate(LOW))
    return len(w), [zlib.crc32(x.encode()) % buckets for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def brute(docs, target, buckets=10_000):
    rows = [(d, *features(t, buckets)) for d, t in docs]
    t = collections.Counter(f for x in target for f in features(x, buckets)[1])
    s = collections.Counter(f for r in rows for f in r[2])
    ta, sa = sum(t.values()), sum(s.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (sa + buckets) / ((s[i] + 1) * (ta + buckets))))
            for i in range(buckets)]
    out = []
    for d, n, f in rows:
        w = sum(gain[i] for i in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[: len(able) * 25 // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_query_equals_brute_force(spark, docs):
    got = queries.op12_importance(spark, SF).collect()
    goal = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, got), key=str) == brute([(r.doc_id, r.text) for r in docs.collect()], goal)
    assert sum(r.rank is not None for r in got) > 10


def test_awkward(spark):
    docs = awkward(spark)
    extra = spark.createDataFrame(
        [(None, "no id " * 30, "x"), (None, None, "x"), (50, "\x00ab\x7fCD\n\t e ab cd e é É", "x"),
         (51, "x" * 70_000 + " y", "x"), (52, "a" * 300 + " " + "b" * 5000 + " c", "x")],
        "doc_id long, text string, buckets string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    goal = spark.createDataFrame([(1, "x1 x2 x3 ab cd"), (None, None), (2, "")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for target, texts in ((goal, ["x1 x2 x3 ab cd"]), (goal.limit(0), [])):
        got = importance.resample(docs, target, "item_id").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, texts)
    assert importance.resample(docs.limit(0), goal, "item_id").count() == 0


def test_small_and_large_numbers_of_buckets(spark, docs):
    goal = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, texts = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in goal.collect()]
    for buckets in (1, 70_000):
        got = importance.resample(docs, goal, "item_id", buckets).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, texts, buckets)


def test_appended_crc():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.randint(0, 3000))) for _ in range(300)]
    crc = lambda x: np.array([zlib.crc32(b) for b in x], np.uint32)
    got = importance.append_crc(crc([a for a, _ in pairs]), crc([b for _, b in pairs]),
                                [len(b) for _, b in pairs])
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_many_parts_of_text(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(importance.row_chunks, "__defaults__", (64,))
    monkeypatch.setattr(importance, "SCAN_BYTES", 64)
    texts = ["one two  three", None, "", "a" * 500 + " b", "Ab,cd;ef", "one"] * 7
    got = [(n, f.tolist()) for n, f in importance.text_features(pa.array(texts), 10_000)]
    assert [(n, sorted(f)) for n, f in got] == [(n, sorted(f)) for n, f in map(features, texts)]
