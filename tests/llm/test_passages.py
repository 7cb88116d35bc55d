"""Substring dedup: rows are told apart, and passages inside lines go."""

import random

import pytest

import corpus_pipeline
from clickvault.llm import queries, unit_dedup
from test_brute import brute_dedup, check_packing


def words(tag, n=60):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_rows_without_or_with_the_same_id_are_told_apart(spark):
    rows = [(1, words("p") + "\none"), (5, words("p") + "\nfive"), (5, words("u") + "\nother"),
            (None, words("p") + "\nx"), (None, words("v") + "\ny"),
            (None, words("z")), (None, words("z")), (7, words("s")), (7, words("s"))]
    want = [(1, rows[0][1]), (5, "five"), (5, rows[2][1]), (None, "x"), (None, rows[4][1]),
            (None, rows[5][1]), (None, ""), (7, words("s")), (7, words("s"))]
    key = lambda r: (r[0] or 0, r[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = unit_dedup.dedup_units(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    wide = docs.selectExpr("*", "'s' source", "'en' lang", "length(text) n_chars")
    kept = corpus_pipeline.substring_dedup(spark, wide, None).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=key) == sorted((r for r in want if r[1]), key=key)


def brute(rows, width):
    """Text left of each row: whole lines as test_brute has them, then windows that occur earlier."""
    order = sorted(rows, key=lambda r: r[0])
    lines, out, seen = brute_dedup(rows, width), {}, set()
    for d, t in order:
        w = (t or "").lower().split()
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            if k in seen:
                gone[p : p + width] = [True] * width
            seen.add(k)
        kept = iter([*lines[d][0][0].split("\n"), None]) if lines[d][0] else iter([None])
        line, words, at = next(kept), [], 0
        for x in (t or "").split("\n"):
            n = len(x.split())
            if line is not None and x == line:
                line = next(kept)
                words += [y for y, g in zip(x.split(), gone[at : at + n]) if not g]
            at += n
        out[d] = words
    return out


@pytest.mark.parametrize("width", [51, 50, 6, 1])
def test_passages_inside_lines_equal_brute_force(spark, width):
    rng = random.Random(width)
    shared = [[f"s{k}x{i}" for i in range(rng.randint(width, 3 * width + 5))] for k in range(4)]
    rows = []
    for d in range(60):
        w = [f"d{d}y{i}" if rng.random() < 0.8 else "the" for i in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            i, at = rng.randint(0, 3), rng.randint(0, len(w))
            w[at:at] = [x.upper() if rng.random() < 0.3 else x for x in s[i:]]
        rows.append((d, " ".join(w)))
    rows += [(100, "é " * 300), (101, rows[3][1]), (102, None), (103, " \t"),
             (104, "q w e r " * 90 + "end"), (105, "x " + rows[4][1] + "  y")]
    got = unit_dedup.dedup_units(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width, inside=True)
    want, texts = brute(rows, width), dict(rows)
    for r in got.collect():
        assert (r.text or "").split() == want[r.doc_id], r.doc_id
        left, at = "", 0
        for s in r.removed_spans:
            left += texts[r.doc_id][at : s.start]
            at = s.end
        assert (left + (texts[r.doc_id] or "")[at:]).rstrip("\n") == (r.text or "").rstrip("\n")


def test_benchmark_items_pasted_into_lines_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    windows = {}
    for d, t in rows:
        w = (t or "").lower().split()
        for p in range(len(w) - 50):
            windows.setdefault(tuple(w[p : p + 51]), set()).add(d)
    left = {r.doc_id: r.text for r in queries.op5_passage_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert len(left) == len(rows)
    late = {d for ds in windows.values() for d in ds if d != min(ds)}
    assert {900, 429, 654} <= late
    for d, t in left.items():
        w = (t or "").lower().split()
        for p in range(len(w) - 50):
            assert min(windows.get(tuple(w[p : p + 51]), {d})) == d


def test_passages_next_to_lines_and_nothing(spark):
    rows = [(1, words("a") + "\n" + words("b")), (2, "x\n" + words("a") + " tail\n" + words("b") + "\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = unit_dedup.dedup_units(docs, inside=True).orderBy("doc_id").collect()
    assert [r.text for r in got] == [rows[0][1], "x\ntail\ny"]
    assert unit_dedup.dedup_units(docs.limit(0), inside=True).count() == 0


def test_pipeline_cuts_passages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before, out = df, stage(spark, df, sf)
        out.write.parquet(str(tmp_path / str(i)))
        df = spark.read.parquet(str(tmp_path / str(i)))
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {d: w for d, w in brute(rows, 50).items() if w or not dict(rows)[d].strip()}
    left = [(r.doc_id, r.text) for r in df.collect()]
    assert {d: t.split() for d, t in left} == want
    assert sum(map(len, want.values())) < sum(
        len(v[0][0].split()) for v in brute_dedup(rows, 50).values())
    check_packing(corpus_pipeline.run(spark, sf).collect(), left, 1024)


def test_near_duplicates_keep_other_texts_of_an_id(spark):
    rows = [(1, words("a"), "s"), (1, words("b"), "s"), (1, words("b") + " x", "s"), (1, words("b"), "t"),
            (2, words("a") + " y", "s"), (3, words("c"), "s"), (3, words("C"), "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (1, 3):
        out = corpus_pipeline.near_duplicates(spark, docs.repartition(n, "text"), None)
        assert out.columns == docs.columns
        got = out.collect()
        assert sorted((r.doc_id, r.text.lower().split()[0], r.source) for r in got) == [
            (1, "a0", "s"), (1, "b0", "s"), (3, "c0", "s")]
