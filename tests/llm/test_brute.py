"""Queries and operators against brute force over the whole small tables."""

import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickvault.llm import bestfit, host_rules, partenum, queries, unit_dedup

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, rank string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    if not w:
        return set()
    if len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(rows, num, den, width):
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t:
                inter = len(s & t)
                if den * inter >= num * (len(s) + len(t) - inter):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {(d, len(s), find(d)) for d, s in sets}


def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"w{i * i % 7919}" for i in range(30_000))
    words = [f"x{i}" for i in range(200)]
    changed = list(words)
    changed[100] = "other"
    rows = [
        (1, None, "a", "en", None, "r"), (2, "", None, None, 0, None), (3, " \n\t", "a", "en", 3, "r"),
        (4, "one", "a", "en", 3, "r"), (5, "ONE", "b", "en", 3, "r"), (6, "one two", "a", "en", 7, "r"),
        (7, " ".join(words), "a", "en", 900, "r"), (8, " ".join(changed), "a", "en", 900, "r"),
        (8, " ".join(changed), "a", "en", 900, "r"), (9, long, "c", "en", 1, "r"),
        (10, long + " more", "c", "en", 1, "r"), (11, "é " * 80, "https://H.example/x", "fr", 160, "r"),
        (12, "a b c d\n" * 40, "d", "en", 1, "r"), (13, "Line one\nline  ONE\n\nline one", "d", "en", 1, "r"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def near_group(spark):
    """A base and copies with more and more words changed, so links form chains."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for k in range(1, 120):
        w = list(base)
        for p in rng.choice(300, size=int(rng.integers(0, 24)), replace=False):
            w[p] = f"c{rng.integers(1 << 30)}"
        rows.append((1000 - k, " ".join(w)))
    for k in range(60):
        rows.append((2000 + k, " ".join(f"v{rng.integers(9)}" for _ in range(int(rng.integers(1, 25))))))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("num,den,width", [(90, 100, 3), (80, 100, 5)])
def test_partenum_query_equals_brute_force(spark, num, den, width):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = (queries.op6_ngram_jaccard(spark, SF) if num == 90
           else partenum.jaccard_components(docs, num, den, width))
    got = {tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()}
    assert got == components(rows, num, den, width)


@pytest.mark.parametrize("num,den,block", [(90, 100, 2048), (90, 100, 8), (80, 100, 16)])
def test_partenum_near_groups(spark, num, den, block):
    docs = near_group(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {tuple(r) for r in partenum.jaccard_components(docs, num, den, 3, block).collect()}
    assert got == components(rows, num, den, 3)


def test_partenum_awkward(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {tuple(r) for r in partenum.jaccard_components(docs).collect()}
    assert got == components(rows, 90, 100, 3)
    assert partenum.jaccard_components(docs.limit(0)).count() == 0


def test_partenum_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in (10, 11, 19, 20, 55, 137, 400, 3000):
        for _ in range(20):
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            most = size * 10 // 190  # exchanged elements that keep the similarity at 0.9
            b = np.concatenate([a[most:], rng.integers(0, 2**64, most, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if partenum.jaccard_at_least(a, b, 90, 100) and not np.array_equal(a, b):
                assert set(partenum.signatures(a, 90, 100)) & set(partenum.signatures(b, 90, 100))
            cut = np.unique(a[: len(a) - len(a) // 10])
            if partenum.jaccard_at_least(a, cut, 90, 100) and len(cut) < len(a):
                assert set(partenum.signatures(a, 90, 100)) & set(partenum.signatures(cut, 90, 100))


@pytest.mark.parametrize("num", [80, 90, 95])
def test_partenum_sparse_sets_share_a_signature(num):
    """Also where sets are so small that many of their subsets are empty."""
    rng, linked = np.random.default_rng(num), 0
    for size in [*range(1, 60), 90, 130, 250]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            gone = int(rng.integers(0, size * (100 - num) // 100 + 1))
            new = int(rng.integers(0, size * (100 - num) // 100 + 1))
            b = np.unique(np.concatenate(
                [rng.permutation(a)[gone:], rng.integers(0, 2**64, new, dtype=np.uint64)]))
            if len(b) and not np.array_equal(a, b) and partenum.jaccard_at_least(a, b, num, 100):
                linked += 1
                assert set(partenum.signatures(a, num, 100)) & set(partenum.signatures(b, num, 100))
    assert linked > 60


def base_measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for x in wins:
        seen[x] = seen.get(x, 0) + 1
    covered = {i + j for i, x in enumerate(wins) if seen[x] > 1 for j in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    n = len(w)
    return (n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COLS = [*host_rules.BASE, "base_failed"]


def test_host_rules_query_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op7_host_rules(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[c] for c in COLS) == base_measures(docs[r.doc_id].text)
        assert not (r.base_failed and r.kept)


def test_host_rules_awkward(spark):
    docs = awkward(spark)
    want = sorted((r.doc_id, *base_measures(r.text)) for r in docs.collect())
    got = host_rules.host_verdicts(docs).collect()
    assert sorted((r.doc_id, *[r[c] for c in COLS]) for r in got) == want
    assert {r.host for r in got} == {"a", "b", "c", "d", "", "h.example"}
    assert host_rules.host_verdicts(docs.limit(0)).count() == 0
    kept = host_rules.keep_documents(docs)
    assert kept.columns == docs.columns


def test_host_rates_shrink(spark):
    rows = [("bad", True)] * 900 + [("bad", False)] * 100 + [("tiny", True)] * 1
    rows += [(f"h{i % 20}", i % 11 == 0) for i in range(4000)]
    got = {r.host: r for r in host_rules.host_rates(
        spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["bad"].rejected and not got["h3"].rejected
    # one failed document: between the mean of all hosts and its own rate
    assert sum(b for _, b in rows) / len(rows) < got["tiny"].shrunk_rate < 1.0


def brute_dedup(rows, min_words):
    seen, out = {}, {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    marks = {}
    for d, t in order:
        n = 0
        for line in (t or "").split("\n"):
            w = line.lower().split()
            if w:
                if seen.setdefault(tuple(w), (d, n)) != (d, n):
                    marks.setdefault(d, set()).add(n)
                n += 1
    for d, t in rows:
        lines = (t or "").split("\n")
        keep, run, words, n = [], [], 0, 0
        drop = set()
        for i, line in enumerate([*lines, None]):
            w = (line or "").lower().split()
            if line is not None and not w:
                continue
            if line is not None and n in marks.get(d, ()):
                run.append(i)
                words += len(w)
            else:
                if words >= min_words:
                    drop.update(run)
                run, words = [], 0
            n += 1
        keep = [x for i, x in enumerate(lines) if i not in drop]
        out.setdefault(d, []).append(None if t is None else ("\n".join(keep), len(drop)))
    return out


def test_unit_dedup_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_dedup(rows, 50)
    texts = dict(rows)
    removed = 0
    for r in queries.op5_line_dedup(spark, SF).collect():
        text, n = want[r.doc_id][0]
        assert r.text.rstrip("\n") == text.rstrip("\n") and r.n_removed_units == n
        left, at = "", 0
        for s in r.removed_spans:
            left += texts[r.doc_id][at : s.start]
            at = s.end
        assert (left + texts[r.doc_id][at:]).rstrip("\n") == r.text.rstrip("\n")
        removed += n
    assert removed > 0


def test_unit_dedup_awkward(spark):
    docs = awkward(spark)
    for min_words in (1, 2, 50):
        got = unit_dedup.dedup_units(docs, min_words)
        assert got.columns == [*docs.columns, *unit_dedup.ADDED]
        want = brute_dedup([(r.doc_id, r.text) for r in docs.collect()], min_words)
        for r in got.collect():
            w = want[r.doc_id][0]
            assert (r.text is None) == (w is None)
            if w:
                assert r.text.rstrip("\n") == w[0].rstrip("\n")
    assert unit_dedup.dedup_units(docs.limit(0)).count() == 0
    para = unit_dedup.dedup_units(spark.createDataFrame(
        [(1, "a b\nc d\n\ne f"), (2, "A  b\nc d\n\n\nx")], "doc_id long, text string"), 1, "paragraph")
    assert [r.text for r in para.orderBy("doc_id").collect()] == ["a b\nc d\n\ne f", "\n\nx"]


def check_packing(rows, texts, capacity):
    """Every piece is there, cut rightly, and sequences are gapless; returns their number."""
    tok = Tokenizer.from_file(queries.BYTE_BPE)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for d, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in pieces[d]), key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(mine):
            assert (r.piece, r.start) == (k, at) and 0 < r.length <= capacity
            assert k == 0 or r.length == capacity
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids) and len(mine) == -(-len(ids) // capacity)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs), sum(r.length for r in rows)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n, tokens = check_packing(queries.op3_best_fit_packing(spark, SF).collect(), docs, 1024)
    assert n <= -(-tokens // 1024) * 1.03 + 1


def test_packing_awkward(spark):
    docs = awkward(spark).dropDuplicates(["doc_id"])
    rows = bestfit.pack(docs, queries.BYTE_BPE, 64).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert bestfit.pack(docs.limit(0), queries.BYTE_BPE).count() == 0
    twice = bestfit.pack(awkward(spark).where("doc_id = 8"), queries.BYTE_BPE).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)


@pytest.mark.parametrize("capacity,sizes", [
    (10, [1] * 95), (10, [5] * 30 + [4] * 7), (100, list(range(1, 100)) * 6), (7, [3] * 50),
])
def test_best_fit_is_near_the_least(spark, capacity, sizes):
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "uid long, length long")
    got = bestfit.best_fit(items, capacity).collect()
    assert sorted(r.uid for r in got) == list(range(len(sizes)))
    bins = {}
    for r in got:
        bins.setdefault(r.bin, []).append((r.offset, sizes[r.uid]))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    each = capacity // min(sizes) if len(set(sizes)) == 1 else None
    least = -(-len(sizes) // each) if each else -(-sum(sizes) // capacity)
    assert len(bins) <= least * 1.05 + 1


def test_carry_over():
    plan = bestfit.carry_over({0: (2, 3), 1: (2, 1), 2: (9, 0)})
    # range 1 takes the last two of range 0; range 2 takes range 1's, then range 0's first
    assert plan == {1: [(0, 2, 0, 2)], 2: [(0, 1, 1, 0), (1, 2, 0, 0)]}
