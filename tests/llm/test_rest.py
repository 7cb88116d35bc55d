"""The other queries: brute force, exact round trips, held-out accuracy."""

import hashlib
import io
import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickvault.llm import (
    bpe_stream,
    common,
    cotrain,
    onebit_ann,
    queries,
    quotes,
    tokens,
    warc,
    wavelet,
)
from test_brute import SF, awkward

ODD = [
    None, "", " ", "\n", "a", " a", "a ", "  a  b", "a \n b", "a\n b", "a\n  b\t c ", "x" * 5000,
    "it's we'll I'M <|endoftext|> x<|endoftext|>y <|startoftext|>", "é è́ ΑΣ ΟΔΟΣ İstanbul ǅ ﬁ",
    " a b　c\u0085d", "\x1c \x1d a\x1fb", "１２３ 4567 ½ ²", "日本語 テキスト 한국어", "😀 👨‍👩‍👧 ok",
    "ab" * 3000 + " end", "aaaaaaaaaaaaaaaaaaaaaaa" * 90, "the" * 900, "a.b,c!! --- %%% $$$ ###",
    "́ ́a b́", "tail\r\n\r\nnext  \t ", "1" * 700, "word " * 4000,
]


def library(name):
    t = Tokenizer.from_file(name)
    t.no_truncation()
    t.no_padding()
    return t


# --------------------------------------------------------------------------- 8
def test_stream_encoder_equals_library():
    lib = library(queries.WORD_BPE)
    enc = bpe_stream.StreamEncoder(queries.WORD_BPE)
    dec = bpe_stream.StreamDecoder(queries.WORD_BPE)
    rng = random.Random(3)
    letters = "etaoin" * 4 + "shrdlucmfwypvbgkjqxz" + "éßñ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(300)]
    for text in [*(t or "" for t in ODD), *words, " ".join(words)]:
        ids = np.frombuffer(b"".join(enc.encode(text)), "<u4").tolist()
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:80]
        dec.start()
        out = ""
        for i in range(0, len(ids), 7):
            out += dec.feed(ids[i : i + 7])
        assert out + dec.end() == lib.decode(ids, skip_special_tokens=False)


def test_transducer_memory_is_bounded():
    m = bpe_stream.MergeList(queries.WORD_BPE)
    rng = random.Random(9)
    for make in (lambda: "a", lambda: rng.choice("ab"), lambda: rng.choice("thequickbrown")):
        t = bpe_stream.Transducer(m)
        for _ in range(20_000):
            t.feed(make())
        t.finish("a")
        assert t.most <= 8 * m.lookahead


def test_byte_level_decoder_is_incremental():
    lib, dec = library(queries.BYTE_BPE), bpe_stream.StreamDecoder(queries.BYTE_BPE)
    for text in (t or "" for t in ODD):
        ids = lib.encode(text, add_special_tokens=False).ids
        dec.start()
        assert "".join(dec.feed([i]) for i in ids) + dec.end() == lib.decode(
            ids, skip_special_tokens=False)


def round_trip_of(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_streaming_bpe_query(spark, docs):
    lib = library(queries.WORD_BPE)
    want = {r.doc_id: round_trip_of(lib, r.text) for r in docs.collect()}
    got = queries.op8_streaming_bpe(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_streaming_bpe_awkward(spark):
    lib = library(queries.WORD_BPE)
    docs = awkward(spark)
    want = sorted((r.doc_id, *round_trip_of(lib, r.text)) for r in docs.collect())
    assert sorted(map(tuple, bpe_stream.round_trip(docs, queries.WORD_BPE).collect())) == want
    assert bpe_stream.round_trip(docs.limit(0), queries.WORD_BPE).count() == 0
    got = {r.doc_id: r.ids for r in bpe_stream.encode(docs, queries.WORD_BPE).collect()}
    assert got[6] == lib.encode("one two", add_special_tokens=False).ids


# ------------------------------------------------------------------- tokens, 2
def test_memo_encoder_learns_a_piece_in_use_once(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 4)
    enc = tokens.MemoEncoder(library(queries.BYTE_BPE))
    learned, learn = [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda keys, bare: learned.extend(keys) or learn(keys, bare))
    texts = ["one two two. three", "four five", "two\tthree two", "three\r two", "", "two three  five"]
    want = [np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode(texts) == want
    assert sorted(learned) == sorted(set(learned))
    learned.clear()
    # the memo is full: what is asked for again goes on
    assert enc.encode(["x two three"]) == [
        np.array(enc.tok.encode("x two three", add_special_tokens=False).ids, "<u4").tobytes()]
    assert learned == [tokens.BARE + "x"]
    assert enc.encode([]) == []


def test_memo_encoder_equals_library(docs):
    lib, enc = library(queries.BYTE_BPE), tokens.memo_encoder(queries.BYTE_BPE)
    texts = [t or "" for t in ODD] + [r.text for r in docs.collect()]
    for _ in range(2):  # the second time from the memo
        for t, data in zip(texts, enc.encode(texts)):
            assert np.frombuffer(data, "<u4").tolist() == lib.encode(
                t, add_special_tokens=False).ids, t[:80]


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for n, top, bits in ((0, 5, 3), (1, 2, 1), (63, 9, 4), (64, 9, 4), (1000, 60_000, 16), (500, 70_000, 17)):
        v = rng.integers(0, top, n)
        data = wavelet.dump_shard(v, np.arange(3), np.zeros(3), bits)
        m, ids, _ = wavelet.load_shard(data)
        assert ids.tolist() == [0, 1, 2] and m.tokens().tolist() == v.tolist()
        for i in range(0, n, 37):
            assert m.access(i) == v[i]
            t = int(v[i])
            where = np.flatnonzero(v == t).tolist()
            assert m.rank(t, i) == int((v[:i] == t).sum()) and m.count(t) == len(where)
            assert m.positions(t) == where
            with pytest.raises(IndexError):
                m.select(t, len(where))
        assert m.count(top + 1) == 0


def brute_shards(rows):
    lib, at, out = library(queries.BYTE_BPE), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_wavelet_query(spark, docs):
    want = brute_shards([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted(map(tuple, queries.op2_wavelet_shards(spark, SF).collect()))
    assert got == want


def test_wavelet_awkward(spark):
    docs = awkward(spark).union(spark.createDataFrame(
        [(None, "no id", "a", "en", 1, "r")], awkward(spark).schema))
    want = brute_shards([(r.doc_id, r.text) for r in docs.collect()])
    sc = common.Scratch(spark, "t")
    m = sc.write(wavelet.write_shards(docs, sc.uri("s"), queries.BYTE_BPE, 0, shard_tokens=500), "m")
    assert m.count() > 2
    got = wavelet.read_shards(m, sc.uri("s")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert wavelet.write_and_read(docs.limit(0), queries.BYTE_BPE).count() == 0


def test_wavelet_blocks_of_large_planes():
    rng = np.random.default_rng(4)
    v = np.minimum(rng.zipf(1.3, 3 * wavelet.BLOCK + 77), 50_000) - 1
    data = wavelet.dump_shard(v, np.arange(1), np.zeros(1), 16)
    read = []

    def part(at, n):
        read.append(n)
        return data[at : at + n]

    m = wavelet.ShardFile(part)
    assert sum(read) < len(data) // 20  # the directory alone
    for t in (0, 3, 900, 49_999):
        where = np.flatnonzero(v == t)
        assert m.count(t) == len(where) and m.rank(t, wavelet.BLOCK + 5) == (where < wavelet.BLOCK + 5).sum()
        assert m.positions(t) == where.tolist()
    read.clear()
    other = wavelet.ShardFile(part)
    for i in (0, wavelet.BLOCK, len(v) - 1):
        assert other.access(i) == v[i]
    assert sum(read) < len(data)
    with pytest.raises(IndexError):
        other.access(len(v))
    assert m.tokens().tolist() == v.tolist()


def test_wavelet_lookups_over_files(spark, docs):
    lib = library(queries.BYTE_BPE)
    rows = [(None if r.doc_id % 3 == 0 else r.doc_id, r.text) for r in docs.collect()]
    some = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sc = common.Scratch(spark, "t")
    root = sc.uri("s")
    m = sc.write(wavelet.write_shards(some, root, queries.BYTE_BPE, 0, shard_tokens=5000), "m")
    # a third of the rows without an id are shared by several tasks
    assert m.where("at = 0").count() > 2 and m.count() > 5
    seen = {}
    for d, t in rows:
        for i, x in enumerate([*lib.encode(t or "", add_special_tokens=False).ids, 0]):
            seen.setdefault(x, []).append((-1 if d is None else d, i))
    tokens = [0, *sorted(seen, key=lambda x: -len(seen[x]))[:3], max(seen), 49_999]
    want = {t: len(seen.get(t, [])) for t in tokens}
    assert dict(map(tuple, wavelet.count_tokens(m, root, tokens).collect())) == want
    found = wavelet.find_tokens(m, root, tokens)
    got = {}
    for r in found.collect():
        got.setdefault(r.token, []).append((-1 if r.doc_id is None else r.doc_id, r.place))
    assert {t: sorted(x) for t, x in got.items()} == {
        t: sorted(seen[t]) for t in set(tokens) if t in seen}
    asked = found.select("file", "at", "token").dropDuplicates(["file", "at"])
    back = wavelet.tokens_at(asked, root)
    assert back.count() == asked.count() and back.join(
        asked.withColumnRenamed("token", "want"), ["file", "at"]).where("token <> want").count() == 0


# --------------------------------------------------------------------------- 4
def brute_warc(rows):
    sha = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            k = hashlib.sha1(b).hexdigest()
            sha[k] = max(sha.get(k, p), p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        d = hashlib.sha1(b).hexdigest()
        top = sha.get(d) if len(b) >= 1000 else None
        again = top is not None and top != p
        out.append((p, len(b), d, "revisit" if again else "response", top if again else None))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_warc_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select(
        "page_id", "url", "html").collect()]
    got = queries.op4_warc_revisits(spark, SF).select(*FIELDS).collect()
    assert sorted(map(tuple, got)) == brute_warc(rows)


def test_warc_awkward(spark):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/ b\r\nX: y", big), (4, "u", other),
            (5, "u", "y" * 999), (6, "u", "y" * 999), (7, "u", None), (8, "u", ""),
            (None, "u", big), (3, "http://a/3", big), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 90)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.write_and_read(pages).select(*FIELDS).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) == brute_warc(rows)
    assert warc.write_and_read(pages.limit(0)).count() == 0
    sc = common.Scratch(spark, "t")
    m = sc.write(warc.write_archives(pages, sc.uri("w"), archive_bytes=400), "m")
    assert m.count() > 1
    fs, base = common.open_fs(sc.uri("w"))
    seen = {}
    for name in [r.file for r in m.collect()]:
        with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
            for head, _, payload in warc.read_records(io.BytesIO(f.read())):
                seen.setdefault(head["warc-record-id"], []).append((head["warc-type"], payload.decode()))
    assert seen["<urn:x-page:9>"] == [("response", rows[-1][2])] and seen["<urn:x-page:1>"] == [("revisit", "")]


# --------------------------------------------------------------------------- 1
def brute_nearest(rows, k, query):
    good = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, a in good:
        if not query(q):
            continue
        s = []
        for i, b in good:
            if i != q:
                s.append((-float((a * b).sum() / math.sqrt((a * a).sum() * (b * b).sum())), i))
        out[q] = sorted(s)[:k]
    return out


def test_onebit_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows, 5, lambda i: i % 50 == 0)
    got = queries.op1_onebit_ann(spark, SF).collect()
    hit = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in got)
    assert hit >= 0.95 * sum(map(len, want.values()))
    exact = dict((i, np.array(v, float)) for i, v in rows)
    for r in got:
        a, b = exact[r.query_id], exact[r.vec_id]
        assert abs(r.score - (a @ b) / math.sqrt((a @ a) * (b @ b))) < 1e-12
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, i) for q in sorted(want) for i in range(1, 6)]


def test_onebit_awkward(spark):
    rng = np.random.default_rng(4)
    hot = [float(x) for x in rng.standard_normal(8)]
    rows = [(i, hot) for i in range(0, 120, 2)]
    rows += [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(1, 200, 2)]
    bad = [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [float("inf")] + [1.0] * 7),
           (504, [None] + [1.0] * 7), (505, [1.0, 2.0]), (None, hot), (550, [])]
    t = spark.createDataFrame(
        [(*r, "x", 1) for r in rows + bad], "vec_id long, embedding array<double>, v string, rank int")
    got = onebit_ann.nearest(t, "vec_id % 50 = 0", 5)
    want = brute_nearest(rows, 5, lambda i: i % 50 == 0)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert found.keys() == want.keys()
    for q in (0, 50, 100):  # copies: ties go to the smaller id
        assert [i for _, i in found[q]] == [i for _, i in want[q]]
    few = onebit_ann.nearest(t.where("vec_id in (0, 1, 3)"), "vec_id % 50 = 0", 5).collect()
    assert [(r.query_id, r["rank"]) for r in few] == [(0, 1), (0, 2)]
    for none in (t.limit(0), t.where("vec_id >= 500")):
        assert onebit_ann.nearest(none, "vec_id % 50 = 0").count() == 0


def test_onebit_bounds_hold():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((2000, 48))
    turn = onebit_ann.rotation(48, onebit_ann.code_bits_for(48))
    best = onebit_ann.Best(20, 5)
    code, length, cosine = onebit_ann.encode(x, np.zeros(48), turn)
    n = onebit_ann.search_block(np.arange(20), x[:20], np.arange(2000), x, code, length, cosine,
                                np.zeros(48), turn, 5, onebit_ann.EPSILON, best)
    want = brute_nearest(list(enumerate(x)), 5, lambda i: i < 20)
    hit = sum(i in {j for _, j in want[q]} for q in range(20) for i in best.id[q])
    assert hit >= 97 and n < 0.6 * 20 * 2000


# -------------------------------------------------------------------------- 10
def brute_threads(rows):
    """(conv, turn) -> (n_quoted, n_linked, parent, root) and the order of each conversation."""
    own, out = {}, {}
    for c, t, text in rows:
        for level, line in quotes.parse_lines(text or ""):
            h = quotes.normal_digest(line)
            if h and not level and t is not None:
                own.setdefault((c, h[0]), set()).add(t)
    links = {}
    for c, t, text in rows:
        for level, line in quotes.parse_lines(text or ""):
            h = quotes.normal_digest(line)
            if h and level:
                o = max((x for x in own.get((c, h[0]), ()) if t is not None and x < t), default=None)
                links.setdefault((c, t), []).append((level, h[1], o))
    for k, ls in links.items():
        by = {}
        for level, w, o in ls:
            if o is not None:
                by[level, o] = by.get((level, o), 0) + w
        best = max(((-lv, w, o) for (lv, o), w in by.items()), default=None)
        out[k] = (len(ls), sum(o is not None for *_, o in ls), best[2] if best else None)
    result = {}
    for c, t, _ in rows:
        n, k, p = out.get((c, t), (0, 0, None))
        root = t
        while (c, root) in out and out[c, root][2] is not None:
            root = out[c, root][2]
        result[c, t] = (n, k, p, root)
    return result


def threads(n):
    rng = random.Random(n)
    rows, texts = [], {}
    for c in range(30):
        turns = 60 if c == 0 else rng.randint(1, 9)
        for t in range(turns):
            text = "\n".join(f"Line {rng.randint(0, 40)} of {c % 3}" for _ in range(rng.randint(1, 3)))
            if t and rng.random() < 0.7:
                o = texts[c, rng.randrange(t)]
                text = "\n".join("> " + x for x in o.split("\n")) + "\n\n" + text
            texts[c, t] = text
            rows.append((c, t, "user", text))
    return rows


def check_threads(got, rows):
    want = brute_threads([(c, t, x) for c, t, _, x in rows])
    by_conv = {}
    for r in got:
        assert (r.n_quoted, r.n_linked, r.parent_turn, r.root_turn) == want[r.conv_id, r.turn]
        assert not any(line.startswith(">") for line in r.clean_text.split("\n"))
        by_conv.setdefault(r.conv_id, []).append(r)
    assert len(got) == len(rows)
    for rs in by_conv.values():
        rs.sort(key=lambda r: r.position)
        assert [r.position for r in rs] == list(range(len(rs)))
        keys = [(r.root_turn is not None, r.root_turn or 0, r.turn is not None, r.turn or 0) for r in rs]
        assert keys == sorted(keys)


def test_quotes_random_threads(spark):
    rows = threads(1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.link_conversations(df.repartition(7)).collect()
    check_threads(got, rows)
    assert sum(r.parent_turn is not None for r in got) > 50


def test_quotes_awkward(spark):
    rows = [(1, 0, "user", None), (1, 1, "user", ""), (1, 2, "a", "Hello  World"), (1, 3, "b", "> hello world\nyes"),
            (1, 4, "a", ">> Hello world\n> yes\n no "), (1, 4, "a", "> unknown"), (None, 0, "a", "x y"),
            (None, 1, "a", "> X y"), (2, None, "a", "q"), (2, 5, "a", ">q"), (2, 0, "a", "> " * 3000 + "deep"),
            (3, 0, "a", " ".join(["long"] * 50_000)), (3, 1, "a", "> " + " ".join(["long"] * 50_000))]
    df = spark.createDataFrame([(*r, "c") for r in rows],
                               "conv_id long, turn long, role string, text string, clean_text string")
    got = quotes.link_conversations(df)
    assert got.columns == ["conv_id", "turn", "role", "text", *quotes.ADDED]
    r = {(x.conv_id, x.turn): x for x in got.where("text not like '%unknown%'").collect()}
    assert r[1, 3].parent_turn == 2 and r[1, 4].parent_turn == 3 and r[1, 4].root_turn == 2
    assert r[None, 1].parent_turn == 0 and r[2, 5].parent_turn is None and r[3, 1].parent_turn == 0
    assert r[1, 4].clean_text == " no " and r[1, 4].n_linked == 2
    assert quotes.link_conversations(df.limit(0)).count() == 0


def test_quotes_query(spark):
    t = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    check_threads(queries.op10_quotation_links(spark, SF).collect(), [tuple(r) for r in t.collect()])


# --------------------------------------------------------------------------- 9
def test_cotraining_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, d, "documents"), queries.table(spark, d, "labels")
    held = "pmod(hash(doc_id), 3) = 0"
    got = {r.doc_id: r for r in cotrain.score(docs, labels.where(f"not {held}")).collect()}
    assert len(got) == docs.count()
    test = labels.where(held).collect()
    right = sum(got[r.doc_id].kept == (r.quality > 0) for r in test)
    good = [r for r in test if r.quality > 0]
    assert right >= 0.97 * len(test)
    assert sum(got[r.doc_id].kept for r in good) >= 0.99 * len(good)


def test_cotraining_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(7, 1), (8, 1), (8, 0), (None, 1), (9, None)], "doc_id long, quality int")
    for few in (labels, labels.limit(0), labels.where("doc_id = 7")):
        assert cotrain.score(docs, few).count() == docs.count()
        kept = cotrain.keep_documents(docs, few)
        assert kept.columns == docs.columns
    assert cotrain.keep_documents(docs, labels.limit(0)).count() == docs.count()
    assert cotrain.score(docs.limit(0), labels).count() == 0
    assert cotrain.keep_documents(docs.limit(0), labels).count() == 0
    many = spark.createDataFrame([(i, i % 2) for i in range(1, 14)], "doc_id long, quality int")
    assert cotrain.score(docs, many).count() == docs.count()


def test_sql_of_queries(spark):
    from clickvault.oracle.compare import compare, duck_connect

    duck = duck_connect(SF)
    for name, sql in queries.ORACLES.items():
        ok, why = compare(spark, duck, queries.QUERIES[name], sql, SF)
        assert ok, f"{name}: {why}"
