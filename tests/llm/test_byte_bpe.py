"""Byte-level BPE from ranks: against the tiktoken library, round trips, awkward rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from clickvault.llm import byte_bpe, queries
from test_brute import SF, awkward
from test_rest import ODD

PATH, PATTERN = queries.MULTI_RANKS, public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH),
                            special_tokens={})


def want(doc_id, text):
    ids = LIBRARY.encode_ordinary(text or "")
    split = sum(0x80 <= LIBRARY.decode_single_token_bytes(i)[0] < 0xC0 for i in ids)
    return (doc_id, len(ids), split, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest())


def test_query_equals_library(spark, docs):
    got = queries.op13_byte_bpe(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(want(r.doc_id, r.text) for r in docs.collect())


def test_awkward(spark):
    docs = awkward(spark).unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"),
        allowMissingColumns=True)
    got = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    key = lambda r: (r[0] is not None, r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(
        (want(r.doc_id, r.text) for r in docs.collect()), key=key)
    assert byte_bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0


def test_repeated_runs_equal_library():
    tok, rng = byte_bpe.load_tokenizer(PATH, PATTERN), random.Random(5)
    units = ["a", "aa", "ab", " ", "  ", "-", "=", "\n", "0", "_", "\t", "é", "日", "😀"]
    for _ in range(3000):
        text = "".join(rng.choice(units) * rng.randint(1, 9) for _ in range(rng.randint(1, 8)))
        assert tok.encode(text, add_special_tokens=False).ids == LIBRARY.encode_ordinary(text), text


def test_spans_and_split_characters(spark):
    texts = ["", "ab cd", "日本語 x", "😀👨‍👩‍👧 é", "ᚠᛇᚻ ᚦ", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = byte_bpe.encode(docs, PATH, PATTERN)
    back = {r.doc_id: r for r in byte_bpe.decode(coded, PATH, ["doc_id"]).collect()}
    data = {r.doc_id: r.bytes for r in byte_bpe.decode(coded, PATH, ["doc_id"], "bytes", 3).collect()}
    table, split = byte_bpe.byte_table(PATH), 0
    for r in coded.collect():
        text = texts[r.doc_id] or ""
        assert back[r.doc_id].text == text and bytes(data[r.doc_id]) == text.encode()
        ids = np.frombuffer(r.ids, "<u4")
        at = 0
        for i, (a, b) in zip(ids.tolist(), np.frombuffer(r.spans, "<i4").reshape(-1, 2).tolist()):
            # a token's bytes lie in the characters of its span
            low, high = len(text[:a].encode()), len(text[:b].encode())
            assert low <= at and at + len(table.token[i]) <= high
            at += len(table.token[i])
        assert at == len(text.encode())
        split += r.n_split
    assert split > 0  # the texts hold characters in several tokens


def test_parts_of_long_texts():
    text = " ".join(f"wörd{i * i % 977}  x\n\n y" for i in range(4000)) + "z" * 5000
    tok = byte_bpe.load_tokenizer(PATH, PATTERN)
    parts = byte_bpe.text_parts(text, 1000)
    assert len(parts) > 20 and "".join(p for _, p in parts) == text
    ids = [i for _, p in parts for i in tok.encode(p, add_special_tokens=False).ids]
    assert ids == LIBRARY.encode_ordinary(text)
    texts = ["a b", None, text, "", "c d"]
    groups = list(byte_bpe.part_groups(texts, 1000))
    assert ["".join(c for g in groups for r, _, c in g if r == k) for k in range(5)] == [
        t or "" for t in texts]


def test_parts_across_groups(spark):
    texts = ["one two " * 30, None, "x", "", "three four " * 40, "end", *ODD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for part in (1, 50, 1000):
        rows = byte_bpe.encode(docs, PATH, PATTERN, part).collect()
        assert [r.doc_id for r in rows] == list(range(len(texts)))
        for r in rows:
            assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        back = byte_bpe.decode(spark.createDataFrame(rows), PATH, ["doc_id"], part=part).collect()
        assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(texts)}


def test_piece_encoder_equals_library(docs):
    coder = byte_bpe.piece_encoder(PATH, PATTERN)
    texts = [r.text or "" for r in docs.collect()] + [t or "" for t in ODD] * 2
    rng = random.Random(9)
    marks = ["a", "b ", " c", "\n", "\n\n", "  ", "\t", "\r\n", "\x1c", "\u00a0", "it's", ",", ". ", "é"]
    texts += ["".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text, data in zip(texts, coder.encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == LIBRARY.encode_ordinary(text), repr(text)
