"""Byte-level BPE by the ``tokenizers`` library over Arrow batches, from a file of token ranks.

A rank file lists byte strings with their ids. The library works on characters, so
each byte gets a printable character of its own and every rank becomes a token of such
characters. Its merges are all cuts of a token into two known tokens, in the order of
the token's rank: the pair whose joined bytes rank lowest goes first, as with ranks
alone. A piece that is itself a token is taken whole. Each match of the pattern is
encoded separately.

A batch's texts are cut where a match of the pattern always ends and the next one does
not look back (``tokens``: before single spaces, at single line breaks, before full stops
and commas that end a piece). The library encodes the pieces that are not in a bounded
memo, many in one call. A text longer than ``PART`` characters is encoded in parts that end
before a single space.

``encode`` gives ids and the span of characters that each token covers, found from the
tokens' bytes and a map from bytes to characters; a character whose bytes lie in several
tokens is in the span of each of them. ``decode`` turns ids into bytes by the reversed
byte table, joins the bytes of split characters across tokens, and replaces by U+FFFD only
what is not UTF-8 after that.

The pattern must match every character, and end a match at those places.

Null text is an empty one and has no tokens. A null doc_id stays null; rows that repeat
a doc_id are documents of their own. Extra columns are ignored. No rows: no rows.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from clickvault.llm.common import ship_package
from clickvault.llm.tokens import MemoEncoder

PART = 1 << 19  # characters encoded at a time
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself in Latin-1, else the next one from U+0100 on."""
    out, extra = [], 0x100
    for b in range(256):
        c = chr(b)
        if not c.isprintable() or c.isspace():
            c, extra = chr(extra), extra + 1
        out.append(c)
    return out


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> id of a rank file (a Base64 string and a number in each line)."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=4)
def load_tokenizer(path: str, pattern: str) -> Tokenizer:
    """The library's tokenizer for a rank file; one per worker process, which has one core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    ranks, char = load_ranks(path), byte_characters()
    name = {token: "".join(char[b] for b in token) for token in ranks}
    merges = [
        (name[token[:i]], name[token[i:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    tok = Tokenizer(models.BPE(
        vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


class ByteTable:
    """Token bytes by id: each character of a token goes back to its byte."""

    def __init__(self, ranks: dict[bytes, int]):
        char = byte_characters()
        byte = {c: b for b, c in enumerate(char)}
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for name, i in (("".join(char[b] for b in t), i) for t, i in ranks.items()):
            self.token[i] = bytes(byte[c] for c in name)
        self.size = np.array([len(t) for t in self.token], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def spans(self, ids: np.ndarray, data: np.ndarray) -> np.ndarray:
        """(start, end) in characters of each token of the text with the bytes ``data``."""
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.size[ids])
        return np.stack([char[ends - self.size[ids]], char[ends - 1] + 1], axis=1)


@lru_cache(maxsize=4)
def byte_table(path: str) -> ByteTable:
    return ByteTable(load_ranks(path))


@lru_cache(maxsize=4)
def piece_encoder(path: str, pattern: str) -> MemoEncoder:
    return MemoEncoder(load_tokenizer(path, pattern))


def text_parts(text: str, part: int = PART) -> list[tuple[int, str]]:
    """(place, characters) of a text's parts, each about ``part`` long if it can be cut."""
    out, at = [], 0
    while len(text) - at > part:
        cut = _CUT.search(text, at + part)
        if cut is None:
            break
        out.append((at, text[at : cut.start()]))
        at = cut.start()
    return [*out, (at, text[at:])]


def part_groups(texts, part: int = PART):
    """(row, place, characters) of all parts, in lists of about ``part`` characters together."""
    group, size = [], 0
    for row, text in enumerate(texts):
        text = text.as_py() if isinstance(text, pa.Scalar) else text
        for at, chars in text_parts(text or "", part):
            group.append((row, at, chars))
            size += len(chars)
            if size >= part:
                yield group
                group, size = [], 0
    if group:
        yield group


_ENCODED = "doc_id long, n_tokens long, n_split long, ids binary, spans binary"


def _encode(path: str, pattern: str, part: int):
    def run(batches):
        coder, table = piece_encoder(path, pattern), byte_table(path)
        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text")
            first, ids, spans = 0, [], []  # of the rows from ``first`` on, parts in lists

            def rows(end):
                n = end - first
                flat = [np.concatenate(x) for x in ids[:n]]
                at = [np.concatenate(x) for x in spans[:n]]
                split = [int((x[1:, 0] < x[:-1, 1]).sum()) for x in at]
                return pa.RecordBatch.from_arrays(
                    [docs.slice(first, n), pa.array([len(x) for x in flat], pa.int64()),
                     pa.array(split, pa.int64()), pa.array([x.tobytes() for x in flat], pa.binary()),
                     pa.array([x.astype("<i4").tobytes() for x in at], pa.binary())],
                    names=["doc_id", "n_tokens", "n_split", "ids", "spans"])

            for group in part_groups(texts, part):
                done = group[0][0]  # rows before the group's first are complete
                if done > first:
                    yield rows(done)
                    ids, spans, first = ids[done - first :], spans[done - first :], done
                for (row, at, chars), data in zip(group, coder.encode([c for _, _, c in group])):
                    while len(ids) <= row - first:
                        ids.append([])
                        spans.append([])
                    a = np.frombuffer(data, "<u4")
                    ids[row - first].append(a)
                    spans[row - first].append(
                        table.spans(a, np.frombuffer(chars.encode(), np.uint8)) + at)
            if len(texts) > first:
                yield rows(len(texts))

    return run


def encode(docs: DataFrame, path: str, pattern: str, part: int = PART) -> DataFrame:
    """doc_id, n_tokens, n_split, ids (little-endian uint32), spans (int32 start and end of each token).

    ``n_split`` counts tokens that begin within a character.
    """
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode(path, pattern, part), _ENCODED)


def _decode(path: str, keep: list[str], name: str, part: int):
    def run(batches):
        table = byte_table(path)
        for batch in batches:
            first, out, size = 0, [], 0
            for i, ids in enumerate(batch.column("ids"), 1):
                data = table.decode(np.frombuffer(ids.as_py() or b"", "<u4"))
                out.append(data.decode("utf-8", "replace") if name == "text" else data)
                size += len(data)
                if size >= part or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(first, len(out)) for c in keep),
                         pa.array(out, pa.string() if name == "text" else pa.binary())],
                        names=[*keep, name])
                    first, out, size = i, [], 0

    return run


def decode(encoded: DataFrame, path: str, keep: list[str], name: str = "text",
           part: int = PART) -> DataFrame:
    """Columns ``keep`` of ``encoded``, with the ``text`` or the ``bytes`` (by ``name``) of its ids."""
    ship_package(encoded.sparkSession)
    kept = "".join(f"{c} {encoded.schema[c].dataType.simpleString()}, " for c in keep)
    kind = {"text": "string", "bytes": "binary"}[name]
    return encoded.select(*keep, "ids").mapInArrow(
        _decode(path, keep, name, part), f"{kept}{name} {kind}")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_split, ids_sha256, decoded_sha256 of every document."""
    ids = encode(docs, path, pattern).withColumn("ids_sha256", F.sha2("ids", 256))
    columns = ["doc_id", "n_tokens", "n_split", "ids_sha256"]
    return decode(ids, path, columns, "bytes").select(
        *columns, F.sha2("bytes", 256).alias("decoded_sha256"))
