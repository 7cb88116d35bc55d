"""Repeated passages inside lines: windows of ``width`` words that occur earlier.

Every window of ``width`` words is named by the smallest of its shorter word
runs (winnowing), so two equal windows have the same name wherever they stand.
Names that occur once end there; the windows of the others are hashed to 128
bits and grouped over all documents, and each but the earliest is a repeat. No
repeated window is missed. Documents whose words all equal an earlier one's are
repeats as a whole and take no part. Words are those of the lower-case text,
cut at white space; ranks are those of ``unit_dedup``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import (
    Scratch,
    _powers,
    lean,
    mix64,
    row_chunks,
    string_buffers,
    word_hashes,
    word_spans,
)

TASK_ROWS = 1024  # rows a task takes at a time
_WORD = re.compile(r"\S+")
_SECOND = np.uint64(0xA0761D6478BD642F)


def _rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on."""
    b, inv = _powers(len(h) + 1)
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * b[: len(h)], out=prefix[1:])
    return mix64((prefix[k:] - prefix[:-k]) * inv[: len(h) - k + 1])


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``n`` neighbours."""
    size = 1
    while size * 2 <= n:
        x, size = op(x[:-size], x[size:]), size * 2
    return op(x[: len(x) - (n - size)], x[n - size :]) if size < n else x


def _chunks(batch, width: int):
    """(first row, rows, word hashes, row of each word) of the batch's texts, part by part."""
    texts = pa.array([" ".join((t or "").lower().split()) for t in batch.column("text").to_pylist()],
                     pa.large_string())
    buf, offsets = string_buffers(texts)
    for i, j in row_chunks(offsets):
        part, off = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        s, e, row = word_spans(part, off)
        if len(s) >= width:
            yield i, j - i, word_hashes(part, s, e, lower=False), row


def _names(h: np.ndarray, row: np.ndarray, width: int):
    """(hash of each shorter run, name of each window, windows within one row)."""
    k = max(1, width * 2 // 5)
    runs = _rolling(h, k)
    return (runs, _sliding(runs, width - k + 1, np.minimum),
            row[: len(h) - width + 1] == row[width - 1 :], width - k)


def _winnow(width: int):
    """Rows -> the names of their windows and a digest of all their words."""
    def run(batches):
        for batch in batches:
            for i, n, h, row in _chunks(batch, width):
                runs, names, inside, pad = _names(h, row, width)
                edge = np.zeros(pad, np.uint64)
                top = _sliding(np.concatenate([edge, np.where(inside, names, 0), edge]), pad + 1,
                               np.maximum)
                at = np.flatnonzero((top == runs) & (top > 0))
                ends = np.searchsorted(row, np.arange(n + 1))
                long = np.flatnonzero(np.diff(ends) >= width)
                b, inv = _powers(len(h) + 1)
                whole = []
                for x in (h, mix64(h ^ _SECOND)):
                    prefix = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(x * b[: len(h)], out=prefix[1:])
                    whole.append(mix64((prefix[ends[long + 1]] - prefix[ends[long]])
                                       * inv[ends[long]]).view(np.int64))
                # names stand only in rows that are long enough, so these are cut without gaps
                cuts = np.searchsorted(row[at], np.append(long, n)).astype(np.int32)
                take = pa.array(long + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("_row").take(take),
                     pa.array(np.diff(ends)[long]), *map(pa.array, whole),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(runs[at].view(np.int64)))],
                    names=["doc_id", "_row", "words", "a", "b", "names"])

    return run


def _pair(name: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix64(name + row.astype(np.uint64) * _SECOND)


def _window_rows(width: int):
    """Rows with ``_names`` -> place and digest of each of their windows that has such a name."""
    def run(batches):
        for batch in batches:
            asked = batch.column("_names")
            of = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy(zero_copy_only=False))
            asked = asked.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for i, n, h, row in _chunks(batch, width):
                _, names, inside, _ = _names(h, row, width)
                mine = (of >= i) & (of < i + n)
                at = np.flatnonzero(inside & np.isin(
                    _pair(names, row[: len(names)]), _pair(asked[mine], of[mine] - i)))
                take = pa.array(row[at] + i)
                first = np.searchsorted(row, row[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("_row").take(take),
                     pa.array(at - first),
                     *[pa.array(_rolling(x, width)[at].view(np.int64))
                       for x in (h, mix64(h ^ _SECOND))]],
                    names=["doc_id", "_row", "p", "a", "b"])

    return run


def _later(rows: DataFrame, rank, sc: Scratch, name: str) -> DataFrame:
    """The rows but the earliest of each digest (a, b)."""
    again = (rows.groupBy("a", "b").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("k"))
             .where("k > 1").select("a", "b", "first"))
    # written, so the join shuffles both sides itself and can split a frequent digest
    return rows.join(sc.write(again, name), ["a", "b"]).where(rank != F.col("first"))


def repeated_windows(docs: DataFrame, sc: Scratch, width: int) -> DataFrame:
    """(doc_id, _row, p) of each window that occurs earlier, at word ``p``; p is -1 for all of a row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_row", "text")
    key = [F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("_row")]
    # rows equal in doc_id and text are one document, with the marks of one
    all_rows = sc.write(texts.mapInArrow(
        lean(_winnow(width), TASK_ROWS), "doc_id long, _row long, words long, a long, b long, names array<long>"),
        "names")
    copies = sc.write(_later(all_rows.drop("names"), F.struct(*key), sc, "wholes")
                      .select("doc_id", "_row").distinct(), "copies")
    same = [F.col("_row") == F.col("_of"), F.col("doc_id").eqNullSafe(F.col("_doc"))]
    other = {"doc_id": "_doc", "_row": "_of"}
    named = (all_rows.join(copies.withColumnsRenamed(other), same, "left_anti")
             .select("doc_id", "_row", F.explode("names").alias("name")))
    named = sc.write(named, "named")
    # counts combine on the map side; written for the join, as above
    often = sc.write(named.groupBy("name").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
                     .select("name"), "often")
    asked = sc.write(named.join(often, "name").groupBy("doc_id", "_row")
                     .agg(F.collect_set("name").alias("_names")), "asked")
    windows = sc.write(
        texts.join(asked.withColumnsRenamed(other), same).drop("_doc", "_of").mapInArrow(
            lean(_window_rows(width), TASK_ROWS), "doc_id long, _row long, p long, a long, b long"), "windows")
    later = _later(windows, F.struct(*key, "p"), sc, "window-again")
    return later.select("doc_id", "_row", "p").union(
        copies.select("doc_id", "_row", F.lit(-1).cast("long")))


def spans(text: str, places, width: int) -> list[tuple[int, int]]:
    """[start, end) of what the repeated windows at ``places`` cover, with the blanks after it."""
    words = [m.span() for m in _WORD.finditer(text)]
    if -1 in places:
        return [(0, len(text))]
    out: list[tuple[int, int]] = []
    at = 0
    for p in sorted(places):
        first, last = words[p][0], words[p + width - 1][1]
        if out and p <= at:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
        at = p + width
    return [(s, _blanks(text, s, e)) for s, e in out]


def _blanks(text: str, start: int, end: int) -> int:
    """Where the cut ends: after blanks, and after the line's end if it began a line."""
    while end < len(text) and text[end].isspace() and text[end] != "\n":
        end += 1
    if end < len(text) and text[end] == "\n" and (start == 0 or text[start - 1] == "\n"):
        end += 1
    return end
