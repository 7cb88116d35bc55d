"""Substring dedup by hashing lines or paragraphs.

A unit is a line (or a paragraph: lines up to an empty one). It is
normalised (lower case, white space runs to one space) and hashed to 128
bits. Digests are grouped over all documents; the occurrence with the
smallest (doc_id, row, unit number) stays, the others are repeats. In each
document, neighbouring repeats form a run (empty units in between do not
break it), and runs of at least ``min_words`` words are cut from the text, so
a passage is found however it is broken into lines while short boilerplate
such as a licence line stays. With ``inside``, every window of ``min_words``
words that occurs earlier is cut too, also inside lines (``passages``); the
counts of units stay those of whole units. What is cut is reported as [start, end) spans of the
original text, in characters.

Null text counts as empty. A row is known by its doc_id and the hash of its
text: rows equal in both are one document, which ranks once, and rows that
repeat a doc_id with another text are documents of their own. Each row with a
null doc_id is one, known by a written number; they rank after all others.
Columns other than doc_id and text
pass through; ``removed_spans``, ``n_units`` and ``n_removed_units`` are
added by ``dedup_units`` and replace columns of those names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickvault.llm import passages
from clickvault.llm.common import Scratch, lean

MIN_WORDS = 50
TASK_ROWS = 1024  # rows a task takes at a time
_LINE = re.compile(r"[^\n]*\n?")
_PARAGRAPH = re.compile(r"(?:[^\n]*\S[^\n]*\n?)+|[^\n]*\n?")
ADDED = ["n_units", "n_removed_units", "removed_spans"]


def units(text: str, kind: str = "line"):
    """(number, start, end, words, digest) of each unit that has a word."""
    at = n = 0
    if kind == "line":
        pieces = text.split("\n")
        step = 1
    else:
        pieces = [m.group() for m in _PARAGRAPH.finditer(text)]
        step = 0
    for p in pieces:
        words = p.lower().split()
        if words:
            end = min(len(text), at + len(p) + step)
            yield n, at, end, len(words), hashlib.blake2b(
                " ".join(words).encode("utf-8", "replace"), digest_size=16).digest()
            n += 1
        at += len(p) + step


def _unit_rows(kind: str):
    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for d, r, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_row", "text"))):
                for n, _, _, w, h in units(t or "", kind):
                    for col, v in zip(out, (d, r, n, w, h)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.binary())],
                names=["doc_id", "_row", "n", "words", "digest"])

    return run


def _merged(spans):
    """Spans in order, those that overlap or touch as one."""
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def cut_runs(text: str, repeats: set[int], min_words: int, kind: str, windows=()):
    """(text left, units, removed units, removed spans) of one document."""
    spans, run, words, n_units, removed = [], [], 0, 0, 0

    def close():
        nonlocal removed
        if words >= min_words:
            removed += len(run)
            for s, e in run:
                if spans and spans[-1][1] == s:
                    spans[-1] = (spans[-1][0], e)
                else:
                    spans.append((s, e))

    for n, s, e, w, _ in units(text, kind):
        n_units += 1
        if n in repeats:
            run.append((s, e))
            words += w
        else:
            close()
            run, words = [], 0
    close()
    if windows:
        spans = _merged([*spans, *passages.spans(text, windows, min_words)])
    left, at = [], 0
    for s, e in spans:
        left.append(text[at:s])
        at = e
    left.append(text[at:])
    out = "".join(left)
    return (out.rstrip("\n") if spans and spans[-1][1] == len(text) else out,
            n_units, removed, spans)


def _apply(schema: T.StructType, min_words: int, kind: str):
    names = schema.fieldNames()
    arrow = {"n_units": pa.int64(), "n_removed_units": pa.int64(),
             "removed_spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            marks = batch.column("_repeats").to_pylist()
            places = batch.column("_places").to_pylist()
            new = {"text": [], "n_units": [], "n_removed_units": [], "removed_spans": []}
            for t, m, p in zip(texts, marks, places):
                left, n, k, spans = cut_runs(t or "", set(m or ()), min_words, kind, p or ())
                new["text"].append(left if t is not None else None)
                new["n_units"].append(n)
                new["n_removed_units"].append(k)
                new["removed_spans"].append([{"start": s, "end": e} for s, e in spans])
            cols = []
            for c in names:
                if c == "text":
                    cols.append(pa.array(new[c], batch.column("text").type))
                elif c in arrow:
                    cols.append(pa.array(new[c], arrow[c]))
                else:
                    cols.append(batch.column(c))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def known_rows(docs: DataFrame, sc: Scratch) -> DataFrame:
    """``docs`` with ``_row``, which with the doc_id tells rows apart."""
    unnamed = F.col("doc_id").isNull()
    # written, so a row has the same number whenever it is read
    null = sc.write(
        docs.where(unnamed).withColumn("_row", F.monotonically_increasing_id()), "unnamed")
    return docs.where(~unnamed).withColumn(
        "_row", F.xxhash64(F.coalesce("text", F.lit("")))).union(null)


def repeated_units(docs: DataFrame, sc: Scratch, kind: str = "line") -> DataFrame:
    """(doc_id, _row, n) of every unit occurrence but the earliest of its digest."""
    rows = sc.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_row", "text").mapInArrow(
            lean(_unit_rows(kind), TASK_ROWS), "doc_id long, _row long, n long, words long, digest binary"), "rows")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row", "n")
    # counts and minima combine on the map side: a digest in a third of all rows is one row a task
    again = (rows.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("k"))
             .where("k > 1").select("digest", "first"))
    # written, so the join shuffles both sides itself and can split a frequent digest
    again = sc.write(again, "again")
    return rows.join(again, "digest").where(rank != F.col("first")).select("doc_id", "_row", "n")


def dedup_units(docs: DataFrame, min_words: int = MIN_WORDS, kind: str = "line",
                inside: bool = False) -> DataFrame:
    """``docs`` with repeated passages cut; adds n_units, n_removed_units, removed_spans."""
    sc = Scratch(docs.sparkSession, "units")
    docs = docs.drop(*[c for c in ADDED if c in docs.columns])
    schema = T.StructType([f for f in docs.schema.fields] + [
        T.StructField("n_units", T.LongType()), T.StructField("n_removed_units", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    docs = known_rows(docs, sc)
    marks = repeated_units(docs, sc, kind).withColumn("p", F.lit(None).cast("long"))
    if inside:
        marks = marks.unionByName(
            passages.repeated_windows(docs, sc, min_words), allowMissingColumns=True)
    marks = sc.write(marks.groupBy("doc_id", "_row").agg(
        F.collect_set("n").alias("_repeats"), F.collect_set("p").alias("_places")), "marks")
    joined = docs.join(
        marks.withColumnsRenamed({"doc_id": "_doc", "_row": "_of"}),
        (F.col("_row") == F.col("_of")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")),
        "left").drop("_doc", "_of")
    return joined.mapInArrow(lean(_apply(schema, min_words, kind), TASK_ROWS), schema)
