"""Quotation linking: conversations in reply order, without quotes.

Lines that begin with '>' marks are quotes; the number of marks is their level.
Lines are normalised (marks and outer white space off, lower case, white space
runs to one space) and hashed to 128 bits. Each quoted line is joined to the
latest earlier message of its conversation that has the same line unquoted.
The message that most words of the lowest quoted level link to is the parent
(the latest on ties); deeper levels link to what the parent itself quoted and
only count as linked. Following parents gives each message's thread, named by
its first message, and messages are numbered per conversation by thread, then
turn. A parent is always an earlier turn, so every message stands after the
one it replies to.

Both the join (the last original at or before a place in sorted order) and the
numbering are sweeps over range-sorted rows: a task handles its range with
what the ranges before it leave at its border, one row a range, so a line, a
conversation or a thread with a third of all rows is split over many tasks.

Null text counts as empty. A null conv_id is a conversation of its own; a null
turn sorts first and is nobody's parent. Rows that repeat (conv_id, turn) are
messages each and share their links. Columns other than conv_id, turn and text
pass through, except those named like the added ones.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch, partitions_for

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ADDED = ["clean_text", "n_quoted", "n_linked", "parent_turn", "root_turn", "position"]


def parse_lines(text: str) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of every line."""
    out = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        out.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    return out


def normal_digest(line: str) -> tuple[bytes, int] | None:
    words = line.lower().split()
    if not words:
        return None
    return (hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=16).digest(),
            len(words))


def clean(text: str) -> str:
    """The text without quoted lines; empty lines at its ends go with them."""
    lines = parse_lines(text)
    if not any(level for level, _ in lines):
        return text
    return "\n".join(t for level, t in lines if not level).strip("\n")


def _lines(batches):
    """Messages -> their lines: level, digest, words."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for c, t, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "text"))):
            for level, line in parse_lines(text or ""):
                h = normal_digest(line)
                if h:
                    for col, v in zip(out, (c, t, level, h[0], h[1])):
                        col.append(v)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types)],
            names=["conv_id", "turn", "level", "digest", "words"])


def sorted_ranges(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Rows range-sorted by ``order``, with ``_pid`` and ``_head`` (a task's first key)."""
    n = partitions_for(df.sparkSession)
    schema = df.schema
    names = schema.fieldNames()

    def run(batches):
        pid, first = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            if not rows:
                continue
            first = rows[0] if first is None else first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([pid] * len(rows), pa.int32()),
                 pa.array([r == first for r in rows])], names=[*names, "_pid", "_head"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .mapInArrow(run, f"{ddl}, _pid int, _head boolean"))


def latest_original(lines: DataFrame, sc: Scratch) -> DataFrame:
    """Quoted lines with ``origin``: the turn of the latest earlier message that has the line."""
    keys = ["conv_id", "digest"]
    quoted = lines.where("level > 0").withColumn("is_quote", F.lit(True))
    # only lines that somebody quotes matter; one row for each message that has one
    wanted = quoted.select(*keys).distinct()
    own = lines.where("level = 0 and turn is not null").select(*keys, "turn", "words").distinct()
    own = own.alias("o").join(
        wanted.alias("w"), F.col("o.conv_id").eqNullSafe(F.col("w.conv_id"))
        & (F.col("o.digest") == F.col("w.digest")), "left_semi").select("o.*")
    both = quoted.unionByName(own.select(
        *keys, "turn", F.lit(0).alias("level"), "words", F.lit(False).alias("is_quote")))
    # a quote stands before originals of its own turn: only earlier ones count
    order = [F.col("conv_id").asc_nulls_first(), F.col("digest").asc(),
             F.col("turn").asc_nulls_first(), F.col("is_quote").desc(), F.col("level").asc()]
    names = ["conv_id", "turn", "level", "digest", "words", "is_quote"]

    def sweep(batches):
        key = last = None
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in
                    ("conv_id", "digest", "turn", "is_quote", "_head")}
            origin, waits = [], []
            for c, d, t, q in zip(*(cols[x] for x in ("conv_id", "digest", "turn", "is_quote"))):
                if (c, d) != key:
                    key, last = (c, d), None
                origin.append(last)
                if not q:
                    last = t
            waits = [h and o is None for h, o in zip(cols["_head"], origin)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(origin, pa.int64()),
                 batch.column("_pid"), pa.array(waits)], names=[*names, "origin", "_pid", "_waits"])

    ddl = ("conv_id long, turn long, level int, digest binary, words long, is_quote boolean, "
           "origin long, _pid int, _waits boolean")
    ranged = sorted_ranges(both.select(*names), keys, order)
    swept = sc.write(ranged.mapInArrow(sweep, ddl), "swept")
    # what each range leaves: its last key and that key's latest original in it
    tail = (swept.groupBy("_pid").agg(F.max(F.struct(
        F.col("conv_id").isNotNull().alias("k"), "conv_id", "digest")).alias("last"),
        F.min(F.struct(F.col("conv_id").isNotNull().alias("k"), "conv_id", "digest")).alias("first")))
    last_of = (swept.where(~F.col("is_quote")).join(
        tail.select(F.col("_pid").alias("_p"), "last"),
        (F.col("_pid") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("last.conv_id"))
        & (F.col("digest") == F.col("last.digest")))
        .groupBy("_pid").agg(F.max("turn").alias("turn")))
    left = {r["_pid"]: r["turn"] for r in last_of.collect()}
    carry, held, held_key = {}, None, None
    for r in sorted(tail.collect(), key=lambda r: r["_pid"]):
        first, last = (tuple(r[x]) for x in ("first", "last"))
        if held_key == first and held is not None:
            carry[r["_pid"]] = held
        if last != held_key:
            held = None
        held, held_key = left.get(r["_pid"], held if last == held_key else None), last
    quotes = swept.where("is_quote")
    if carry:
        given = F.create_map(*[F.lit(x) for kv in carry.items() for x in kv])
        quotes = quotes.withColumn("origin", F.when(
            F.col("_waits"), F.try_element_at(given, F.col("_pid"))).otherwise(F.col("origin")))
    return quotes.select("conv_id", "turn", "level", "words", "origin")


def numbered(df: DataFrame, key: str, order: list, name: str, sc: Scratch) -> DataFrame:
    """``df`` with ``position``: the row's number (from 0) within its key, by ``order``."""
    def count(batches):
        last, n = object(), 0
        for batch in batches:
            at = []
            for k in batch.column(key).to_pylist():
                if k != last:
                    last, n = k, 0
                at.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "_at"])

    ranged = sorted_ranges(df, [key], order)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    swept = sc.write(ranged.mapInArrow(count, f"{ddl}, _at long"), name)
    order_key = F.struct(F.col(key).isNotNull().alias("k"), F.col(key).alias("v"))
    tails = swept.groupBy("_pid").agg(
        F.min(order_key).alias("first"), F.max(order_key).alias("last"),
        F.count_if("_head").alias("heads"))
    last_n = {r["_pid"]: r["n"] for r in swept.join(
        tails.select(F.col("_pid").alias("_p"), "last"),
        (F.col("_pid") == F.col("_p")) & F.col(key).eqNullSafe(F.col("last.v")))
        .groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    carry, n, held = {}, 0, None
    for r in sorted(tails.collect(), key=lambda r: r["_pid"]):
        first, last = tuple(r["first"]), tuple(r["last"])
        if first == held and n:
            carry[r["_pid"]] = n
        n = last_n[r["_pid"]] + (n if last == held else 0)
        held = last
    more = F.lit(0)
    if carry:
        given = F.create_map(*[F.lit(x) for kv in carry.items() for x in kv])
        more = F.when(F.col("_head"), F.coalesce(F.try_element_at(given, F.col("_pid")), F.lit(0))
                      ).otherwise(0)
    return swept.withColumn("position", (F.col("_at") + more).cast("long")).drop(
        "_at", "_pid", "_head")


def thread_roots(parents: DataFrame, sc: Scratch) -> DataFrame:
    """(conv_id, turn, root): the first message of each reply chain, by pointer doubling."""
    link = sc.write(parents.select("conv_id", "turn", F.col("parent").alias("root")), "roots-0")
    i = 0
    while True:
        up = link.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"),
                         F.col("root").alias("_r"))
        i += 1
        nxt = sc.write(
            link.join(up, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("root") == F.col("_t")),
                      "left").select("conv_id", "turn", F.coalesce("_r", "root").alias("root"),
                                     F.col("_r").isNotNull().alias("_moved")), f"roots-{i}")
        link = nxt.drop("_moved")
        if nxt.where("_moved").isEmpty():
            return link


def link_conversations(messages: DataFrame) -> DataFrame:
    """``messages`` with clean_text, n_quoted, n_linked, parent_turn, root_turn, position."""
    sc = Scratch(messages.sparkSession, "quotes")
    base = messages.drop(*[c for c in ADDED if c in messages.columns])
    lines = sc.write(
        base.select(F.col("conv_id").cast("long").alias("conv_id"),
                    F.col("turn").cast("long").alias("turn"), F.col("text").cast("string"))
        .mapInArrow(_lines, "conv_id long, turn long, level int, digest binary, words long"),
        "lines")
    quotes = sc.write(latest_original(lines, sc), "quotes")
    by_origin = (quotes.groupBy("conv_id", "turn", "level", "origin")
                 .agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n")))
    per = sc.write(by_origin.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_quoted"),
        F.sum(F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"),
        # most words at the lowest linked level, then the latest
        F.max(F.when(F.col("origin").isNotNull(), F.struct(
            (-F.col("level")).alias("l"), F.col("words").alias("w"),
            F.col("origin").alias("o")))).alias("_best"))
        .select("conv_id", "turn", "n_quoted", "n_linked", F.col("_best.o").alias("parent")), "per")
    roots = thread_roots(per.where("parent is not null"), sc)
    info = per.alias("p").join(
        roots.alias("r"), F.col("p.conv_id").eqNullSafe(F.col("r.conv_id"))
        & (F.col("p.turn") == F.col("r.turn")), "left").select(
        F.col("p.conv_id").alias("_c"), F.col("p.turn").alias("_t"), "n_quoted", "n_linked",
        F.col("parent").alias("parent_turn"), "root")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = base.join(info, F.col("conv_id").cast("long").eqNullSafe(F.col("_c"))
                       & F.col("turn").cast("long").eqNullSafe(F.col("_t")), "left")
    rows = joined.withColumn("_text", text).select(
        *base.columns, "_text", F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_turn",
        F.coalesce("root", F.col("turn").cast("long")).alias("root_turn"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("root_turn").asc_nulls_first(),
             F.col("turn").asc_nulls_first(), F.xxhash64("_text").asc()]
    out = numbered(_cleaned(rows), "conv_id", order, "numbered", sc)
    return sc.finish(out.select(*base.columns, *ADDED))


def _cleaned(rows: DataFrame) -> DataFrame:
    """Add clean_text from ``_text`` (which stays, for the order)."""
    def run(batches):
        for batch in batches:
            out = [clean(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "clean_text"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{ddl}, clean_text string")
