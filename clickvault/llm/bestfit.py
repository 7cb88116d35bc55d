"""Best-fit packing in bulk-synchronous rounds.

Items (pieces of documents, in tokens) are placed into sequences of a fixed
capacity. Items over half the capacity open a sequence each. Then, in rounds:

1. documents (items not yet placed) and gaps (room left in open sequences)
   are range-sorted together, largest first, a gap before a document of the
   same size;
2. a successor sweep gives each document the smallest free gap that holds it:
   each range is swept by one task with a stack, what a task leaves over is
   numbered, and from the ranges' two counts alone the left-over documents
   are assigned to left-over gaps of earlier ranges and joined by number;
3. a gap that several documents want goes to the first in rank (larger, then
   smaller id); the others take the next gaps or wait;
4. gaps are updated and the next round begins. When no gap holds any document,
   as many sequences are opened as the waiting tokens need at least.

A gap that holds several of the largest waiting document is offered as that
many slots, so short documents do not need a round each.

Only the per-range counts (two numbers a range) and sums reach the driver.
Null text is an empty document, which still has its end token. Rows with a
null or repeated doc_id are pieces of their own like all others.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch, number_rows, partitions_for
from clickvault.llm.tokens import encode_rows, gathered

ROWS_PER_RANGE = 100_000
_PIECES = ("uid long, doc_id long, piece int, start long, length long, ids_crc32 long")


def _cut(path: str, end_id: int, capacity: int):
    """Documents -> their pieces; only documents over the capacity are cut, the first piece shorter."""
    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for ids, texts in gathered(batches):
            out: list[list] = [[], [], [], [], [], []]
            for r, data in encode_rows(texts, path):
                data += end
                n = len(data) // 4
                head = n % capacity or capacity
                edges = [0, *range(head, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    row = (uid, ids[r], k, a, b - a, zlib.crc32(data[4 * a : 4 * b]))
                    uid += 1
                    for col, v in zip(out, row):
                        col.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return run


MATCH, DOC, GAP = 0, 1, 2
_SWEPT = "kind int, id long, gap long, size long, pid int, at long"


def _sweep(batches):
    """Rows (size, is_doc, id) sorted largest first -> matches and numbered left-overs."""
    pid = TaskContext.get().partitionId()
    stack: list[int] = []
    docs = 0
    for batch in batches:
        is_doc = batch.column("is_doc").to_pylist()
        ids = batch.column("id").to_pylist()
        sizes = batch.column("size").to_pylist()
        kind, doc, gap, size, at = [], [], [], [], []
        for d, i, n in zip(is_doc, ids, sizes):
            if not d:
                stack.append(i)
                continue
            doc.append(i)
            size.append(n)
            if stack:
                kind.append(MATCH)
                gap.append(stack.pop())
                at.append(None)
            else:
                kind.append(DOC)
                gap.append(None)
                at.append(docs)
                docs += 1
        if kind:
            yield _swept(kind, doc, gap, size, pid, at)
    for i in range(0, len(stack), 10000):
        part = stack[i : i + 10000]
        none = [None] * len(part)
        yield _swept([GAP] * len(part), none, part, none, pid, range(i, i + len(part)))


def _swept(kind, doc, gap, size, pid, at):
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(doc, pa.int64()), pa.array(gap, pa.int64()),
         pa.array(size, pa.int64()), pa.array([pid] * len(kind), pa.int32()),
         pa.array(list(at), pa.int64())],
        names=["kind", "id", "gap", "size", "pid", "at"])


def carry_over(counts: dict[int, tuple[int, int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Assign ranges' left-over documents to left-over gaps of earlier ranges.

    ``counts``: range -> (documents, gaps) left over. Returns, by range of the
    documents, segments (first, end, range of the gaps, number of the gap that
    document ``first`` takes); the following documents take the gaps before it,
    which are the next larger ones.
    """
    stack: list[list[int]] = []  # [range, gaps left]
    plan: dict[int, list[tuple[int, int, int, int]]] = {}
    for p in sorted(counts):
        docs, gaps = counts[p]
        at = 0
        while at < docs and stack:
            q, left = stack[-1]
            n = min(docs - at, left)
            plan.setdefault(p, []).append((at, at + n, q, left - 1))
            at += n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if gaps:
            stack.append([p, gaps])
    return plan


def _aim(plan: dict):
    """Left-over documents -> (id, size, range and number of their gap; nulls when they wait)."""
    ends = {p: [s[1] for s in segments] for p, segments in plan.items()}

    def run(batches):
        for batch in batches:
            to_pid, to_at = [], []
            for p, a in zip(batch.column("pid").to_pylist(), batch.column("at").to_pylist()):
                k = bisect_right(ends.get(p, ()), a)
                if p in plan and k < len(plan[p]):
                    first, _, q, g = plan[p][k]
                    to_pid.append(q)
                    to_at.append(g - (a - first))
                else:
                    to_pid.append(None)
                    to_at.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("size"), pa.array(to_pid, pa.int32()),
                 pa.array(to_at, pa.int64())], names=["id", "size", "pid", "at"])

    return run


def successor_sweep(docs: DataFrame, gaps: DataFrame, sc: Scratch, name: str,
                    rows: int) -> tuple[DataFrame, DataFrame]:
    """Documents (id, size) matched with distinct gaps (gap, size), best fit first.

    Returns (id, gap, size) of the matched and (id, size) of those that wait;
    only the left-overs of the ranges are shuffled again.
    """
    spark = docs.sparkSession
    both = docs.select("size", F.lit(True).alias("is_doc"), "id").union(
        gaps.select("size", F.lit(False).alias("is_doc"), F.col("gap").alias("id")))
    ranges = max(1, min(partitions_for(spark), -(-rows // ROWS_PER_RANGE)))
    order = [F.col("size").desc(), F.col("is_doc").asc(), F.col("id").asc()]
    swept = sc.write(
        both.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .mapInArrow(_sweep, _SWEPT), name)
    counts: dict[int, list[int]] = {}
    for r in swept.where(F.col("kind") > MATCH).groupBy("pid", "kind").count().collect():
        counts.setdefault(r["pid"], [0, 0])[r["kind"] - 1] = r["count"]
    plan = carry_over({p: (c[0], c[1]) for p, c in counts.items()})
    matched = swept.where(F.col("kind") == MATCH).select("id", "gap", "size")
    aimed = swept.where(F.col("kind") == DOC).select("id", "size", "pid", "at").mapInArrow(
        _aim(plan), "id long, size long, pid int, at long")
    if plan:
        free = swept.where(F.col("kind") == GAP).select("gap", "pid", "at")
        matched = matched.union(aimed.join(free, ["pid", "at"]).select("id", "gap", "size"))
    return matched, aimed.where(F.col("pid").isNull()).select("id", "size")


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """(uid, bin, offset) for items (uid, length <= capacity); bins are named by an item's uid."""
    sc = Scratch(items.sparkSession, "bestfit")
    placed = sc.write(
        items.where(2 * F.col("length") > capacity)
        .select("uid", F.col("uid").alias("bin"), "length", F.lit(0).alias("round")), "placed-0")
    docs = sc.write(items.where(2 * F.col("length") <= capacity)
                    .select(F.col("uid").alias("id"), F.col("length").alias("size")), "docs-0")
    room = sc.write(placed.select("bin", (F.lit(capacity) - F.col("length")).alias("room"))
                    .where("room > 0"), "room-0")
    parts, rnd = [placed], 0
    while True:
        left = docs.agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("lo"),
                        F.max("size").alias("hi"), F.sum("size").alias("tokens")).first()
        if not left["n"]:
            break
        rnd += 1
        room = room.where(F.col("room") >= left["lo"])
        have = room.agg(F.count(F.lit(1)).alias("n"), F.max("room").alias("hi")).first()
        if not have["n"]:
            # nothing fits anywhere: open what the waiting tokens need at least, for the largest
            first = -(-left["tokens"] // capacity)
            largest = number_rows(docs, [F.col("size").desc(), F.col("id").asc()], sc, f"sized-{rnd}", "_n")
            room = sc.write(largest.where(F.col("_n") <= first).select(
                F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("room")), f"open-{rnd}")
            sc.drop(f"sized-{rnd}")
            have = {"n": first}
        # a gap for several of the largest document is offered as so many slots
        most = max(1, -(-2 * left["n"] // have["n"]))
        slots = F.greatest(F.lit(1), F.least(F.floor(F.col("room") / left["hi"]), F.lit(most)))
        offers = room.select("bin", "room", slots.cast("int").alias("slots")).select(
            "bin", F.floor(F.col("room") / F.col("slots")).cast("long").alias("size"),
            F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
        # a gap goes by its bin; the slots of one bin are rows of equal name and size
        gaps = offers.select(F.col("bin").alias("gap"), "size")
        matched, waiting = successor_sweep(
            docs, gaps, sc, f"swept-{rnd}", left["n"] + have["n"])
        now = sc.write(
            matched.select(F.col("id").alias("uid"), F.col("gap").alias("bin"),
                           F.col("size").alias("length"), F.lit(rnd).alias("round")),
            f"placed-{rnd}")
        parts.append(now)
        docs = sc.write(waiting, f"docs-{rnd}")
        room = sc.write(
            room.union(now.select("bin", (-F.col("length")).alias("room")))
            .groupBy("bin").agg(F.sum("room").alias("room")).where("room > 0"), f"room-{rnd}")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    w = Window.partitionBy("bin").orderBy("round", "uid").rowsBetween(Window.unboundedPreceding, -1)
    return sc.finish(every.select(
        "uid", "bin", F.coalesce(F.sum("length").over(w), F.lit(0)).alias("offset")))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    sc = Scratch(docs.sparkSession, "pack")
    items = sc.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_cut(tokenizer, end_id, capacity), _PIECES), "pieces")
    short = best_fit(items.where(F.col("length") < capacity).select("uid", "length"), capacity)
    full = items.where(F.col("length") == capacity).select(
        *[c for c in items.columns], F.col("uid").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity).join(short, "uid").select(
        *items.columns, F.col("bin").alias("sequence_id"), F.col("offset").cast("long"))
    return sc.finish(full.union(rest).drop("uid"))
