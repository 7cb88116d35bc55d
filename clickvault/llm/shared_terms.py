"""Ranked lexical search of many items at once, sharing common term sets.

Every item is a set of terms, and a document's score for it is the sum of its terms'
contributions (integer BM25-like). Items share terms, so sums are shared:

1. Term sets are mined among the items with DataFrame operations. Terms that lie in
   the same items are one set, found by an order-free digest of their item lists. Then, in
   rounds, each item's sets are put in order of support and adjacent pairs that two or
   more items have become new sets; of overlapping pairs the one with more items is taken.
   The result is a directed graph: a set is some terms, or the sum of two sets, and an item
   is the sum of what is left in its list. Nothing compares items with each other.
2. All documents are scanned once. A posting row holds a document's length and the items'
   terms in it with their counts; document frequencies and lengths are added up from these.
3. A task turns some hundred documents at a time into accumulators: one per term set, summed
   once from the postings, then along the graph level by level, then into item scores.
   It keeps each item's best ``k`` so far, and the tasks' lists meet in two steps, salted by
   document and then by item.

Items are taken ``BLOCK`` at a time, so the plan that goes to all tasks is the terms of
so many items. Weights and scores are 64-bit integers; accumulators are exact.

Null or term-free texts match nothing and do not count as documents. Rows that repeat a
doc_id are documents of their own; a null doc_id comes after all others among equal scores.
Rows that repeat an item_id (or have none) are one item with all their terms. Extra
columns are ignored. Without items or documents there are no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import (
    Scratch,
    number_rows,
    row_chunks,
    string_buffers,
    word_hashes,
    word_spans,
)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 4096  # items of one plan
ROUNDS = 8  # levels of the graph at most; a longer common part stays in more pieces
DOCS = 512  # documents whose accumulators are held at once
SALT = 64
NO_ID = (1 << 63) - 1  # a null doc_id while ranks are made

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_IS_OTHER = np.ones(256, bool)  # bytes outside terms
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _IS_OTHER[_low:_high] = False


# ----------------------------------------------------------------- term sets of items
def item_terms(items: DataFrame, sc: Scratch) -> DataFrame:
    """(item, item_id, term): distinct terms of each item; items are numbered from 0."""
    low = F.translate("text", _UPPER, _UPPER.lower())
    terms = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")).distinct()
    terms = sc.write(terms, "terms")
    numbers = number_rows(terms.select("item_id").distinct(), [F.col("item_id").asc_nulls_last()],
                          sc, "items", "_n")
    same = terms["item_id"].eqNullSafe(numbers["item_id"])
    return sc.write(terms.join(numbers, same).select(
        (F.col("_n") - 1).alias("item"), terms["item_id"], "term"), "item-terms")


def mine_sets(entries: DataFrame, sc: Scratch, name: str) -> tuple[DataFrame, list, DataFrame]:
    """Term sets shared among items, from (item, term) rows.

    Returns (term, node) of the ground sets, the levels of joined sets, each a list of
    (node, left, right), and (item, node): the sets whose sum is the item.
    """
    lists = entries.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"),
        F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"))
    ground = sc.write(
        lists.select("term", F.concat_ws(":", "n", F.hex("x"), F.hex("y")).alias("node")),
        f"{name}-ground")
    nodes = sc.write(entries.join(ground, "term").select("item", "node").distinct(), f"{name}-nodes-0")
    levels = []
    for rnd in range(1, ROUNDS + 1):
        support = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("support"))
        shared = nodes.join(support.where("support > 1"), "node")
        by = Window.partitionBy("item").orderBy(F.col("support").desc(), "node")
        pairs = sc.write(
            shared.select("item", "support", F.col("node").alias("left"),
                          F.lead("node").over(by).alias("right")).where("right is not null"),
            f"{name}-pairs-{rnd}")
        count = pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        place = Window.partitionBy("item").orderBy(F.col("support").desc(), "left")
        n = F.coalesce("n", F.lit(0))
        best = pairs.join(count, ["left", "right"], "left").select(
            "item", "left", "right", n.alias("n"), F.lag(n, 1, 0).over(place).alias("before"),
            F.lead(n, 1, 0).over(place).alias("after"))
        # a pair gives way to a neighbour with more items, or with as many that stands before it
        taken = best.where("n > 1 AND n > before AND n >= after").select("item", "left", "right")
        enough = taken.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        joined = sc.write(
            taken.join(enough.drop("n"), ["left", "right"]).select(
                "item", "left", "right", F.sha2(F.concat_ws("+", "left", "right"), 256).alias("node")),
            f"{name}-joined-{rnd}")
        level = joined.select("node", "left", "right").distinct().collect()
        if not level:
            break
        levels.append([tuple(r) for r in level])
        gone = joined.select("item", F.explode(F.array("left", "right")).alias("node"))
        nodes = sc.write(
            nodes.join(gone, ["item", "node"], "left_anti").union(joined.select("item", "node")),
            f"{name}-nodes-{rnd}")
    return ground, levels, nodes


class SharedPlan:
    """Terms, term sets and items of one block, as arrays."""

    def __init__(self, ground: list, levels: list, rest: list):
        ground = sorted(ground)  # (term, node)
        index: dict[str, int] = {}
        for _, node in ground:
            index.setdefault(node, len(index))
        self.n_ground = len(index)
        self.set_of = np.array([index[node] for _, node in ground], np.int64)
        self.levels = []  # (first new set, left sets, right sets)
        for level in levels:
            first = len(index)
            level = [x for x in level if x[0] not in index]  # a later round may join a pair again
            for node, _, _ in level:
                index[node] = len(index)
            self.levels.append((first, np.array([index[a] for _, a, _ in level], np.int64),
                                np.array([index[b] for _, _, b in level], np.int64)))
        self.n_sets = len(index)
        rest = sorted((item, index[node]) for item, node in rest)
        self.items = np.array(sorted({i for i, _ in rest}), np.int64)
        at = np.array([i for i, _ in rest], np.int64)
        self.item_sets = np.array([s for _, s in rest], np.int64)
        self.item_starts = np.searchsorted(at, self.items)
        data = [t.encode() for t, _ in ground]
        buf = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum([len(d) for d in data])
        hashes = word_hashes(buf, ends - [len(d) for d in data], ends, lower=False)
        self.order = np.argsort(hashes)
        self.hashes, self.size = hashes[self.order], np.array([len(d) for d in data])[self.order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items have the same hash")

    def terms(self, hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of each word's term, -1 where no item has it."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.size[at] == size), self.order[at], -1)


# ------------------------------------------------------------------------- documents
def _postings(plan: SharedPlan):
    def run(batches):
        v = np.int64(len(plan.hashes))
        for batch in batches:
            buf, offsets = string_buffers(batch.column("text"))
            for i, j in row_chunks(offsets):
                off = offsets[i : j + 1] - offsets[i]
                part = buf[offsets[i] : offsets[j]]
                s, e, row = word_spans(part, off, _IS_OTHER)
                n = np.bincount(row, minlength=j - i)
                term = plan.terms(word_hashes(part, s, e, lower=True), e - s)
                known = term >= 0
                key, tf = np.unique(row[known] * v + term[known], return_counts=True)
                at = np.searchsorted(key, np.arange(j - i + 1) * v)
                key, tf = (key % v).astype("<u4"), tf.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array([key[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                     pa.array([tf[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())],
                    names=["doc_id", "n", "terms", "tf"])

    return run


def _frequencies(size: int):
    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column("terms"):
                df[np.frombuffer(data.as_py(), "<u4")] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    return run


class Best:
    """The best ``k`` (score, doc_id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.ones(items, np.int64)  # a score below it cannot be among them

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores``: items by documents."""
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item) :], at]])
        doc = np.concatenate([self.doc, docs[at]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        top = rank < self.k
        self.item, self.score, self.doc = item[top], score[top], doc[top]
        last = rank == self.k - 1
        self.least[item[last]] = score[last]


def contributions(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _score(plan: SharedPlan, weight: np.ndarray, n_docs: int, length: int, k: int):
    def run(batches):
        best = Best(len(plan.items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS).to_pydict()
                docs = np.array([NO_ID if d is None else d for d in part["doc_id"]], np.int64)
                terms = [np.frombuffer(x, "<u4") for x in part["terms"]]
                row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
                term = np.concatenate(terms).astype(np.int64)
                tf = np.concatenate([np.frombuffer(x, "<i8") for x in part["tf"]])
                # Python's integers: the product may leave 64 bits
                m = np.array([100 - 90 + 90 * n * n_docs // length for n in part["n"]], np.int64)
                value = contributions(weight[term], tf, m[row])
                sums = np.zeros((plan.n_sets, len(docs)), np.int64)
                # below 2**53 each, so the sums in doubles are exact
                sums[: plan.n_ground] = np.bincount(
                    plan.set_of[term] * len(docs) + row, weights=value,
                    minlength=plan.n_ground * len(docs)).reshape(plan.n_ground, len(docs))
                for first, left, right in plan.levels:
                    sums[first : first + len(left)] = sums[left] + sums[right]
                best.add(np.add.reduceat(sums[plan.item_sets], plan.item_starts, axis=0), docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(plan.items[best.item], pa.int64()), pa.array(best.doc, pa.int64()),
             pa.array(best.score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, entries: DataFrame, k: int, sc: Scratch, name: str) -> DataFrame:
    """(item, doc_id, score) of each task's best ``k`` for the items of one block."""
    ground, levels, rest = mine_sets(entries, sc, name)
    plan = SharedPlan([tuple(r) for r in ground.select("term", "node").collect()], levels,
                      [tuple(r) for r in rest.select("item", "node").collect()])
    postings = sc.write(
        docs.mapInArrow(_postings(plan), "doc_id long, n long, terms binary, tf binary"),
        f"{name}-postings")
    used = postings.where("n > 0")
    total = used.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
    df = np.zeros(len(plan.hashes), np.int64)
    found = used.select("terms").mapInArrow(_frequencies(len(df)), "term long, df long")
    for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * d + 1)))
                       for d in df.tolist()], np.int64)
    near = used.where(F.length("terms") > 0).mapInArrow(
        _score(plan, weight, total["docs"], total["length"] or 1, k),
        "item long, doc_id long, score long")
    out = sc.write(near, f"{name}-best")
    sc.drop(f"{name}-postings")
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` documents with the highest score above 0."""
    sc = Scratch(docs.sparkSession, "search")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    entries = item_terms(items, sc)
    n_items = (entries.agg(F.max("item")).first()[0] or 0) + 1
    best = None
    for i, first in enumerate(range(0, n_items, block)):
        mine = entries.where(F.col("item").between(first, first + block - 1)).select("item", "term")
        if mine.isEmpty():
            break
        found = _search_block(texts, mine, k, sc, f"block-{i}")
        best = found if best is None else best.union(found)
    if best is None:
        best = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALT))
    for by in (("item", "_salt"), ("item",)):
        best = best.withColumn("_salt", salt).withColumn(
            "rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
                F.col("rank") <= k)
    names = entries.select("item", "item_id").distinct()
    return sc.finish(best.join(names, "item").select(
        "item_id", "rank", F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
