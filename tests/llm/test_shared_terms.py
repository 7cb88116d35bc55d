"""Ranked search by shared term sets: DuckDB SQL, brute force, the mined graph."""

import collections
import math
import re

import duckdb
import numpy as np
import pytest

from clickvault.llm import queries, shared_terms
from clickvault.llm.common import Scratch
from test_brute import SF, awkward

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score)."""
    rows = [(d, collections.Counter(terms(t))) for d, t in docs]
    rows = [(d, c, sum(c.values())) for d, c in rows if c]
    n_all, length = len(rows), sum(n for _, _, n in rows)
    df = collections.Counter(t for _, c, _ in rows for t in c)
    of = collections.defaultdict(set)
    for i, t in items:
        of[i] |= set(terms(t))
    out = []
    for i, want in of.items():
        scored = []
        for d, c, n in rows:
            m = 100 - 90 + 90 * n * n_all // length
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in want if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql_and_brute_force(spark, sf):
    got = queries.op11_shared_terms(spark, sf)
    rows = sorted(map(tuple, got.collect()), key=str)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows == sorted(con.execute(queries.ORACLES["op11_shared_terms"]).fetchall(), key=str)
    table = lambda t: [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
    if sf == SF:
        assert rows == brute(table("documents"), table("benchmark"))


def test_awkward(spark):
    docs = awkward(spark).unionByName(spark.createDataFrame(
        [(None, "x1 x2 one"), (None, "x1 x2 one"), (40, "X1;x2\x00ONE É é\x7fz"), (41, "x1 x2 one"), (39, "x1 x2 one")],
        "doc_id long, text string"), allowMissingColumns=True)
    items = spark.createDataFrame(
        [(3, "one ONE two", "r"), (3, "x9 é", "r"), (None, "x1 x2 one", "r"), (4, None, "r"), (5, "", "r"),
         (6, "nowhere", "r"), (7, "x1 x2 one", "r"), (8, "x1 x2 x3 one two w5", "r")],
        "item_id long, text string, doc_id string")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    for block in (shared_terms.BLOCK, 2):
        got = shared_terms.rank_documents(docs, items, 10, block).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert shared_terms.rank_documents(docs.limit(0), items).count() == 0
    assert shared_terms.rank_documents(docs, items.limit(0)).count() == 0


def test_sets_are_shared_and_whole(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    sc = Scratch(spark, "sets")
    entries = shared_terms.item_terms(items, sc)
    ground, levels, rest = shared_terms.mine_sets(entries.select("item", "term"), sc, "t")
    plan = shared_terms.SharedPlan([tuple(r) for r in ground.select("term", "node").collect()], levels,
                                   [tuple(r) for r in rest.select("item", "node").collect()])
    # terms of each set, as counts: no term twice
    sums = np.zeros((plan.n_sets, len(plan.set_of)), np.int64)
    sums[plan.set_of, np.arange(len(plan.set_of))] = 1
    steps = 0
    for first, left, right in plan.levels:
        sums[first : first + len(left)] = sums[left] + sums[right]
        steps += len(left)
    got = np.add.reduceat(sums[plan.item_sets], plan.item_starts, axis=0)
    names = sorted(r.term for r in ground.collect())
    have = {(int(plan.items[i]), names[t]) for i, t in zip(*np.nonzero(got))}
    assert got.max() == 1 and have == {(r.item, r.term) for r in entries.collect()}
    # additions a document costs: less than half of one for each term of each item
    assert steps + len(plan.item_sets) < len(have) / 2
    sc.drop()
