"""The corpus pipeline against brute force: every stage on its own input, and run() as a whole."""

import re

import corpus_pipeline
from clickvault.llm import cotrain
from test_brute import awkward, base_measures, check_packing, components
from test_passages import brute

SF = "/root/testdata/sf0.001"
URL = re.compile(r"[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)")


def brute_rules(docs):
    """Documents that pass the base rules and whose host's shrunk failure rate is at most 0.5."""
    def host(r):
        s = (r.source or "").strip(" ").lower()
        m = URL.match(s)
        return m.group(1) if m else s

    failed = [base_measures(r.text)[-1] for r in docs]
    hosts = {}
    for r, bad in zip(docs, failed):
        n, f = hosts.get(host(r), (0, 0))
        hosts[host(r)] = (n + 1, f + bad)
    total = sum(n for n, _ in hosts.values())
    if not total:
        return []
    mean = sum(f for _, f in hosts.values()) / total
    spread = mean * (1 - mean)
    between = sum(f * f / n for n, f in hosts.values()) / total - mean**2 - spread * len(hosts) / total
    strength = float(total)
    if between > 0 and spread > 0:
        strength = min(max(spread / between - 1, 1.0), total)
    rejected = {h for h, (n, f) in hosts.items() if (f + mean * strength) / (n + strength) > 0.5}
    return [r for r, bad in zip(docs, failed) if not bad and host(r) not in rejected]


def brute_substrings(docs):
    """doc_id -> words left without repeated passages; emptied documents left out."""
    left = brute([(r.doc_id, r.text) for r in docs], 50)
    return {d: w for d, w in left.items() if w}


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in cotrain.score(docs, labels).where("kept").collect()}
    want = [r for r in docs.collect() if r.doc_id in good]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "quality rules", "n-gram Jaccard join",
                            "substring dedup", "best-fit packing"]

    def step(name, df):
        out = stages[name](spark, df, SF)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        return spark.read.parquet(path)

    got = step("quality classifier", docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))

    want = brute_rules(want)
    got = step("quality rules", got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))

    own = {d for d, _, c in components([(r.doc_id, r.text) for r in want], 80, 100, 5) if d == c}
    want = [r for r in want if r.doc_id in own]
    got = step("n-gram Jaccard join", got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))

    texts = brute_substrings(want)
    got = step("substring dedup", got)
    rows = got.collect()
    assert got.columns == docs.columns and len(rows) == len(texts)
    for r in rows:
        assert r.text.split() == texts[r.doc_id]

    left = [(r.doc_id, r.text) for r in rows]
    n, tokens = check_packing(step("best-fit packing", got).collect(), left, 1024)
    assert n <= -(-tokens // 1024) * 1.05 + 1
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in whole} == set(texts)
    assert check_packing(whole, left, 1024) == (n, tokens)


def test_stages_awkward(spark):
    """Nulls, empties, repeats, clashing columns: columns stay, empty tables stay empty."""
    docs = awkward(spark).selectExpr("*", "'own' n_units", "1 component_id", "2 host")
    none = spark.createDataFrame(
        [(None, " ".join(f"n{i}" for i in range(60)), None, None, None, None, "own", 1, 2)], docs.schema)
    docs = docs.union(none)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert {(r.n_units, r.component_id, r.host) for r in rows} <= {("own", 1, 2)}, name
        if name == "quality rules":
            key = lambda r: [(v is not None, v) for v in r]
            assert sorted(map(tuple, rows), key=key) == sorted(
                map(tuple, brute_rules(docs.collect())), key=key)
        else:  # a document without an id is a duplicate of none
            assert any(r.doc_id is None for r in rows), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    once = corpus_pipeline.near_duplicates(spark, docs, SF).where("doc_id is not null").collect()
    # 5 repeats 4, 8 (twice) is near 7, 10 near 9; those without words link with nothing
    assert sorted(r.doc_id for r in once) == [1, 2, 3, 4, 6, 7, 9, 11, 12, 13]
