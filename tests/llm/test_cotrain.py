"""Co-training against a plain model of its own, over the whole small table."""

import re

import numpy as np
import pyarrow as pa

from clickvault.llm import cotrain
from test_brute import SF


def plain_fit(x, y, weight, l2, start, mean, scale, steps, stop):
    """Ridge logistic regression, one row of weights for each class and row."""
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], l2), 1e-6)
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = (z * (weight * (p - y))[:, None]).sum(0) + ridge * w
        hess = np.einsum("ni,n,nj->ij", z, weight * p * (1 - p), z) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1, 10 / max(abs(step).max(), 1e-12))
        if abs(step).max() < stop:
            break
    return w


def own_scale(x):
    scale = x.std(0)
    return x.mean(0), np.where(scale > 1e-9, scale, 1.0)


def logit(x, fit):
    mean, scale, w = fit
    return np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)


def fresh(x, y, l2=1.0):
    mean, scale = own_scale(x)
    return mean, scale, plain_fit(x, y, np.ones(len(x)), l2, np.zeros(x.shape[1] + 1), mean, scale, 25, 1e-6)


def sigmoid(v):
    return 1 / (1 + np.exp(-v))


def plain_scores(views, cal, xs):
    cs = [logit(logit(x, v)[:, None], c) for x, v, c in zip(xs, views, cal[:2])]
    return [sigmoid(c) for c in cs] + [sigmoid(logit(np.column_stack(cs), cal[2]))]


def plain_calibration(views, xs, y):
    firsts = [fresh(logit(x, v)[:, None], y, 1e-2) for x, v in zip(xs, views)]
    cs = [logit(logit(x, v)[:, None], c) for x, v, c in zip(xs, views, firsts)]
    return [*firsts, fresh(np.column_stack(cs), y, 1e-2)]


def plain_levels(p, y):
    out = []
    for good in (0, 1):
        ranked = sorted(range(len(p)), key=lambda i: p[i] if good == 0 else (-p[i], -i))
        level = float("inf") if good else float("-inf")
        for share in [k / 20 for k in range(10, 0, -1)]:
            top = ranked[: int(len(p) * share)]
            wrong = sum(y[i] != good for i in top)
            if top and wrong + 2 * (wrong + 1) ** 0.5 <= len(top) * min(0.05, sum(y != good) / len(y) / 2):
                level = p[top[-1]]
                break
        out.append(level)
    return out


def test_scores_equal_plain_model(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in cotrain.score(docs, labels).collect()}
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars").toPandas()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    col = lambda c: table.column(c).combine_chunks()
    xs = [cotrain.text_features(col("text")).astype(float),
          cotrain.meta_features(col("source"), col("lang"), col("n_chars")).astype(float)]
    given = {r.doc_id: r.quality for r in labels.collect()}
    order = [r.doc_id for r in docs.selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").collect()]
    place = {d: i for i, d in enumerate(rows.doc_id)}
    known = [place[d] for d in order if d in given]
    y = np.array([given[rows.doc_id[i]] > 0 for i in known], float)
    fold = np.arange(len(y)) % 4 == 3
    assert len(set(y[fold])) == len(set(y[~fold])) == 2
    fit, cal = [np.array(known)[~fold]] * 2, np.array(known)[fold]
    views = [fresh(x[i], y[~fold]) for x, i in zip(xs, fit)]
    cals = plain_calibration(views, [x[cal] for x in xs], y[fold])
    rest = np.array(sorted(set(range(len(rows))) - set(known)))
    taught = 0
    for _ in range(2):
        p = plain_scores(views, cals, [x[rest] for x in xs])
        levels = [plain_levels(s, y[fold]) for s in plain_scores(views, cals, [x[cal] for x in xs])[:2]]
        new = []
        for v in (0, 1):
            low, high = levels[1 - v]
            bad, good = rest[p[1 - v] <= low], rest[p[1 - v] >= high]
            taught += len(bad) + len(good)
            x = np.concatenate([xs[v][fit[v]], xs[v][bad], xs[v][good]])
            t = np.concatenate([y[~fold], np.zeros(len(bad)), np.ones(len(good))])
            weight = np.concatenate([np.ones(len(fit[v]))] + [
                np.full(len(m), min(1, (y[~fold] == c).sum() / max(len(m), 1))) for c, m in ((0, bad), (1, good))])
            mean, scale, w = views[v]
            new.append((mean, scale, plain_fit(x, t, weight, 1.0, 0 * w, mean, scale, cotrain.STEPS, 1e-3)))
        views = new
        cals = plain_calibration(views, [x[cal] for x in xs], y[fold])
    assert taught > len(rest) / 10  # the exchange is real, and grows with the documents
    want = plain_scores(views, cals, xs)
    for i, d in enumerate(rows.doc_id):
        r = got[d]
        assert abs(r.text_score - want[0][i]) < 1e-3 and abs(r.score - want[2][i]) < 1e-3, d
        assert r.kept == (want[2][i] >= 0.5) or abs(want[2][i] - 0.5) < 1e-3


def test_text_features_by_hand():
    texts = ["The cat; the Cat!\n\nThe cat 9 #", "", None, "é " * 70, "x"]
    got = cotrain.text_features(pa.array(texts))
    for t, f in zip(texts, got):
        data = (t or "").encode()
        words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data.lower()) if w]
        lines = data.count(b"\n")
        grams = list(zip(words, words[1:], words[2:]))
        hand = [np.log1p(len(words)), sum(map(len, words)) / max(len(words), 1) / 10,
                len(set(words)) / max(len(words), 1), len(set(grams)) / max(len(grams), 1),
                np.log1p(lines), np.log1p(len(words) / (lines + 1)), not words, len(words) < 50]
        assert np.allclose(f[12:20], np.array(hand, float), atol=1e-5), t
        assert np.isclose(f[2], sum(65 <= b <= 90 for b in data) / max(len(data), 1))
        assert np.isclose(f[10], sum(b > 127 for b in data) / max(len(data), 1))
        assert np.isclose(f[20:].sum(), max(len(data) - 1, 0) / max(len(data), 1), atol=1e-4)


def test_levels():
    p = np.linspace(0, 1, 1000)
    y = (p > 0.3).astype(float)
    low, high = cotrain.confident_levels(p, y)
    assert 0.28 < low <= 0.32 and 0.49 < high <= 0.51
    # a view without knowledge is confident of nothing
    y = np.arange(1000) % 2
    assert cotrain.confident_levels(p, y) == (-np.inf, np.inf)


def test_awkward_metadata():
    f = cotrain.meta_features(pa.array([None, "https://h.example/a/b1", "s"]), pa.array(["en", None, ""]),
                              pa.array([None, -5, 10**12]))
    assert f.shape == (3, cotrain.META_DIM) and np.isfinite(f).all()
    assert len({*map(bytes, f)}) == 3
