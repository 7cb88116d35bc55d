"""Quality classifier by co-training of two views.

View one is the text's content (byte classes, byte pairs, word and line
statistics of the whole text), view two the page's metadata (source, language,
their combination, stated length by size class and by language, parts of a source
that is a URL). Each view has a logistic regression. In every round both score all
documents without a used label. A view is confident beyond the widest range of
calibration ranks, from either end, in which its labels err on at most
``MAX_ERROR`` of the documents and half as often as the class's share alone would;
(two standard deviations of the count are added to the errors); what it is confident
about becomes a pseudo-label for the other view. At the end
each view is calibrated on labelled documents that no fit has seen, and the
calibrated views are combined into one probability that a document is good.

Only the labelled sample is bounded: ``MAX_LABELLED`` documents, those with the
smallest hash of their doc_id. All confident documents teach: a Newton step needs a
gradient and a Hessian, which each task sums over its documents, ``MERGES`` tasks
add up, and the driver adds to those of the labelled sample. Pseudo-labels of
one class weigh together as much as the labelled documents of it at most, so they do
not drown them. Features are computed once for each document and kept in a shared
table; every round scores all of it, and so does the end.

Null text counts as empty, null metadata as a value of its own. Labels with a
null doc_id or value are not used; several labels of one document count as its
smallest. Without two labelled documents of each kind every document gets the
share of good labels (1.0 without labels) and is kept. Toxicity is no part of
this: only the quality label is read. Rows that repeat are scored each. Extra columns
are ignored by ``score`` and kept by ``keep_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import (
    Scratch,
    combine_hashes,
    lean,
    row_chunks,
    string_buffers,
    word_hashes,
    word_spans,
)

MAX_LABELLED = 20_000
ROUNDS = 2
STEPS = 10  # Newton steps over all confident documents; each round starts afresh
MERGES = 16  # tasks that add up the sums of all others
MAX_ERROR = 0.05
RANGES = [k / 20 for k in range(10, 0, -1)]  # shares of calibration ranks, widest first
KEEP = 0.5
PAIRS, SOURCES, LANGS, BOTH, SIZES = 64, 32, 16, 64, 16
TEXT_DIM = 12 + 8 + PAIRS
META_DIM = SOURCES + LANGS + BOTH + LANGS + SIZES + 6

_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[[ord(c) for c in "#$%&*|<>"]] = 6
_CLASS[ord("!")] = 7
_CLASS[[ord(c) for c in ".,;:?"]] = 8
_CLASS[[ord(c) for c in "'\"()-"]] = 9
_CLASS[128:] = 10


def text_features(column) -> np.ndarray:
    """One row of content features per text."""
    buf, offsets = string_buffers(column)
    out = np.zeros((len(offsets) - 1, TEXT_DIM), np.float32)
    for i, j in row_chunks(offsets):
        n = j - i
        off = offsets[i : j + 1] - offsets[i]
        part = buf[offsets[i] : offsets[j]]
        size = np.diff(off)
        row = np.repeat(np.arange(n, dtype=np.int32), size)
        per = np.maximum(size, 1)[:, None]
        classes = np.bincount(row * 12 + _CLASS[part], minlength=12 * n).reshape(n, 12)
        out[i:j, :12] = classes / per
        if len(part) > 1:
            pair = ((part[:-1].astype(np.int32) * 31 + part[1:]) * 2654435 >> 7) % PAIRS
            inside = row[1:] == row[:-1]
            counts = np.bincount((row[1:] * PAIRS + pair)[inside], minlength=PAIRS * n).reshape(n, PAIRS)
            out[i:j, 20:] = counts / per
        s, e, wrow = word_spans(part, off)
        words = np.bincount(wrow, minlength=n)
        h = word_hashes(part, s, e, lower=True)
        count = np.maximum(words, 1)
        distinct = np.bincount(wrow[_first_seen(wrow, h)], minlength=n)
        grams = combine_hashes([h[:-2], h[1:-1], h[2:]]) if len(h) > 2 else h[:0]
        inside = wrow[:-2] == wrow[2:] if len(h) > 2 else np.zeros(0, bool)
        grow, gh = (wrow[:-2][inside], grams[inside]) if len(h) > 2 else (wrow[:0], grams)
        again = np.bincount(grow[_first_seen(grow, gh)], minlength=n)
        out[i:j, 12] = np.log1p(words)
        out[i:j, 13] = np.bincount(wrow, weights=e - s, minlength=n) / count / 10
        out[i:j, 14] = distinct / count
        out[i:j, 15] = again / np.maximum(np.bincount(grow, minlength=n), 1)
        out[i:j, 16] = np.log1p(classes[:, 5])
        out[i:j, 17] = np.log1p(words / (classes[:, 5] + 1))
        out[i:j, 18] = words == 0
        out[i:j, 19] = words < 50
    return out


def _first_seen(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of one element of each distinct (row, hash)."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    first = np.ones(len(order), bool)
    first[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return order[first]


def meta_features(source, lang, n_chars) -> np.ndarray:
    """One row of metadata features per document."""
    n = len(source)
    out = np.zeros((n, META_DIM), np.float32)
    rows, hashes, at = np.arange(n), [], 0
    for col, dim in ((source, SOURCES), (lang, LANGS)):
        buf, off = string_buffers(pc.fill_null(col.cast(pa.large_string()), "\0"))
        hashes.append(word_hashes(buf, off[:-1], off[1:], lower=True))
        out[rows, at + (hashes[-1] % np.uint64(dim)).astype(np.int64)] = 1
        at += dim
    out[rows, at + (combine_hashes(hashes) % np.uint64(BOTH)).astype(np.int64)] = 1
    at += BOTH
    known = np.asarray(pc.is_valid(n_chars))
    chars = np.maximum(np.asarray(pc.fill_null(n_chars.cast(pa.int64()), 0)), 0)
    length = np.log1p(chars)
    out[rows, at + (hashes[1] % np.uint64(LANGS)).astype(np.int64)] = length / 10
    at += LANGS
    out[rows, at + np.minimum(length / np.log(2), SIZES - 1).astype(np.int64)] = 1
    at += SIZES
    src = pc.fill_null(source.cast(pa.large_string()), "")
    for k, x in enumerate((
            length / 10, ~known, chars < 300,
            pc.match_substring(src, "://"), pc.count_substring(src, "/"),
            pc.count_substring_regex(src, "[0-9]"))):
        out[:, at + k] = x if k < 4 else np.log1p(np.asarray(x))
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)

    def moments(self, x: np.ndarray, y, weight: float) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the weighted loss over the rows, without the ridge."""
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
        return weight * (z.T @ (p - y)), weight * ((z * (p * (1 - p))[:, None]).T @ z)

    def stepped(self, grad: np.ndarray, hess: np.ndarray, l2: float = 1.0) -> tuple[Logistic, float]:
        """The model after a Newton step of the ridge loss, and the step's largest part."""
        ridge = np.full(len(grad), l2)
        ridge[-1] = 1e-6
        step = np.linalg.solve(hess + np.diag(ridge + 1e-9), grad + ridge * self.weights)
        size = float(np.abs(step).max())
        return Logistic(self.mean, self.scale, self.weights - step * min(1.0, 10 / max(size, 1e-12))), size


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton steps."""
    x = x.astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    out = Logistic(mean, scale, np.zeros(x.shape[1] + 1))
    for _ in range(steps):
        out, size = out.stepped(*out.moments(x, y, 1.0), l2)
        if size < 1e-6:
            break
    return out


@dataclass
class Model:
    """Two views, their calibrations and the combination; ``share`` alone, which rejects nothing, without."""

    share: float
    text: Logistic | None = None
    meta: Logistic | None = None
    text_cal: Logistic | None = None
    meta_cal: Logistic | None = None
    both: Logistic | None = None

    def kept(self, score: np.ndarray, keep: float) -> np.ndarray:
        return (score >= keep) | (self.text is None)

    def scores(self, xt: np.ndarray, xm: np.ndarray):
        """(text, meta, combined) probabilities of being good."""
        if self.text is None:
            p = np.full(len(xt), self.share)
            return p, p, p
        a, b = self.text.logit(xt), self.meta.logit(xm)
        ca, cb = self.text_cal.logit(a[:, None]), self.meta_cal.logit(b[:, None])
        c = self.both.logit(np.column_stack([ca, cb]))
        return tuple(1 / (1 + np.exp(-v)) for v in (ca, cb, c))


def calibrate(text, meta, xt, xm, y, share) -> Model:
    a, b = text.logit(xt)[:, None], meta.logit(xm)[:, None]
    ta, tb = fit_logistic(a, y, 1e-2), fit_logistic(b, y, 1e-2)
    both = fit_logistic(np.column_stack([ta.logit(a), tb.logit(b)]), y, 1e-2)
    return Model(share, text, meta, ta, tb, both)


def _blobs(x: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(x, "<f4")
    return pa.array([r.tobytes() for r in data], pa.binary())


def _matrix(blobs, dim: int) -> np.ndarray:
    data = b"".join(blobs)
    return np.frombuffer(data, "<f4").reshape(-1, dim)


ROWS = 1_000  # documents a task takes at a time


def _featurise(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), _blobs(text_features(batch.column("text"))),
             _blobs(meta_features(*(batch.column(c) for c in ("source", "lang", "n_chars"))))],
            names=["doc_id", "xt", "xm"])


def _score_features(model: Model):
    def run(batches):
        for batch in batches:
            p = model.scores(_matrix(batch.column("xt").to_pylist(), TEXT_DIM),
                             _matrix(batch.column("xm").to_pylist(), META_DIM))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v, pa.float64()) for v in p]],
                names=["doc_id", "text_score", "meta_score", "score"])

    return run


def confident_levels(p: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(at most, at least): scores at which a view is confident of a bad and of a good document."""
    order, n = np.argsort(p, kind="stable"), len(p)
    out = []
    for good, ranks in ((0, order), (1, order[::-1])):
        most = min(MAX_ERROR, np.mean(y != good) / 2)
        level = -np.inf if good == 0 else np.inf  # confident of none
        for share in RANGES:
            mine = ranks[: int(n * share)]
            wrong = np.sum(y[mine] != good)
            # two standard deviations above what was counted: a few ranks do not prove much
            if len(mine) and wrong + 2 * np.sqrt(wrong + 1) <= most * len(mine):
                level = p[mine[-1]]
                break
        out.append(float(level))
    return out[0], out[1]


def _lessons(model: Model, levels: list, students: list, weigh: list | None):
    """Feature rows -> one row of sums per task: for each view the rows the other is confident about.

    The sums of a view are (number of bad, of good, gradient, Hessian) of its student.
    """
    def run(batches):
        sums = [np.zeros(2 + (k := len(s.weights)) + k * k) for s in students]
        for batch in batches:
            x = [_matrix(batch.column(c).to_pylist(), d) for c, d in (("xt", TEXT_DIM), ("xm", META_DIM))]
            scores = model.scores(*x)
            for view, student in enumerate(students):
                p, (low, high) = scores[1 - view], levels[1 - view]
                for good, sure in ((0, p <= low), (1, p >= high)):
                    sums[view][good] += sure.sum()
                    if weigh is not None and sure.any():
                        g, h = student.moments(x[view][sure], float(good), weigh[view][good])
                        sums[view][2:] += np.concatenate([g, h.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([s.tobytes()], pa.binary()) for s in sums], names=["v0", "v1"])

    return run


def _add_up(batches):
    total: list = [0, 0]
    for batch in batches:
        for v in (0, 1):
            for data in batch.column(f"v{v}"):
                total[v] = total[v] + np.frombuffer(data.as_py(), np.float64)
    if not np.isscalar(total[0]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([t.tobytes()], pa.binary()) for t in total], names=["v0", "v1"])


def _summed(feats: DataFrame, lessons) -> list[np.ndarray]:
    """The sums of all documents, added up by ``MERGES`` tasks before they come to the driver."""
    each = feats.mapInArrow(lean(lessons, ROWS), "v0 binary, v1 binary")
    some = each.repartition(MERGES).mapInArrow(_add_up, "v0 binary, v1 binary").collect()
    return [np.sum([np.frombuffer(r[f"v{v}"], np.float64) for r in some], axis=0) for v in (0, 1)]


def teach(feats: DataFrame, model: Model, levels: list, own: list) -> list[Logistic]:
    """Both views' fits to the labelled sample and all that the other view is confident about."""
    students = [model.text, model.meta]
    counts = _summed(feats, _lessons(model, levels, students, None))
    # pseudo-labels of a class weigh together no more than its labelled documents
    weigh = [[min(1.0, float((y == good).sum()) / max(c[good], 1.0)) for good in (0, 1)]
             for c, (_, y) in zip(counts, own)]
    if not any(c[:2].any() for c in counts):
        return students
    students = [Logistic(s.mean, s.scale, np.zeros(len(s.weights))) for s in students]
    for _ in range(STEPS):
        sums = _summed(feats, _lessons(model, levels, students, weigh))
        moved = 0.0
        for view, (x, y) in enumerate(own):
            k = len(students[view].weights)
            g, h = students[view].moments(x, y, 1.0)
            students[view], step = students[view].stepped(
                g + sums[view][2 : 2 + k], h + sums[view][2 + k :].reshape(k, k))
            moved = max(moved, step)
        if moved < 1e-3:
            break
    return students


def _columns(docs: DataFrame) -> DataFrame:
    """doc_id, text, source, lang, n_chars; a missing metadata column is null."""
    have = set(docs.columns)
    kinds = {"doc_id": "long", "text": "string", "source": "string", "lang": "string",
             "n_chars": "long"}
    return docs.select(*[
        (F.col(c).cast(k) if c in have else F.lit(None).cast(k)).alias(c)
        for c, k in kinds.items()])


def features(docs: DataFrame) -> DataFrame:
    return _columns(docs).mapInArrow(lean(_featurise, ROWS), "doc_id long, xt binary, xm binary")


def _calibration_fold(y: np.ndarray) -> np.ndarray:
    """The fourth of the labelled documents only for calibration; of a class with two or more, one at least."""
    fold = np.arange(len(y)) % 4 == 3
    for good in (0, 1):
        mine = np.flatnonzero(y == good)
        if len(mine) > 1 and len({*fold[mine]}) < 2:
            fold[mine] = np.arange(len(mine)) % 4 == min(3, len(mine) - 1)
    return fold


def train(feats: DataFrame, labels: DataFrame, rounds: int = ROUNDS,
          max_labelled: int = MAX_LABELLED) -> Model:
    """Co-train on ``feats`` (doc_id, xt, xm) and ``labels`` (doc_id, quality)."""
    sample = (labels.where("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # at most max_labelled ids: a bounded broadcast
    got = feats.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(max_labelled).collect()
    y = np.array([r["quality"] > 0 for r in got], np.float64)
    share = float(y.mean()) if len(y) else 1.0
    fold = _calibration_fold(y)
    if len({*y[fold]}) < 2 or len({*y[~fold]}) < 2:
        return Model(share)
    xt = _matrix((r["xt"] for r in got), TEXT_DIM)
    xm = _matrix((r["xm"] for r in got), META_DIM)
    cal = (xt[fold], xm[fold], y[fold], share)
    own = [(xt[~fold], y[~fold]), (xm[~fold], y[~fold])]
    model = calibrate(fit_logistic(*own[0]), fit_logistic(*own[1]), *cal)
    unused = feats.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti")
    for _ in range(rounds):
        levels = [confident_levels(p, y[fold]) for p in model.scores(xt[fold], xm[fold])[:2]]
        model = calibrate(*teach(unused, model, levels, own), *cal)
    return model


def score(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **kw) -> DataFrame:
    """doc_id, text_score, meta_score, score and kept for every document."""
    sc = Scratch(docs.sparkSession, "cotrain")
    feats = sc.write(features(docs), "features")
    model = train(feats, labels, **kw)
    out = feats.mapInArrow(
        lean(_score_features(model), ROWS), "doc_id long, text_score double, meta_score double, score double")
    kept = F.lit(True) if model.text is None else F.col("score") >= keep
    return sc.finish(out.withColumn("kept", kept))


def _keep(model: Model, keep: float):
    def run(batches):
        for batch in batches:
            p = model.scores(
                text_features(batch.column("_x_text")),
                meta_features(*(batch.column(f"_x_{c}") for c in ("source", "lang", "n_chars"))))
            t = pa.Table.from_batches([batch]).filter(pa.array(model.kept(p[2], keep)))
            n = len([c for c in batch.schema.names if c.startswith("_x_")])
            yield from t.select(range(batch.num_columns - n)).to_batches()

    return run


def keep_documents(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **kw) -> DataFrame:
    """The documents scored at least ``keep``; columns as given."""
    sc = Scratch(docs.sparkSession, "cotrain")
    feats = sc.write(features(docs), "features")
    model = train(feats, labels, **kw)
    sc.drop()
    have = set(docs.columns)
    wide = docs.select(*docs.columns, *[
        (F.col(c).cast(k) if c in have else F.lit(None).cast(k)).alias(f"_x_{c}")
        for c, k in (("text", "string"), ("source", "string"), ("lang", "string"),
                     ("n_chars", "long"))])
    return wide.mapInArrow(lean(_keep(model, keep), ROWS), docs.schema)
