"""N-gram Jaccard join by PartEnum signatures.

Two documents link when the Jaccard similarity of their word n-gram sets is
at least ``num / den``. Equivalently their symmetric difference has at most
``(|a| + |b|) (den - num) / (den + num)`` elements. Sizes are cut into bands
so that similar sets lie in the same or in adjacent bands; a set of band i
takes part in the instances i and i + 1. An instance with difference bound k
hashes the feature domain into ``n1`` partitions, so that one of them holds
at most ``k2`` differences, and each of these into ``n2`` parts; dropping
every choice of ``k2`` parts, some remaining subset is equal in both sets.
The hash of each (instance, partition, subset) is a signature, so every
similar pair shares at least one. Subsets that hold no element are signed only
by sets so sparse that they need them.

How the pairs of a signature are resolved without listing them:

1. Equal sets are one class. A task signs a set only once, and signatures
   carry the class, so copies never meet as pairs.
2. Each signature shared by two or more classes names its smallest class as
   leader. Distinct (leader, member) pairs are verified exactly and the links
   joined into components.
3. Signatures whose members still lie in several components go on without
   their leader: a task compares the members of different components by a
   parity sketch (its bit distance never exceeds the true difference, so
   nothing similar is skipped), verifies what passes exactly, and returns
   only links that join components. Members of a large signature are split
   into blocks and the block pairs are dealt out over tasks.

Sets are not shuffled with pairs: the candidate classes' sets are written to
files in the shared folder and read by offset where a pair is verified.

Null or word-free texts have no set and link with nothing; a row with a null
doc_id gets a null component. Rows that repeat a doc_id are all considered;
they share the component of that doc_id. Extra columns are ignored.
Classes are named by 64-bit digests of their sets.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations
from math import comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import (
    Scratch,
    attempt_name,
    combine_hashes,
    connected_components,
    lean,
    mix64,
    open_fs,
    partitions_for,
    row_chunks,
    string_buffers,
    word_hashes,
    word_spans,
)

SKETCH_WORDS = 16  # 64-bit words of the parity sketch
SIGNED_ROWS = 1 << 17  # signatures given out at a time
BLOCK = 2048  # members of one signature compared in one unit


def bands(num: int, den: int, size: int) -> list[tuple[int, int]]:
    """Size bands (low, high) up to the one that holds ``size``."""
    out, low = [], 1
    while low <= size:
        out.append((low, low * den // num))
        low = out[-1][1] + 1
    return out


def instance(num: int, den: int, low: int, high: int) -> tuple[int, int, int, int]:
    """(k, n1, n2, k2) of the instance for sets of ``low`` to ``high`` elements.

    Of an instance's subsets at least ``2 n1 - k`` are equal in two similar sets. So many
    partitions are taken that a set seldom has as many empty subsets, which then carry no
    signature (``signatures``).
    """
    k = 2 * high * (den - num) // (den + num)
    if k == 0:
        return 0, 1, 1, 0
    # few differences: larger subsets, which select better; many: pairs of parts
    n2, k2 = (3, 1) if k < 12 else (2, 1)
    n1 = -(-(k + 1) // (k2 + 1))
    while n1 < 2 * (k + 1):
        subsets = n1 * comb(n2, k2)
        empty = subsets * exp(-(n2 - k2) * low / (n1 * n2))
        if 2 * n1 - k > empty + 3 * sqrt(empty):
            break
        n1 += 1
    return k, n1, n2, k2


@lru_cache(maxsize=65536)
def _plan(num: int, den: int, size: int) -> list[tuple[int, int, int, int, int]]:
    """Instances of a set of ``size``: (band, k, n1, n2, k2), equal-only ones left out."""
    b = bands(num, den, size)
    i = len(b) - 1
    after = b[-1][1] + 1
    out = []
    for j, low, high in ((i, b[max(0, i - 1)][0], b[-1][1]), (i + 1, b[-1][0], after * den // num)):
        k, n1, n2, k2 = instance(num, den, low, high)
        if k:
            out.append((j, k, n1, n2, k2))
    return out


def signatures(elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """PartEnum signatures (uint64) of a sorted array of distinct element hashes.

    Empty subsets are alike in sets that have nothing in common. A set with fewer of them
    than the subsets equal in any similar set shares one that is not empty with each, and
    leaves them out; a set with more signs them too.
    """
    out = []
    for band, k, n1, n2, k2 in _plan(num, den, len(elements)):
        part = (mix64(elements + np.uint64(0x51ED27)) % np.uint64(n1 * n2)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(elements[order]))])
        ends = np.cumsum(np.bincount(part, minlength=n1 * n2))
        starts = ends - np.diff(ends, prepend=0)
        part_sum = (sums[ends] - sums[starts]).reshape(n1, n2)
        filled = (ends > starts).reshape(n1, n2)
        found, some = [], []
        for c, keep in enumerate(combinations(range(n2), n2 - k2)):
            tag = (np.arange(n1, dtype=np.uint64) * np.uint64(64) + np.uint64(c)) \
                * np.uint64(1 << 20) + np.uint64(band)
            total = part_sum[:, keep[0]].copy()
            for p in keep[1:]:
                total += part_sum[:, p]
            found.append(mix64(mix64(tag) + total))
            some.append(filled[:, keep].any(axis=1))
        sigs, some = np.concatenate(found), np.concatenate(some)
        out.append(sigs[some] if np.count_nonzero(~some) < 2 * n1 - k else sigs)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit j is the parity of the elements hashed to j."""
    bits = 64 * SKETCH_WORDS
    bucket = (mix64(elements + np.uint64(0xA11CE)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def set_digest(elements: np.ndarray) -> int:
    return int.from_bytes(
        hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_sets(column, width: int):
    """(row, sorted distinct n-gram hashes) of every row of a text column."""
    buf, offsets = string_buffers(column)
    for i, j in row_chunks(offsets):
        off = offsets[i : j + 1] - offsets[i]
        part = buf[offsets[i] : offsets[j]]
        s, e, row = word_spans(part, off)
        words = word_hashes(part, s, e, lower=True)
        first = np.searchsorted(row, np.arange(j - i + 1))
        grams = combine_hashes([words[w : len(words) - width + 1 + w] for w in range(width)]) \
            if len(words) >= width else np.zeros(0, np.uint64)
        for r in range(j - i):
            a, b = first[r], first[r + 1]
            if b - a >= width:
                yield i + r, np.unique(grams[a : b - width + 1])
            elif b > a:
                h = combine_hashes([words[w : w + 1] for w in range(a, b)])
                yield i + r, mix64(h + np.uint64(b - a))
            else:
                yield i + r, np.zeros(0, np.uint64)


def jaccard_at_least(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return den * inter >= num * (len(a) + len(b) - inter)


_SIGNED = "doc_id long, n_shingles long, cls long, sketch binary"


def _sign(width: int):
    """Size and class of each row's set, with a sketch of those a task sees first."""
    def run(batches):
        seen: set[int] = set()  # classes this task has given a sketch
        for batch in batches:
            ids, ns, cls, sk = batch.column("doc_id").to_pylist(), [], [], []
            for r, u in shingle_sets(batch.column("text"), width):
                ns.append(len(u))
                c = set_digest(u) if len(u) else None
                cls.append(c)
                if c is None or ids[r] is None or c in seen:
                    sk.append(None)
                else:
                    seen.add(c)
                    sk.append(sketch(u).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(sk, pa.binary())], names=["doc_id", "n_shingles", "cls", "sketch"])

    return run


def _signature_rows(num: int, den: int, width: int):
    """Rows (sig, cls) of the sets; a task signs a class once. They go straight to the exchange."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            sigs, cls, n = [], [], 0
            for _, u in shingle_sets(batch.column("text"), width):
                c = set_digest(u) if len(u) else None
                if c is None or c in seen:
                    continue
                seen.add(c)
                sigs.append(signatures(u, num, den).view(np.int64))
                cls.append(np.full(len(sigs[-1]), c, np.int64))
                n += len(sigs[-1])
                if n >= SIGNED_ROWS:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x), pa.int64()) for x in (sigs, cls)],
                        names=["sig", "cls"])
                    sigs, cls, n = [], [], 0
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (sigs, cls)],
                    names=["sig", "cls"])

    return run


def _shared_signatures(batches):
    """Rows (sig, cls) sorted by both -> rows of signatures with two or more classes."""
    held = leader = None  # first row of the signature at hand, not yet given out; its class
    last_sig = last_cls = None
    for batch in batches:
        sig = batch.column("sig").to_numpy()
        cls = batch.column("cls").to_numpy()
        out_s, out_c, out_l = [], [], []
        if len(sig) == 0:
            continue
        new_sig = np.empty(len(sig), bool)
        new_sig[0] = last_sig is None or sig[0] != last_sig
        new_sig[1:] = sig[1:] != sig[:-1]
        new_row = new_sig.copy()
        new_row[0] |= last_cls is None or cls[0] != last_cls
        new_row[1:] |= cls[1:] != cls[:-1]
        pick = np.flatnonzero(new_row)
        # a row matters when its signature has another distinct row
        follows = ~new_sig[pick]
        ahead = np.append(follows[1:], False)
        keep = pick[follows | ahead | (np.arange(len(pick)) == len(pick) - 1)]
        for k in keep:
            s, c = int(sig[k]), int(cls[k])
            if new_sig[k]:
                held, leader = (s, c), c
                continue
            if held is not None:
                out_s.append(held[0])
                out_c.append(held[1])
                out_l.append(leader)
                held = None
            out_s.append(s)
            out_c.append(c)
            out_l.append(leader)
        last_sig, last_cls = sig[-1], cls[-1]
        if out_s:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (out_s, out_c, out_l)],
                names=["sig", "cls", "leader"])


def _store_sets(root: str, width: int):
    """Write the wanted classes' sets to one file per task; give out where each lies."""

    def run(batches):
        fs, base = open_fs(root)
        fs.create_dir(base, recursive=True)
        name, sink, at, seen = attempt_name("sets", ".bin"), None, 0, set()
        rows = []
        for batch in batches:
            want = batch.column("want").to_pylist()
            for r, u in shingle_sets(batch.column("text"), width):
                c = set_digest(u) if len(u) else None
                if c is None or c != want[r] or c in seen:
                    continue
                seen.add(c)
                sink = sink or fs.open_output_stream(f"{base}/{name}")
                sink.write(u.tobytes())
                rows.append((c, name, at, len(u)))
                at += 8 * len(u)
        if sink is not None:
            sink.close()
        for i in range(0, len(rows), 10000):
            c, f, o, n = zip(*rows[i : i + 10000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()), pa.array(f, pa.string()), pa.array(o, pa.int64()),
                 pa.array(n, pa.int64())], names=["cls", "file", "at", "size"])

    return run


class SetReader:
    """Sets of the shared files by (file, offset, size), with a bounded cache."""

    def __init__(self, root: str, cache_bytes: int = 16 << 20):
        self.fs, self.base = open_fs(root)
        self.files: dict = {}
        self.cache: dict = {}
        self.left = self.limit = cache_bytes

    def get(self, file: str, at: int, size: int) -> np.ndarray:
        key = (file, at)
        u = self.cache.get(key)
        if u is None:
            if file not in self.files:
                if len(self.files) >= 64:
                    self.files.pop(next(iter(self.files))).close()
                self.files[file] = self.fs.open_input_file(f"{self.base}/{file}")
            u = np.frombuffer(self.files[file].read_at(8 * size, at), np.uint64)
            while self.cache and self.left < u.nbytes:
                self.left += self.cache.pop(next(iter(self.cache))).nbytes
            self.cache[key] = u
            self.left -= u.nbytes
        return u


def _verify(root: str, num: int, den: int):
    def run(batches):
        reader = SetReader(root)
        for batch in batches:
            r = batch.to_pydict()
            a_out, b_out = [], []
            for i in range(batch.num_rows):
                # sizes alone decide most pairs that cannot link
                x, y = sorted((r["size_a"][i], r["size_b"][i]))
                if den * x < num * y:
                    continue
                if jaccard_at_least(reader.get(r["file_a"][i], r["at_a"][i], r["size_a"][i]),
                                    reader.get(r["file_b"][i], r["at_b"][i], r["size_b"][i]),
                                    num, den):
                    a_out.append(r["rep_a"][i])
                    b_out.append(r["rep_b"][i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return run


def _find(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def link_unit(rows: dict, cross: bool, get, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join components among the members of one unit.

    ``rows``: equally long lists rep, component, size, sketch, side; with
    ``cross`` only members of different sides are compared.
    """
    size = np.array(rows["size"], np.int64)
    sk = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(size), -1)
    order = np.argsort(size, kind="stable")
    comp, side = rows["component"], rows["side"]
    parent = {c: c for c in comp}
    codes = np.unique(np.array(comp, np.int64), return_inverse=True)[1]
    sides = np.array(side, np.int64)
    links = []
    for p, i in enumerate(order[:-1]):
        others = order[p + 1 :]  # not smaller than i
        # largest partner that still can be similar
        others = others[: np.searchsorted(size[others], size[i] * den // num, side="right")]
        others = others[codes[others] != codes[i]]
        if cross:
            others = others[sides[others] != sides[i]]
        if not len(others):
            continue
        apart = np.bitwise_count(sk[others] ^ sk[i]).sum(axis=1, dtype=np.int64)
        near = apart * (den + num) <= (size[others] + size[i]) * (den - num)
        for j in others[near]:
            x, y = _find(parent, comp[i]), _find(parent, comp[j])
            if x != y and jaccard_at_least(get(i), get(j), num, den):
                parent[max(x, y)] = min(x, y)
                links.append((rows["rep"][i], rows["rep"][j]))
                codes[codes == codes[j]] = codes[i]  # one component from here on
    return links


def _link_rest(root: str, num: int, den: int):
    """Rows sorted by unit -> links between components, unit by unit."""
    cols = ["sig", "lo", "hi", "rep", "component", "size", "sketch", "side", "file", "at"]

    def run(batches):
        reader = SetReader(root)
        unit, rows = None, {c: [] for c in cols}

        def flush():
            if len(rows["rep"]) < 2:
                return []
            get = lambda i: reader.get(rows["file"][i], rows["at"][i], rows["size"][i])
            return link_unit(rows, unit[1] != unit[2], get, num, den)

        for batch in batches:
            d = batch.to_pydict()
            links = []
            for i in range(batch.num_rows):
                key = (d["sig"][i], d["lo"][i], d["hi"][i])
                if key != unit:
                    links += flush()
                    unit, rows = key, {c: [] for c in cols}
                for c in cols:
                    rows[c].append(d[c][i])
            if links:
                yield _pairs(links)
        if last := flush():
            yield _pairs(last)

    return run


def _pairs(links):
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def jaccard_components(docs: DataFrame, num: int = 90, den: int = 100, width: int = 3,
                       block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    sc = Scratch(spark, "partenum")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = sc.write(texts.mapInArrow(lean(_sign(width)), _SIGNED), "signed")
    has_set = signed.where("cls is not null and doc_id is not null")
    # the class of equal sets is named by its smallest document
    classes = sc.write(
        has_set.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("sketch").alias("sketch")),
        "classes")

    # signatures are made on the way into the exchange and are written nowhere else
    sig_rows = texts.where("doc_id is not null").mapInArrow(
        lean(_signature_rows(num, den, width)), "sig long, cls long")
    shared = sc.write(
        sig_rows.repartition(partitions_for(spark), "sig").sortWithinPartitions("sig", "cls")
        .mapInArrow(_shared_signatures, "sig long, cls long, leader long"), "shared")

    wanted = classes.join(shared.select("cls").distinct(), "cls", "left_semi").select(
        F.col("rep").alias("doc_id"), F.col("cls").alias("want"))
    root = sc.uri("sets")
    places = sc.write(
        texts.join(wanted, "doc_id").select("text", "want")
        .mapInArrow(lean(_store_sets(root, width)), "cls long, file string, at long, size long")
        .dropDuplicates(["cls"]).join(classes, "cls"), "places")

    def side(tag: str, key: str) -> DataFrame:
        return places.select(F.col("cls").alias(key), *[
            F.col(c).alias(f"{c}_{tag}") for c in ("rep", "file", "at", "size")])

    stars = shared.where("cls <> leader").select("leader", "cls").distinct()
    links = sc.write(
        stars.join(side("a", "leader"), "leader").join(side("b", "cls"), "cls")
        .drop("leader", "cls").mapInArrow(_verify(root, num, den), "a long, b long"), "links")
    comp = connected_components(links, sc, "first")

    # signatures whose members still lie in several components, without their leaders
    label = places.join(comp, F.col("rep") == F.col("node"), "left").select(
        "cls", "rep", "file", "at", "size", "sketch",
        F.coalesce("component", "rep").alias("component"))
    member = shared.join(label.select("cls", "component"), "cls")
    open_sigs = (member.groupBy("sig").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"),
        F.count(F.lit(1)).alias("_n"))
        .where("_lo <> _hi and _n > 2")
        .select("sig", F.ceil((F.col("_n") - 1) / F.lit(block)).cast("int").alias("_blocks")))
    rest = (shared.where("cls <> leader").join(open_sigs, "sig").join(label, "cls")
            .withColumn("side", F.pmod(F.xxhash64("cls"), F.col("_blocks")).cast("long")))
    units = rest.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "sig", F.least("side", "_j").cast("long").alias("lo"),
        F.greatest("side", "_j").cast("long").alias("hi"),
        "rep", "component", "size", "sketch", "side", "file", "at")
    more = sc.write(
        units.repartitionByRange(partitions_for(spark), "sig", "lo", "hi")
        .sortWithinPartitions("sig", "lo", "hi", "rep")
        .mapInArrow(lean(_link_rest(root, num, den)), "a long, b long"), "more")
    if not more.isEmpty():
        comp = connected_components(links.union(more), sc, "last")

    by_class = classes.join(comp, F.col("rep") == F.col("node"), "left").select(
        "cls", F.coalesce("component", "rep").alias("_c"))
    of_row = signed.select("doc_id", "n_shingles", "cls").join(by_class, "cls", "left")
    out = of_row.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")).alias("component_id"))
    return sc.finish(out)
