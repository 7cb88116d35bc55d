"""Token ids in wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents (ascending doc_id) as a wavelet
matrix: one bit plane per id bit, highest first, each plane in the order left
by a stable partition of the plane before. A plane is cut into blocks, and the
ones before each block are stored, so every operation is a walk of one step per
plane that looks at one block (two for a range):

* ``access(i)``: the token at i; ``tokens()``: all of them;
* ``rank(token, i)``: how often it occurs before i; ``count(token)``;
* ``select(token, k)``: the place of its k-th occurrence; ``positions(token)``.

File: magic, header length, JSON header, then document ids, document starts, ones
before each block and block lengths (zstd each), then the blocks (zstd each).
``ShardFile`` opens one by its directory alone and reads the blocks that a walk
asks for; ``count_tokens``, ``find_tokens`` and ``tokens_at`` do so over all shards
of a manifest. Tasks write their shards under names of their own; the manifest,
materialised once, names those that count.

Null text is an empty document, which still has its end id. Rows with a null
doc_id come first; rows that repeat a doc_id are documents of their own, in
the order of the first 64 characters of their texts, then of a hash of the text. Rows of
one id are dealt out to several tasks. Extra columns are ignored. No documents: no shards.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch, attempt_name, open_fs, partitions_for
from clickvault.llm.tokens import encode_rows, gathered

MAGIC = b"WVM2"
SHARD_TOKENS = 1 << 21
BLOCK = 1 << 16  # bits of a plane in one block
BLOCK_WORDS = BLOCK // 64
CACHED_BLOCKS = 256  # blocks that an open shard file keeps
NO_ID = -(1 << 63)  # a null doc_id in a file


class WaveletMatrix:
    """Bit planes of an integer sequence with rank and select."""

    def __init__(self, n: int, bits: int, zeros: list[int], ones: np.ndarray,
                 planes: list[np.ndarray] | None = None):
        # ones: by plane, the ones before each block, and at the end those of the plane
        self.n, self.bits, self.zeros, self.ones, self.planes = n, bits, zeros, ones, planes

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        cur = values.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(bits):
            mask = cur.dtype.type(1 << (bits - 1 - level))
            lows, highs, words = [], [], []
            # a block at a time stays in the processor's cache
            for at in range(0, len(cur), BLOCK):
                part = cur[at : at + BLOCK]
                one = (part & mask) != 0
                words.append(np.packbits(one, bitorder="little"))
                highs.append(part.take(np.flatnonzero(one)))
                lows.append(part.take(np.flatnonzero(~one)))
            packed = np.concatenate(words) if words else np.zeros(0, np.uint8)
            planes.append(np.pad(packed, (0, -len(packed) % 8)).view(np.uint64))
            zeros.append(sum(map(len, lows)))
            cur = np.concatenate([*lows, *highs]) if words else cur
        ones = [np.concatenate([[0], np.cumsum(np.add.reduceat(
            np.bitwise_count(p).astype(np.int64), np.arange(0, len(p), BLOCK_WORDS)))])
            if len(p) else np.zeros(1, np.int64) for p in planes]
        return cls(len(values), bits, zeros, np.array(ones, np.int64).reshape(bits, -1), planes)

    def _words(self, level: int, block: int) -> np.ndarray:
        return self.planes[level][block * BLOCK_WORDS : (block + 1) * BLOCK_WORDS]

    def _marks(self, level: int, block: int) -> np.ndarray:
        """The bits of a block, as booleans."""
        n = min(BLOCK, self.n - block * BLOCK)
        return np.unpackbits(self._words(level, block).view(np.uint8), count=n,
                             bitorder="little").view(bool)

    def _bit(self, level: int, i: int) -> int:
        block, at = divmod(i, BLOCK)
        return int(self._words(level, block)[at >> 6]) >> (at & 63) & 1

    def _rank1(self, level: int, i: int) -> int:
        block, at = divmod(i, BLOCK)
        r = int(self.ones[level][block])
        if at:
            words = self._words(level, block)
            r += int(np.bitwise_count(words[: at >> 6]).sum(dtype=np.int64))
            if at & 63:
                r += (int(words[at >> 6]) & ((1 << (at & 63)) - 1)).bit_count()
        return r

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            one = self._bit(level, i)
            ones = self._rank1(level, i)
            value = value << 1 | one
            i = self.zeros[level] + ones if one else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Range of the last order that holds the token's occurrences before ``end``."""
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        a, b = 0, end
        for level in range(self.bits):
            if a == b:
                return 0, 0
            ones_a, ones_b = self._rank1(level, a), self._rank1(level, b)
            if token >> (self.bits - 1 - level) & 1:
                a, b = self.zeros[level] + ones_a, self.zeros[level] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def rank(self, token: int, i: int) -> int:
        a, b = self._range(token, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bits(self, level: int, one: bool, ks: np.ndarray) -> np.ndarray:
        """Places of the k-th (from 0) ones or zeros of a plane, for ascending ``ks``."""
        before = self.ones[level]
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before[:-1], ks, side="right") - 1
        out = np.empty(len(ks), np.int64)
        for c in np.unique(block):
            mine = block == c
            marks = self._marks(level, int(c))
            places = np.flatnonzero(marks if one else ~marks)
            out[mine] = c * BLOCK + places[ks[mine] - before[c]]
        return out

    def _places(self, token: int, last: np.ndarray) -> np.ndarray:
        """Places in the sequence of places in the last order, all of one token, ascending."""
        i = last
        for level in reversed(range(self.bits)):
            one = bool(token >> (self.bits - 1 - level) & 1)
            i = self._select_bits(level, one, i - self.zeros[level] if one else i)
        return i

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence, k from 0."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        return int(self._places(token, np.array([a + k]))[0])

    def positions(self, token: int) -> list[int]:
        a, b = self._range(token, self.n)
        return self._places(token, np.arange(a, b)).tolist()

    def tokens(self) -> np.ndarray:
        cur = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            out = np.empty_like(cur)
            low, high = 0, self.zeros[level]
            mask = cur.dtype.type(1 << (self.bits - 1 - level))
            for c in range(-(-self.n // BLOCK)):
                one = self._marks(level, c)
                part = out[c * BLOCK : c * BLOCK + len(one)]
                at = np.flatnonzero(one)
                part[at] = cur[high : high + len(at)] | mask
                high += len(at)
                at = np.flatnonzero(~one)
                part[at] = cur[low : low + len(at)]
                low += len(at)
            cur = out
        return cur


def dump_shard(values: np.ndarray, doc_ids: np.ndarray, starts: np.ndarray, bits: int) -> bytes:
    m = WaveletMatrix.build(values, bits)
    z = zstandard.ZstdCompressor(level=1)
    blocks = [z.compress(m._words(level, c).astype("<u8").tobytes())
              for level in range(bits) for c in range(m.ones.shape[1] - 1)]
    tables = [z.compress(np.ascontiguousarray(a).astype("<i8").tobytes())
              for a in (doc_ids, starts, m.ones, np.array([len(x) for x in blocks], np.int64))]
    head = json.dumps({"n": m.n, "bits": bits, "zeros": m.zeros, "docs": len(doc_ids),
                       "tables": [len(t) for t in tables]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *tables, *blocks])


class ShardFile(WaveletMatrix):
    """A shard that is read block by block, through ``read(at, length)`` of its file."""

    def __init__(self, read):
        start = read(0, 8)
        if start[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", start[4:])[0]
        head = json.loads(read(8, size))
        z, at, tables = zstandard.ZstdDecompressor(), 8 + size, []
        for n in head["tables"]:
            tables.append(np.frombuffer(z.decompress(read(at, n)), "<i8"))
            at += n
        self.doc_ids, self.starts, ones, lengths = tables
        super().__init__(head["n"], head["bits"], head["zeros"], ones.reshape(head["bits"], -1))
        self._read, self._z, self._blocks = read, z, {}
        self._at = at + np.concatenate([[0], np.cumsum(lengths)])

    def _words(self, level: int, block: int) -> np.ndarray:
        k = level * (self.ones.shape[1] - 1) + block
        words = self._blocks.get(k)
        if words is None:
            if len(self._blocks) >= CACHED_BLOCKS:
                self._blocks.pop(next(iter(self._blocks)))
            a, b = int(self._at[k]), int(self._at[k + 1])
            words = np.frombuffer(self._z.decompress(self._read(a, b - a)), "<u8")
            self._blocks[k] = words
        return words


def load_shard(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """(matrix, document ids, document starts) of a shard file that is in memory."""
    m = ShardFile(lambda at, n: data[at : at + n])
    return m, m.doc_ids, m.starts


_MANIFEST = "pid int, shard int, file string, at long, n_tokens long, n_docs long"


def _write(root: str, path: str, end_id: int, bits: int, shard_tokens: int):
    """Sorted documents -> shard files, a manifest row each."""
    def run(batches):
        fs, base = open_fs(root)
        fs.create_dir(base, recursive=True)
        pid, shard, at = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4")
        ids, docs, n = [], [], 0

        def flush():
            nonlocal ids, docs, n, shard, at
            name = attempt_name("shard", ".wvm")
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])[:-1]])
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(dump_shard(np.concatenate(ids), np.array(docs, np.int64), starts, bits))
            row = pa.RecordBatch.from_pylist([{
                "pid": pid, "shard": shard, "file": name, "at": at, "n_tokens": n,
                "n_docs": len(docs)}], schema=pa.schema([
                    ("pid", pa.int32()), ("shard", pa.int32()), ("file", pa.string()),
                    ("at", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]))
            at, shard = at + n, shard + 1
            ids, docs, n = [], [], 0
            return row

        for doc, texts in gathered(batches):
            for r, data in encode_rows(texts, path):
                a = np.concatenate([np.frombuffer(data, "<u4"), end])
                if int(a.max()) >> bits:
                    raise ValueError(f"a token id needs more than {bits} bits")
                ids.append(a.astype(np.uint16 if bits <= 16 else np.uint32))
                docs.append(NO_ID if doc[r] is None else doc[r])
                n += len(a)
                if n >= shard_tokens:
                    yield flush()
        if docs:
            yield flush()

    return run


def _read(root: str, base_of: dict[int, int]):
    """Manifest rows -> doc_id, start, n_tokens, ids_crc32 from the files."""
    def run(batches):
        fs, base = open_fs(root)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_stream(f"{base}/{row['file']}") as f:
                    m, docs, starts = load_shard(f.read())
                data = m.tokens().astype("<u4").tobytes()
                ends = np.append(starts[1:], m.n)
                at = base_of[row["pid"]] + row["at"]
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64(), mask=docs == NO_ID), pa.array(starts + at),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_shards(docs: DataFrame, root: str, tokenizer: str, end_id: int = 0, bits: int = 16,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards below ``root``; the manifest, not yet materialised."""
    n = partitions_for(docs.sparkSession)
    # equal rows are told apart by their number, so that those of one id can be split anywhere
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "*", F.substring("text", 1, 64).alias("_head"), F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_head").asc_nulls_first(), "_hash", "_row"]
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "doc_id", "text").mapInArrow(_write(root, tokenizer, end_id, bits, shard_tokens), _MANIFEST)


def read_shards(manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of a manifest."""
    # one number per range: tokens of all ranges before it
    sums = manifest.groupBy("pid").agg(F.sum("n_tokens").alias("n")).orderBy("pid").collect()
    base, at = {}, 0
    for r in sums:
        base[r["pid"]] = at
        at += r["n"]
    spread = manifest.repartition(max(1, partitions_for(manifest.sparkSession)))
    return spread.mapInArrow(
        _read(root, base), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _over_files(root: str, step, names: list[str]):
    """Manifest rows -> what ``step`` gives for each shard, opened by its directory alone."""
    def run(batches):
        fs, base = open_fs(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_file(f"{base}/{name}") as f:
                    for columns in step(ShardFile(lambda at, n: f.read_at(n, at)), name):
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.select("file").repartition(partitions_for(manifest.sparkSession))


def count_tokens(manifest: DataFrame, root: str, tokens: list[int]) -> DataFrame:
    """(token, count) of each of ``tokens`` over all shards; two blocks a plane are read of each."""
    tokens = sorted(set(tokens))

    def step(m, _):
        yield [pa.array(tokens, pa.int64()), pa.array([m.count(t) for t in tokens], pa.int64())]

    found = _spread(manifest).mapInArrow(
        _over_files(root, step, ["token", "count"]), "token long, count long")
    return found.groupBy("token").agg(F.sum("count").alias("count"))


def find_tokens(manifest: DataFrame, root: str, tokens: list[int]) -> DataFrame:
    """Every occurrence of ``tokens``: token, doc_id, place in its document, file and place there."""
    tokens = sorted(set(tokens))

    def step(m, name):
        for t in tokens:
            at = np.array(m.positions(t), np.int64)
            # an end id makes every document longer than nothing, so starts are distinct
            doc = np.searchsorted(m.starts, at, side="right") - 1
            ids = m.doc_ids[doc]
            yield [pa.array(np.full(len(at), t)), pa.array(ids, pa.int64(), mask=ids == NO_ID),
                   pa.array(at - m.starts[doc]), pa.array([name] * len(at), pa.string()), pa.array(at)]

    return _spread(manifest).mapInArrow(
        _over_files(root, step, ["token", "doc_id", "place", "file", "at"]),
        "token long, doc_id long, place long, file string, at long")


def tokens_at(places: DataFrame, root: str) -> DataFrame:
    """The token at each of ``places`` (file, at): file, at, token.

    Places are dealt out by file and block, so a file asked often is shared by several tasks.
    """
    def run(batches):
        fs, base = open_fs(root)
        name = f = m = None
        for batch in batches:
            files, at = batch.column("file").to_pylist(), batch.column("at").to_pylist()
            out = []
            for x, i in zip(files, at):
                if x != name:
                    if f is not None:
                        f.close()
                    name, f = x, fs.open_input_file(f"{base}/{x}")
                    m = ShardFile(lambda a, n, f=f: f.read_at(n, a))
                out.append(m.access(i))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("at"), pa.array(out, pa.int64())],
                names=["file", "at", "token"])
        if f is not None:
            f.close()

    asked = places.select("file", F.col("at").cast("long").alias("at"))
    return asked.repartition(
        partitions_for(places.sparkSession), "file", F.floor(F.col("at") / BLOCK)
    ).sortWithinPartitions("file", "at").mapInArrow(run, "file string, at long, token long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    sc = Scratch(docs.sparkSession, "wavelet")
    root = sc.uri("shards")
    manifest = sc.write(write_shards(docs, root, tokenizer, end_id), "manifest")
    return sc.finish(read_shards(manifest, root))
