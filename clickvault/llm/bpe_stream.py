"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding a word symbol by symbol, the transducer keeps, for each place, the last
token of the encoding of the word up to there. That token is the one token
ending there that is compatible with the last token at its start, where two
tokens are compatible when the merges, applied to both together, leave them as
they are: a sequence is an encoding exactly when all its neighbours are
compatible. No token is longer than the longest in the merge list, so whatever
follows, the word's encoding passes through one of the last ``lookahead``
places; tokens that lie on the paths of all of these are stable and are given
out, and the places before them are forgotten. Memory depends on the merge
list, not on the length of the word.

Texts are read in windows that end at white space. Pieces between spaces are
remembered with their ids (a bounded memo of the transducer's output).

The decoder is a state machine over ids: each adds its bytes, complete UTF-8
characters are given out as text, and an unfinished character waits for more.

Null text counts as empty. Rows with a null or repeated doc_id are encoded each.
Extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import ship_package

MEMO_ENTRIES = 400_000
MEMO_PIECE = 64
WINDOW_CHARS = 1 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class MergeList:
    """Vocabulary, merges and what follows from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        self.parts: dict[int, list[int]] = {}
        made = {v[1] for v in self.merges.values()}
        inner: dict[str, int] = {}
        last: dict[str, int] = {}
        for t, i in self.vocab.items():
            if len(t.removesuffix(self.suffix) if self.suffix else t) > 1 and i not in made:
                continue  # no merge makes it
            if self.suffix and t.endswith(self.suffix) and t != self.suffix:
                last[t.removesuffix(self.suffix)] = i
            else:
                inner[t] = i
        self.inner, self.last = inner, last if self.suffix else inner
        #: Places that the encoding of any longer word may still pass through.
        self.lookahead = max(map(len, [*inner, *last]))
        # longest token of each kind that ends in the same three symbols
        self.longest: dict[int, dict[str, int]] = {}
        for kind in (inner, last):
            ends: dict[str, int] = {}
            for t in kind:
                if len(t) > 2:
                    ends[t[-3:]] = max(ends.get(t[-3:], 0), len(t))
            self.longest[id(kind)] = ends
        self._fits: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self.symbols = {i: [self.inner[c] for c in t] for t, i in inner.items()
                        if all(c in inner for c in t)}
        if self.suffix:
            for t, i in last.items():
                if all(c in inner for c in t[:-1]) and t[-1:] in last:
                    self.symbols[i] = [inner[c] for c in t[:-1]] + [last[t[-1]]]

    def merged(self, symbols: list[int]) -> list[int]:
        """The merge list applied to a few symbols: lowest rank first, then leftmost."""
        s = list(symbols)
        while len(s) > 1:
            best = min(((self.merges[p][0], i) for i, p in enumerate(zip(s, s[1:]))
                        if p in self.merges), default=None)
            if best is None:
                break
            i = best[1]
            s[i : i + 2] = [self.merges[s[i], s[i + 1]][1]]
        return s

    def whole(self, t: int) -> bool:
        """The merges make this token from its symbols."""
        v = self._whole.get(t)
        if v is None:
            v = self._whole[t] = t in self.symbols and self.merged(self.symbols[t]) == [t]
        return v

    def fits(self, a: int, b: int) -> bool:
        """The tokens stay as they are next to each other."""
        v = self._fits.get((a, b))
        if v is None:
            if len(self._fits) >= 400_000:
                self._fits.clear()
            v = self.merged(self.symbols[a] + self.symbols[b]) == [a, b]
            self._fits[a, b] = v
        return v


class Transducer:
    """Encodes one word, fed symbol by symbol; gives tokens out once they are stable."""

    def __init__(self, merges: MergeList):
        self.m = merges
        self.reset()

    def reset(self) -> None:
        self.text = ""  # symbols since the last given-out token
        self.path: list[tuple[int, int]] = [(-1, 0)]  # place -> (last token, its length)
        self.before = -1  # last token given out
        self.most = 0

    def _step(self, tokens: dict[str, int]) -> None:
        m, text, path = self.m, self.text, self.path
        end = len(text)
        most = m.longest[id(tokens)].get(text[-3:], 2)
        for n in range(most if most < end else end, 0, -1):
            t = tokens.get(text[end - n :])
            if t is None or not m.whole(t):
                continue
            if end == n:
                prev = self.before
            else:
                prev = path[end - n][0]
                if prev == -2:
                    continue
            if prev == -1 or m.fits(prev, t):
                path.append((t, n))
                return
        path.append((-2, 0))  # no encoding ends here

    def _back(self, place: int) -> list[int]:
        out = []
        while place > 0:
            out.append(place)
            place -= self.path[place][1]
        return out

    def feed(self, symbol: str) -> list[int]:
        """Add a symbol that is not the word's last; returns newly stable tokens."""
        self.text += symbol
        self._step(self.m.inner)
        self.most = max(self.most, len(self.path))
        n = len(self.text)
        if n < 2 * self.m.lookahead or n % self.m.lookahead:
            return []
        ends = [p for p in range(n - self.m.lookahead + 1, n + 1) if self.path[p][0] != -2]
        common = set(self._back(ends[0]))
        for p in ends[1:]:
            common.intersection_update(self._back(p))
        if not common:
            return []
        stable = max(common)
        out = [self.path[p][0] for p in reversed(self._back(stable))]
        self.text = self.text[stable:]
        self.path = [(-1, 0), *self.path[stable + 1 :]]
        self.before = out[-1]
        return out

    def finish(self, symbol: str) -> list[int]:
        """Add the word's last symbol; returns the remaining tokens."""
        self.text += symbol
        self._step(self.m.last)
        out = [self.path[p][0] for p in reversed(self._back(len(self.text)))]
        self.reset()
        return out


class StreamEncoder:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.merges = MergeList(path)
        self.alphabet = byte_alphabet()
        self.transducer = Transducer(self.merges)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(split)
        self.special = re.compile("(" + "|".join(map(re.escape, self.merges.added)) + ")")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode_word(self, word: str) -> bytes:
        v = self.words.get(word)
        if v is None:
            symbols = [self.alphabet[b] for b in word.encode("utf-8")]
            ids: list[int] = []
            for s in symbols[:-1]:
                ids += self.transducer.feed(s)
            ids += self.transducer.finish(symbols[-1])
            v = np.array(ids, "<u4").tobytes()
            if len(word) <= MEMO_PIECE:
                if len(self.words) >= MEMO_ENTRIES:
                    self.words.clear()
                self.words[word] = v
        return v

    def _plain(self, piece: str) -> bytes | None:
        """ids of ASCII letters and a tail of full stops and commas: two words without a search."""
        core = piece.rstrip(".,")
        if not core.isascii() or not core.isalpha():
            return None
        v = self.encode_word(core.lower())
        return v if len(core) == len(piece) else v + self.encode_word(piece[len(core):])

    def encode_piece(self, piece: str) -> bytes:
        v = self._plain(piece)
        if v is None:
            v = self._search(piece)
        if len(piece) <= MEMO_PIECE:
            if len(self.pieces) >= MEMO_ENTRIES:
                self.pieces.clear()
            self.pieces[piece] = v
        return v

    def _search(self, piece: str) -> bytes:
        out = []
        for k, part in enumerate(self.special.split(piece)):
            if k % 2:
                out.append(np.array([self.merges.added[part]], "<u4").tobytes())
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                # one character at a time: no rule that looks at its neighbours
                part = "".join([c.lower() for c in part]) if "Σ" in part else part.lower()
            else:
                part = part.lower()
            out += [self.encode_word(w) for w in self.word.findall(part)]
        return b"".join(out)

    def encode(self, text: str):
        """Parts of the text's ids, window by window."""
        at = 0
        while at < len(text):
            end = at + WINDOW_CHARS
            if end < len(text):
                cut = text.find(" ", end)
                end = len(text) if cut < 0 else cut
            # a line break separates words as a space does
            pieces = text[at:end].replace("\n", " ").split(" ")
            vals = list(map(self.pieces.get, pieces))
            for i in [i for i, v in enumerate(vals) if v is None]:
                vals[i] = self.encode_piece(pieces[i])
            yield b"".join(vals)
            at = end


class StreamDecoder:
    """Text of ids fed in any portions."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        names |= {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        if self.byte_level:
            byte_of = {c: b for b, c in enumerate(byte_alphabet())}
            self.bytes = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t)
                          else t.encode() for i, t in names.items()}
        else:
            self.bytes = {i: t.encode() for i, t in names.items()}
        self.start()

    def start(self) -> None:
        self.text = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def feed(self, ids: list[int]) -> str:
        """The characters that these ids complete."""
        if not ids:
            return ""
        if self.byte_level:
            data = b"".join(map(self.bytes.__getitem__, ids))
        else:  # without a decoder, tokens are separated by spaces
            data = (b"" if self.first else b" ") + b" ".join(map(self.bytes.__getitem__, ids))
        self.first = False
        return self.text.decode(data)

    def end(self) -> str:
        return self.text.decode(b"", True)


@lru_cache(maxsize=2)
def coders(path: str) -> tuple[StreamEncoder, StreamDecoder]:
    """One pair per worker process and vocabulary file."""
    return StreamEncoder(path), StreamDecoder(path)


def _digests(path: str):
    def run(batches):
        enc, dec = coders(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for t in batch.column("text").to_pylist():
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                dec.start()
                for part in enc.encode(t or ""):
                    n += len(part) // 4
                    ids_hash.update(part)
                    text_hash.update(dec.feed(np.frombuffer(part, "<u4").tolist()).encode())
                text_hash.update(dec.end().encode())
                counts.append(n)
                ids_sha.append(ids_hash.hexdigest())
                text_sha.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha),
                 pa.array(text_sha)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str):
    def run(batches):
        enc, _ = coders(path)
        for batch in batches:
            ids = [np.frombuffer(b"".join(enc.encode(t or "")), "<u4").astype(np.int32)
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    return run


def _rows(docs: DataFrame) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids for every document."""
    return _rows(docs).mapInArrow(_ids(tokenizer), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text they decode to."""
    return _rows(docs).mapInArrow(
        _digests(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
