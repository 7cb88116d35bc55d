"""Token ids by the ``tokenizers`` library, with a memo for repeated pieces of text.

A text is cut before each space that follows a character that is not white
space, around single line breaks, and before full stops and commas that end a
piece after a letter or digit. The byte-level pre-tokenizer always has a boundary
there, so every piece is encoded alike wherever it stands and its ids can be
remembered; the library itself encodes each piece that is not in the memo. The
memo is bounded. Arrow numbers the different pieces of a batch, so each is looked up
once, and numpy deals their ids out to the places where they stand.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from clickvault.llm.common import MEMOS, release_memory

MEMO_ENTRIES = 400_000  # of the memo and of the one before it, each
MEMO_PIECE = 64  # longer pieces are not remembered
LEARN = 500  # new pieces encoded in one call; the library takes longer for each in long texts
CHARS = 16_000_000  # characters of the texts that are encoded together
ROWS = 500  # texts whose ids are dealt out at a time
RELEASE = 32_000_000  # characters after which a worker gives free memory back
_CUT = re.compile(r"(?<=\S) ")
TAIL = ".,"
BARE = "\r"  # marks a piece that has no space before it


class MemoEncoder:
    """ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tok: Tokenizer):
        self.tok = tok
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocab.values()) + 1, bool)  # ids whose token starts with a space
        for t, i in vocab.items():
            self.opens[i] = t.startswith("Ġ")
        self.letters = self._letters()
        self.newline = self._array("\n")
        self.memo: dict[str, bytes] = {}
        self.start()
        self.since = 0  # characters encoded since memory was given back
        self.odd: dict[str, bytes] = {}  # other pieces, as they stand

    def start(self) -> None:
        """Begin a new memo; of the full one, what is asked for again goes on in the new one."""
        self.before = self.memo
        #: piece -> ids with a space before it; BARE + piece -> ids as it stands; the line break
        self.memo = {"\n": self.newline.tobytes()}

    def _letters(self) -> Tokenizer | None:
        """The library's tokenizer for ASCII letters after a space, given as the space's character.

        The usual byte-level pattern takes such a word as one piece and each of its bytes is the
        character of the same name, so the model's merges are all there is to do.
        """
        cut = self.tok.pre_tokenizer
        added = self.tok.get_added_tokens_decoder().values()
        if (type(cut) is not pre_tokenizers.ByteLevel or not cut.use_regex or self.tok.normalizer
                or self.tok.post_processor or any(t.content.isalpha() for t in added)):
            return None
        tok = Tokenizer(self.tok.model)
        tok.pre_tokenizer = pre_tokenizers.Split("Ġ", "merged_with_next")
        return tok

    def _array(self, text: str) -> np.ndarray:
        return np.array(
            self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _as_is(self, piece: str) -> bytes:
        v = self.odd.get(piece)
        if v is None:
            v = self._array(piece).tobytes() if piece else b""
            if len(piece) <= MEMO_PIECE:
                if len(self.odd) >= MEMO_ENTRIES // 4:
                    self.odd.clear()
                self.odd[piece] = v
        return v

    def _learn_all(self, keys: list[str], bare: bool) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(keys), LEARN):
            out += self._learn(keys[i : i + LEARN], bare)
        return out

    def _learn(self, keys: list[str], bare: bool) -> list[bytes]:
        """Encode new pieces together: each after a space, or each on a line of its own."""
        pieces = [k[1:] for k in keys] if bare else keys
        text = "\n".join(pieces) if bare else "".join(pieces)
        if not bare and self.letters and text.isascii() and text.isalpha():
            ids = np.array(self.letters.encode_batch_fast(
                ["Ġ" + "Ġ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        else:
            ids = self._array(text if bare else " " + " ".join(pieces))
        if bare:
            ends = np.flatnonzero(ids == self.newline[0]) if len(self.newline) == 1 else []
            starts, stops = [0, *(4 * e + 4 for e in ends)], [*(4 * e for e in ends), 4 * len(ids)]
        else:
            starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            stops = [*starts[1:], 4 * len(ids)]
        if len(starts) != len(keys):  # a piece was not what it seemed: one by one
            vals = [self._array(p if bare else " " + p).tobytes() for p in pieces]
        else:
            data = ids.tobytes()
            vals = [data[a:b] for a, b in zip(starts, stops)]
        self.memo.update(zip(keys, vals))
        return vals

    def _core(self, key: str) -> str:
        """The key without a tail that is a token run of its own."""
        core = key.rstrip(TAIL)
        return core if core[-1:].isalnum() else key

    def _value(self, key: str) -> bytes:
        v = self.memo.get(key)
        if v is not None:
            return v
        core = self._core(key)
        v = self.memo.get(core)
        if v is None:
            v = self._as_is(core[1:] if core[0] == BARE else " " + core)
        if len(core) < len(key):
            v += self._as_is(key[len(core):])
            if len(key) <= MEMO_PIECE:
                self.memo[key] = v
        return v

    def _odd_text(self, text: str) -> bytes:
        """A text with other white space than single spaces and line breaks between words."""
        first, *rest = _CUT.split(text)
        out = [self._as_is(first)]
        for p in rest:
            # a piece without white space is a key of the memo too
            plain = p and not any(map(str.isspace, p))
            out.append(self._value(p) if plain else self._as_is(" " + p))
        return b"".join(out)

    def _values(self, keys: list[str]) -> list:
        """What is remembered of each key, else None; what was in use before goes on in the memo."""
        if len(self.memo) > MEMO_ENTRIES:
            self.start()
        vals = list(map(self.memo.get, keys))
        # no ids are empty, so all() finds what is not known
        if self.before and not all(vals):
            for i, v in enumerate(vals):
                if v is None and (v := self.before.get(keys[i])) is not None:
                    vals[i] = self.memo[keys[i]] = v
        return vals

    def encode(self, texts: list[str]) -> list[bytes]:
        # each different piece of the batch is looked up once, and its ids dealt out by number
        column = pa.array([BARE + t for t in texts], pa.large_string())
        split = pc.split_pattern(pc.replace_substring(column, "\n", " \n " + BARE), " ")
        coded = split.flatten().dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = coded.indices.to_numpy()
        edges = split.offsets.to_numpy() - split.offsets[0].as_py()
        vals = self._values(keys)
        new = [i for i, v in enumerate(vals) if v is None]
        # most are words, which the library takes at once
        words: tuple[list, list] = ([], [])
        for i in new:
            if (k := keys[i]).isalnum() and len(k) <= MEMO_PIECE:
                words[k.isascii() and k.isalpha()].append(i)
        for part in words:
            for i, v in zip(part, self._learn_all([keys[i] for i in part], False)):
                vals[i] = v
        # a cut holds only between characters that are not white space
        new = [i for i in new if vals[i] is None]
        bad = np.zeros(len(keys), bool)
        for i in new:
            k = keys[i]
            bad[i] = not k or k == BARE or k[-1].isspace() or k[0] == BARE and k[1].isspace()
        odd = {r for r, t in enumerate(texts) if BARE in t}
        if bad.any():
            odd.update((np.searchsorted(edges, np.flatnonzero(bad[number]), side="right") - 1).tolist())
        used = np.ones(len(keys), bool)  # keys of other texts than the odd ones
        if odd:
            used[:] = False
            even = np.ones(len(texts), bool)
            even[list(odd)] = False
            used[number[np.repeat(even, np.diff(edges))]] = True
        new = [i for i in new if used[i]]
        todo = {keys[i] for i in new}
        for r in odd:
            todo.update(p for p in texts[r].split() if p not in self.memo)
        plain, bare = set(), set()
        for k in todo:
            core = self._core(k)
            if core not in self.memo and len(core) <= MEMO_PIECE and (
                    core.isalnum() or not any(map(str.isspace, core[1:]))):
                (bare if core[0] == BARE else plain).add(core)
        letters = {k for k in plain if k.isascii() and k.isalpha()}
        self._learn_all(list(letters), False)
        self._learn_all(list(plain - letters), False)
        self._learn_all(list(bare), True)
        for i in new:
            vals[i] = self._value(keys[i])
        vals = [v if u else b"" for v, u in zip(vals, used.tolist())] if odd else vals
        ids = np.frombuffer(b"".join(vals), "<u4")
        size = np.fromiter(map(len, vals), np.int64, len(vals)) // 4
        first = np.cumsum(size) - size
        out: list[bytes] = []
        for a in range(0, len(texts), ROWS):
            rows = edges[a : a + ROWS + 1]
            mine = number[rows[0] : rows[-1]]
            n = size[mine]
            end = np.cumsum(n)
            flat = ids[np.repeat(first[mine] - (end - n), n) + np.arange(n.sum())]
            at = np.concatenate([[0], end])[rows - rows[0]].tolist()
            out += [flat[x:y].tobytes() for x, y in zip(at, at[1:])]
        for r in odd:
            out[r] = self._odd_text(texts[r])
        return out


@lru_cache(maxsize=4)
def memo_encoder(path: str) -> MemoEncoder:
    """One encoder per worker process and vocabulary file."""
    return MemoEncoder(Tokenizer.from_file(path))


MEMOS.append(memo_encoder.cache_clear)


def encode_rows(texts: list, path: str, chars: int = 2 * CHARS):
    """(row, ids bytes) for every text (None: empty), a bounded part of the rows at a time."""
    enc = memo_encoder(path)
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n < chars):
            n += len(texts[j] or "")
            j += 1
        yield from zip(range(i, j), enc.encode([t or "" for t in texts[i:j]]))
        i, enc.since = j, enc.since + n
    # a worker is used again by other stages: give back what Arrow and the C library hold free
    if enc.since >= RELEASE:
        enc.since = 0
        release_memory()


def gathered(batches, chars: int = CHARS):
    """(doc_ids, texts) of the rows of Arrow batches, about ``chars`` characters together."""
    ids, texts, n = [], [], 0
    for batch in batches:
        ids += batch.column("doc_id").to_pylist()
        more = batch.column("text").to_pylist()
        texts += more
        n += sum(len(t) for t in more if t)
        if n >= chars:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts
