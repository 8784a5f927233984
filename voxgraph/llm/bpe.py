"""Byte-level BPE, encoded in batched numpy merge rounds.

The vocabulary and merges come from a public tokenizer file.  A batch of texts
is cut into words by vectorised classes of code points; each distinct word is
encoded once.  The symbols of all words that are not in the cache lie in one
flat array; each round finds the rank of every adjacent pair by binary search
over the sorted pair keys, merges the lowest pair of every word (left to right
where it overlaps itself) and compacts the array, until no word has a pair
with a rank.

Words are told apart by a hash that is confirmed on their bytes, and cached by
their bytes.

Rows: one for each input row, repeated rows alike; null is an empty text, which
has no tokens; an empty table has no rows.  The special token's own string in a
text is one token, as in the library.  A text of any length is encoded whole,
in memory of some ten times its bytes.  Only the id and the text are read, so
that further columns can have any name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# Code points that became letters or numbers with Unicode 16.0, which the tokenizers library follows; first and last of each range.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
# The contractions that stand as words of their own, in the order in which they are tried.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Distinct words whose tokens a Python worker keeps within a partition.
CACHE_WORDS = 200_000


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by rule: visible Latin-1 as itself, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def _classes() -> np.ndarray:
    white = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    t = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(c))[0]
        t[c] = _LETTER if first == "L" else _NUMBER if first == "N" else _OTHER
    for ranges, kind in ((LETTERS_16, _LETTER), (NUMBERS_16, _NUMBER)):
        for first, last in ranges:
            t[first : last + 1] = kind
    t[list(white)] = _SPACE
    return t


def cut_words(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the words in the code points of texts with the given offsets (each word ends where the next starts, or at its text's end)."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[cp]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = np.ones(n, bool)
    first[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    # A word takes the one plain space before it; other white space before a word stands apart from the rest of its run.
    last_space = np.zeros(n, bool)
    last_space[:-1] = (kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~edge[1:n]
    start = first.copy()
    start[last_space] = True
    joins = np.flatnonzero(last_space & (cp == 32))
    start[joins + 1] = False
    # An apostrophe alone between a word's end and letters takes a contraction's letters with it.
    quote = np.flatnonzero((cp == 39) & start & (kind == _OTHER))
    quote = quote[(quote + 1 < n)]
    quote = quote[(kind[quote + 1] == _LETTER) & ~edge[quote + 1]]
    open_ = np.ones(len(quote), bool)
    for tail in CONTRACTIONS:
        size = len(tail)
        ok = open_ & (quote + size < n)
        for i, c in enumerate(tail):
            at = np.minimum(quote + 1 + i, n - 1)
            ok &= (cp[at] == ord(c)) & ~edge[at]
        hit = quote[ok]
        start[hit + 1] = False
        after = hit + 1 + size
        after = after[after < n]
        start[after[(kind[after] == _LETTER) & ~edge[after]]] = True
        open_ &= ~ok
    return np.flatnonzero(start)


class Tokenizer:
    """Tables of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], _byte_chars()
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in vocab.items():
            self.bytes_of[i] = bytes(chars[c] for c in s)
        for s, i in self.special.items():
            self.bytes_of[i] = s
        self.decimal = [b"%d," % i for i in range(len(self.bytes_of))]
        self.byte_id = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        # A direct table of pairs of bytes and a small filter save most searches.
        self.filter = np.zeros(1 << 22, bool)
        self.filter[self._slot(self.keys)] = True
        self.cache: dict[bytes, tuple[int, bytes, bytes]] = {}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys >> 32) * 40503 + (keys & 0xFFFFFFFF) * 9973) & ((1 << 22) - 1)

    def merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and their words; ``sym`` starts with one symbol for each byte, words in order."""
        none = np.iinfo(np.int64).max
        done_s, done_w = [], []
        while len(sym):
            keys = sym[:-1] << 32 | sym[1:]
            at = np.full(len(sym), -1, np.int64)
            may = np.flatnonzero((word[:-1] == word[1:]) & self.filter[self._slot(keys)])
            i = np.minimum(np.searchsorted(self.keys, keys[may]), len(self.keys) - 1)
            real = self.keys[i] == keys[may]
            at[may[real]] = i[real]
            rank = np.where(at >= 0, self.rank[at], none)
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, head)
            size = np.diff(np.append(head, len(sym)))
            live = np.repeat(least < none, size)
            if not live.all():  # words without a pair are ready
                done_s.append(sym[~live])
                done_w.append(word[~live])
            hit = live & (rank == np.repeat(least, size))
            # In a run of overlapping hits every other one merges, from the left.
            pos = np.flatnonzero(hit)
            fresh = np.append(True, np.diff(pos) != 1)[: len(pos)]
            nth = np.arange(len(pos)) - np.maximum.accumulate(np.where(fresh, np.arange(len(pos)), 0)) if len(pos) else pos
            pos = pos[nth % 2 == 0]
            sym = sym.copy()
            sym[pos] = self.made[at[pos]]
            keep = live
            keep[pos + 1] = False
            sym, word = sym[keep], word[keep]
        s, w = np.concatenate([*done_s, sym]), np.concatenate([*done_w, word])
        order = np.argsort(w, kind="stable")
        return s[order], w[order]

    def _symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words, one after the other, and the offsets of each word's."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym, word = self.merge(self.byte_id[flat], np.repeat(np.arange(len(words)), sizes))
        return sym, np.searchsorted(word, np.arange(len(words) + 1))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def _entries(self, raw: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """(tokens, their ids in decimal with a comma after each, their decoded bytes) of distinct words."""
        new = [w for w in raw if w not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS:
                keep = self.cache
                self.cache = {w: keep[w] for w in raw if w in keep}
            flat, cut = self._symbols(new)
            ids, at, dec, back = flat.tolist(), cut.tolist(), self.decimal, self.bytes_of
            for w, a, b in zip(new, at[:-1], at[1:], strict=True):
                own = ids[a:b]
                self.cache[w] = (b - a, b"".join([dec[x] for x in own]), b"".join([back[x] for x in own]))
        return [self.cache[w] for w in raw]

    def ids(self, text: str) -> list[int]:
        """Token ids of one text."""
        raw = np.frombuffer(text.encode(), np.uint8)
        (_, written, _), = self.texts(raw, np.array([0, len(raw)]))
        return [int(x) for x in written.split(b",")] if written else []

    def _marks(self, whole: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Starts, ends and strings of special tokens in the texts: leftmost, of several at one place the longest."""
        if not self.special or not any(m in whole for m in self.special):
            return off[:0], off[:0], []
        found = [m for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True) for m in self.special_pattern.finditer(whole, a, b)]
        return np.array([m.start() for m in found], np.int64), np.array([m.end() for m in found], np.int64), [m.group() for m in found]

    def texts(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """(tokens, decimal ids joined by commas, decoded bytes) of each text of a slice of UTF-8 bytes."""
        whole = data.tobytes()
        marks, mark_ends, mark_strings = self._marks(whole, off)
        cp = np.frombuffer(whole.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte at which each code point starts
        # Words end at the edges of texts and of special tokens; what lies inside a special token is no word.
        edges = np.unique(np.concatenate([off, marks, mark_ends]))
        start = cut_words(cp, np.searchsorted(lead, edges))
        begin = lead[start] if len(start) else start
        end = np.minimum(np.append(begin[1:], len(data)), edges[np.searchsorted(edges, begin, side="right")]) if len(begin) else begin
        of_mark = np.full(len(begin), -1, np.int64)
        if len(marks):
            i = np.searchsorted(marks, begin, side="right") - 1
            inside = (i >= 0) & (begin < mark_ends[i])
            of_mark = np.where(inside, i, -1)
            keep = ~inside | (begin == marks[i])
            begin, end, of_mark = begin[keep], np.where(inside, mark_ends[i], end)[keep], of_mark[keep]
        doc = np.searchsorted(off, begin, side="right") - 1
        lanes = K.Lanes(data)
        _, at, which = np.unique(lanes.hash(begin, end) ^ (of_mark >= 0).astype(np.uint64), return_index=True, return_inverse=True)
        size = end - begin
        if not ((size == size[at[which]]) & lanes.equal(begin, begin[at[which]], size)).all():  # digests that collide do not decide
            seen: dict[tuple[bytes, bool], int] = {}
            which = np.array([seen.setdefault((whole[a:b], m >= 0), len(seen)) for a, b, m in zip(begin.tolist(), end.tolist(), of_mark.tolist(), strict=True)])
            at = np.unique(which, return_index=True)[1]
        raw = [whole[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
        special = (of_mark[at] >= 0).tolist()
        plain = iter(self._entries([w for w, m in zip(raw, special, strict=True) if not m]))
        entries = [(1, self.decimal[self.special[w]], w) if m else next(plain) for w, m in zip(raw, special, strict=True)]
        n, text, back = (list(x) for x in zip(*entries, strict=True)) if entries else ([], [], [])
        which = which.tolist()
        cut = np.searchsorted(doc, np.arange(len(off))).tolist()
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            own = which[a:b]
            yield sum([n[i] for i in own]), b"".join([text[i] for i in own])[:-1], b"".join([back[i] for i in own])


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; ``path`` names a tokenizer file that every executor has."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        tok = load(path)
        for a, b, data, off in K.slices(batch.column(1)):
            made = list(tok.texts(data, off))
            yield {
                "doc_id": batch.column(0).slice(a, b - a),
                "n_tokens": [m[0] for m in made],
                "ids_sha256": [hashlib.sha256(m[1]).hexdigest() for m in made],
                "decoded_sha256": [hashlib.sha256(m[2].decode("utf-8", "replace").encode()).hexdigest() for m in made],
            }

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.mapper(rows, _SCHEMA, lambda: load(path).cache.clear()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids array<int>) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        tok = load(path)
        for a, b, data, off in K.slices(batch.column(1)):
            made = list(tok.texts(data, off))
            ids = [np.array(m[1].split(b","), np.int32) if m[1] else np.zeros(0, np.int32) for m in made]
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_tokens": [m[0] for m in made], "ids": ids}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.mapper(rows, schema, lambda: load(path).cache.clear()), "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids; null ids give a null text, bytes that are not UTF-8 give U+FFFD."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        tok = load(path)
        yield {"doc_id": batch.column(0), "text": [None if x is None else tok.decode(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]}

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(K.mapper(rows, schema), "doc_id long, text string")
