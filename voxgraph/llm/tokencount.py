"""Token counts by a two-tier lookup on the map side.

A sentencepiece model whose pieces never run over the start of a run of spaces,
nor over a line feed, gives a text as many tokens as its *pre-tokens* have one
by one: runs of spaces with what follows them, and line feeds with what follows
them.  Both are checked for each model that is read; a text of a model that
fails is one pre-token.

First tier: the lengths in tokens of frequent short pre-tokens, in one compact
table (sorted 64-bit hashes, the bytes themselves to confirm them, lengths) that
is sent to every executor.  Second tier: what is not there is encoded by the
library, and short ones are remembered in the worker.  No pre-token is
shuffled.  The frequent ones come from a sample of documents; the sample decides
how fast a count is had, never what it is.

Rows: one for each input row, repeated rows alike; null and empty texts have no
bytes and no tokens; an empty table has no rows.  Texts and pre-tokens of any
length are read whole.  Strings of control tokens inside a text are plain text,
as in the library.  Only the id and the text are read, so that further columns
can have any name.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.llm.sampling import hashed_share

#: Sampled documents, and pre-tokens that each lets its task report: the driver gets at most their product.
SAMPLE_ROWS, REPORTED = 4_000, 64
#: Entries of the first tier, and bytes of a pre-token that can be one.
FREQUENT, SHORT = 1 << 16, 16
#: Pre-tokens that a worker remembers within a partition, and bytes of one that it does.
CACHE_ENTRIES, CACHED_BYTES = 300_000, 48
MARK = "▁".encode()
_NEWLINE, _SPACE = 10, 32


@dataclass
class Frequent:
    """The first tier: pre-tokens of at most 16 bytes in the order of their hashes; 27 bytes an entry."""

    hash: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    tokens: np.ndarray

    def lookup(self, lanes: K.Lanes, start: np.ndarray, size: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Tokens of each span, -1 where it is not in the table."""
        if not len(self.hash):
            return np.full(len(h), -1, np.int64)
        i = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        ok = (self.hash[i] == h) & (self.size[i] == size)
        low, high = _lanes(lanes, start, np.where(ok, size, 0))
        return np.where(ok & (self.low[i] == low) & (self.high[i] == high), self.tokens[i].astype(np.int64), -1)


def _lanes(lanes: K.Lanes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each span as two words, zeros beyond its end."""
    rest = np.clip(size - 8, 0, 8)
    return lanes.at[start] & K._FIRST[np.minimum(size, 8)], np.where(rest > 0, lanes.at[start + np.minimum(size, 8)], 0).astype(np.uint64) & K._FIRST[rest]


class Model:
    """A sentencepiece model file, and where its texts can be cut."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [p for i in range(self.sp.get_piece_size()) if not self.sp.is_byte(i) and not self.sp.is_control(i) for p in [self.sp.id_to_piece(i)]]
        mark = MARK.decode()
        # A piece with a mark after another character, or a model that changes texts, forbids cuts.
        same = self.sp.decode(self.sp.encode("  a  b\n c ")) == "  a  b\n c " and len(self.sp.encode("a", add_bos=False)) > 0 and self.sp.encode("a", out_type=str)[0].startswith(mark)
        self.cuts = same and not any(mark in p.lstrip(mark) or "\n" in p for p in plain)
        self.alone = len(self.sp.encode("a ")) - len(self.sp.encode("a"))
        self.cache: dict[bytes, int] = {}

    def lengths(self, raw: list[bytes]) -> list[int]:
        """Tokens of distinct pre-tokens, without the space that opens them; one that starts with a line feed has none."""
        new = [r for r in raw if r and r not in self.cache]
        made = {b"": self.alone}
        for r, ids in zip(new, self.sp.encode([r.decode() for r in new], num_threads=1) if new else [], strict=True):
            made[r] = len(ids) - (self.cuts and r[0] == _NEWLINE)
        kept = {r: n for r, n in made.items() if len(r) <= CACHED_BYTES}
        out = [made[r] if r in made else self.cache[r] for r in raw]
        if len(self.cache) + len(kept) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update(kept)
        return out


@functools.lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def pretokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the pre-tokens of texts, each without the space that opens it; that of a text's first is not written in the text."""
    n = len(data)
    space = data == _SPACE
    head = np.zeros(n + 1, bool)
    head[off] = True
    head = head[:n]
    cut = data == _NEWLINE
    cut |= head
    cut[1:] |= space[1:] & ~space[:-1]
    cut[:1] |= space[:1]
    at = np.flatnonzero(cut)
    # A text that starts with a line feed has its opening space for itself.
    lone = at[head[at] & (data[at] == _NEWLINE)]
    text = np.searchsorted(off, at, side="right") - 1
    end = np.append(at[1:], n)[: len(at)]
    start = at + (space[at] & ~head[at])
    if len(lone):
        text, start, end = (np.append(a, b) for a, b in ((text, np.searchsorted(off, lone, side="right") - 1), (start, lone), (end, lone)))
    return text, start, end


def _plain(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with written marks as the spaces that they stand for."""
    whole = data.tobytes()
    if MARK not in whole:
        return data, off
    texts = [whole[a:b].replace(MARK, b" ") for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


def _spans(model: Model, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, K.Lanes]:
    if model.cuts:
        data, off = _plain(data, off)
        text, start, end = pretokens(data, off)
    else:
        text = np.flatnonzero(np.diff(off))
        start, end = off[:-1][text], off[1:][text]
    return text, start, end, K.Lanes(data)


def _distinct(lanes: K.Lanes, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct spans, and which of them each is; hashes are confirmed on bytes."""
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    size = end - start
    rep = at[which]
    if not ((size == size[rep]) & lanes.equal(start, start[rep], np.minimum(size, size[rep]))).all():
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(lanes.raw[a:b].tobytes(), len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
        return list(seen), which
    return [lanes.raw[a:b].tobytes() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)], which


def frequent(docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> Frequent:
    """The first tier, from at most about ``rows`` of ``docs`` (doc_id, text): tasks report the most frequent short pre-tokens of their sampled documents."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def report(batch: pa.RecordBatch) -> Iterator[dict]:
        model, seen = load(path), Counter()
        for _, _, data, off in K.slices(batch.column(0)):
            _, start, end, lanes = _spans(model, data, off)
            short = end - start <= SHORT
            start, end = start[short], end[short]
            words, which = _distinct(lanes, start, end, lanes.hash(start, end))
            seen.update(dict(zip(words, np.bincount(which, minlength=len(words)).tolist(), strict=True)))
        top = seen.most_common(REPORTED * batch.num_rows)
        yield {"word": pa.array([w for w, _ in top], pa.binary()), "n": [n for _, n in top]}

    sample = hashed_share(docs, "doc_id", rows).select("text")
    table = sample.mapInArrow(K.mapper(report, schema), "word binary, n long").toArrow()
    total = table.group_by("word").aggregate([("n", "sum")]).sort_by([("n_sum", "descending"), ("word", "ascending")]).slice(0, entries)
    return _table(load(path), total["word"].to_pylist())


def _table(model: Model, words: list[bytes]) -> Frequent:
    size = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(size) - size
    lanes = K.Lanes(np.frombuffer(b"".join(words), np.uint8))
    h = lanes.hash(start, start + size)
    tokens = np.array(model.lengths(words), np.uint8)  # at most three bytes a token short of 16, so it fits
    _, own = np.unique(h, return_index=True)  # of words with one hash only the first is kept: the others are left to the second tier
    low, high = _lanes(lanes, start, size)
    return Frequent(h[own], low[own], high[own], size[own].astype(np.uint8), tokens[own])


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, table: Frequent | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``path`` names a model file that every executor has.

    ``table`` is a first tier made before; without it one is made from a sample of the rows, at the price of reading the texts twice.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, path) if table is None else table)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        model = load(path)
        for a, b, data, off in K.slices(batch.column(1)):
            text, start, end, lanes = _spans(model, data, off)
            h = lanes.hash(start, end)
            n = shared.value.lookup(lanes, start, end - start, h)
            miss = np.flatnonzero(n < 0)
            if len(miss):
                words, which = _distinct(lanes, start[miss], end[miss], h[miss])
                n[miss] = np.array(model.lengths(words), np.int64)[which]
            total = np.zeros(b - a, np.int64)
            np.add.at(total, text, n)
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_bytes": np.diff(off), "n_tokens": total, "over_limit": total > limit}

    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return docs.mapInArrow(K.mapper(rows, schema, lambda: load(path).cache.clear()), ddl)
