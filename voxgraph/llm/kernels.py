"""Vectorised text primitives shared by the operators of this package.

All work on the UTF-8 bytes of an Arrow string column, a bounded slice of
documents at a time, so that memory follows ``CHUNK_BYTES`` (or the longest
single text) and never the size of a partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one kernel call handles; a longer text is a call of its own.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_STEP = _U(0xC2B2AE3D27D4EB4F)
_SEED = _U(0x9E3779B97F4A7C55)
#: Bytes of a span beyond which its hash is left to xxhash, one span at a time.
LONG_SPAN = 256


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


#: Masks that keep the first n bytes of a little-endian lane.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=_U)


class Lanes:
    """Bytes read as overlapping little-endian 64-bit lanes, one at each position, zeros beyond the end."""

    def __init__(self, data: np.ndarray):
        self.raw = np.concatenate([data, np.zeros(8, np.uint8)])
        self.at = np.ndarray((len(data) + 1,), "<u8", self.raw.data, 0, (1,))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of spans: each lane is scrambled into the state of those before it, so that no pattern of bytes cancels out.

        Equal bytes give equal hashes wherever they stand; other bytes do so with a chance of 2**-64.
        """
        start, size = np.asarray(start, np.int64), np.asarray(end, np.int64) - start
        h = mix(_SEED ^ (size.astype(_U) * _STEP) ^ (self.at[start] & _FIRST[np.minimum(size, 8)]))
        more = np.flatnonzero((size > 8) & (size <= LONG_SPAN))
        lane = 1
        while len(more):
            left = size[more] - 8 * lane
            h[more] = mix(h[more] ^ (self.at[start[more] + 8 * lane] & _FIRST[np.minimum(left, 8)]))
            more, lane = more[left > 8], lane + 1
        for i in np.flatnonzero(size > LONG_SPAN).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.raw[start[i] : start[i] + size[i]].tobytes(), seed=int(_SEED) & 0xFFFFFFFF)
        return h

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, other: Lanes | None = None) -> np.ndarray:
        """Whether the spans of these sizes at a, and at b (of the other bytes, if there are others), hold the same bytes."""
        other = other or self
        out = (self.at[a] ^ other.at[b]) & _FIRST[np.minimum(size, 8)] == 0
        more = np.flatnonzero(out & (size > 8) & (size <= LONG_SPAN))
        lane = 1
        while len(more):
            left = size[more] - 8 * lane
            same = (self.at[a[more] + 8 * lane] ^ other.at[b[more] + 8 * lane]) & _FIRST[np.minimum(left, 8)] == 0
            out[more[~same]] = False
            more, lane = more[same & (left > 8)], lane + 1
        for i in np.flatnonzero(out & (size > LONG_SPAN)).tolist():
            out[i] = np.array_equal(self.raw[a[i] : a[i] + size[i]], other.raw[b[i] : b[i] + size[i]])
        return out


def lower_table() -> np.ndarray:
    """Byte table that maps A-Z to a-z and leaves the rest."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
#: Words of anything but space and the controls 9 to 13.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(9, 14)]] = False
#: Words of digits, letters and all that is not ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Words of letters and all that is not ASCII.
ALPHA = ALNUM.copy()
ALPHA[48:58] = False


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets into them) of bounded slices; null is empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[off[at] : off[end]], off[at : end + 1] - off[at]
        at = end


@dataclass
class Words:
    """The words of a slice of texts: document, byte span and 64-bit hash of each."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    docs: int
    lanes: Lanes

    def bounds(self) -> np.ndarray:
        """Offsets of each document's words."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))

    def written(self, first: int, n: int) -> bytes:
        """n words from the given one on, with a zero byte after each but the last."""
        raw = self.lanes.raw
        return b"\0".join([raw[a:b].tobytes() for a, b in zip(self.start[first : first + n].tolist(), self.end[first : first + n].tolist(), strict=True)])


def runs(same: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``same``; runs end at the documents' offsets."""
    n = len(same)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    first = same.copy()
    first[1:] &= ~same[:-1] | cut[1:n]
    last = same.copy()
    last[:-1] &= ~same[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray, lower: bool = True) -> Words:
    if lower:
        data = LOWER[data]
    start, end = runs(table[data], off)
    lanes = Lanes(data)
    doc = np.searchsorted(off, start, side="right") - 1
    return Words(doc, start, end, lanes.hash(start, end), len(off) - 1, lanes)


@dataclass
class Postings:
    """The distinct words of a slice in the order of their hashes, and for each the documents that hold it, with counts."""

    #: A place of each distinct word: its hash, and the span of its bytes.
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Distinct word, document and count of each posting, in the order of words, then documents.
    word: np.ndarray
    doc: np.ndarray
    count: np.ndarray


def postings(w: Words) -> Postings:
    """Words are told apart by their hashes, which are confirmed on their bytes."""
    order = np.argsort(w.hash, kind="stable")
    h, doc, start, end = w.hash[order], w.doc[order], w.start[order], w.end[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    size = end - start
    like = np.flatnonzero(~fresh)
    if not ((size[like] == size[like - 1]) & w.lanes.equal(start[like], start[like - 1], np.minimum(size[like], size[like - 1]))).all():
        # Unlike words of one hash: order them by their bytes too.
        raw = np.array([w.lanes.raw[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)], dtype=object)
        order = np.array(sorted(range(len(h)), key=lambda i: (h[i], raw[i], doc[i])), np.int64)
        h, doc, start, end, raw = h[order], doc[order], start[order], end[order], raw[order]
        fresh[1:] = raw[1:] != raw[:-1]
    word = np.cumsum(fresh) - 1
    new = fresh.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    return Postings(h[fresh], start[fresh], end[fresh], word[at], doc[at], np.diff(np.append(at, len(h))))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k neighbours of ``h`` (order counts); empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.full(n, k, dtype=_U)
    for i in range(k):
        out = (out + h[i : i + n]) * _STEP
        out ^= out >> _U(29)
    return mix(out)


def within(doc: np.ndarray, k: int) -> np.ndarray:
    """Which k neighbours belong to one document."""
    n = len(doc) - k + 1
    return doc[:n] == doc[k - 1 :] if n > 0 else np.zeros(0, bool)


#: Rows of text that one Arrow batch brings to a Python worker.
BATCH_ROWS = 2_000


def small_batches(spark) -> None:
    """Long texts make the usual 10,000 rows of a batch too large for small executors; a session that asks for fewer keeps its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def _trimmed() -> None:
    """Unused memory of this process given back to the machine, where its C library can do that."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def released(batches: Iterator[pa.RecordBatch], after: Callable[[], None] | None = None) -> Iterator[pa.RecordBatch]:
    """The batches; a partition's end gives unused memory back, as Python workers live on."""
    yield from batches
    if after:
        after()
    _trimmed()


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of at least ``size`` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def packed(**arrays: np.ndarray | bytes) -> bytes:
    """Arrays under their names, compressed; ``unpacked`` gives them back."""
    columns = [pa.array([a], pa.large_binary()) if isinstance(a, bytes) else pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), pa.array(a)) for a in arrays.values()]
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(raw: bytes) -> dict[str, np.ndarray | bytes]:
    (batch,) = pa.ipc.open_stream(raw)
    return {n: c[0].as_py() if pa.types.is_large_binary(c.type) else c.flatten().to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def mapper(fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: pa.Schema, after: Callable[[], None] | None = None) -> Callable:
    """For mapInArrow: ``fn`` yields columns by name for one incoming batch; ``after`` runs at a partition's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches, after):
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)], schema=schema
                )

    return run
