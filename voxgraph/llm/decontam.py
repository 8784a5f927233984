"""Benchmark decontamination by winnowing.

A *window* is ``span`` consecutive words of a benchmark item (the whole item if
it has fewer, but not none).  The fingerprint of a window is the least hash of
its ``k``-grams, so a document and an item that share a window share that
fingerprint, wherever the window stands: every shared span of ``span`` words
is found.  Documents whose fingerprints meet the benchmark's are extended to
whole windows, which are compared word by word, and the words inside matching
windows are hit.

Rows: one for each input row.  Null and empty texts have no words and are
never hit; items without words have no window; an empty benchmark hits
nothing, an empty table has no rows.  A row is judged by its own text alone, so
that repeated rows are judged alike, and rows that repeat an id with another
text, or have no id, by their own.  An item may repeat another's windows or
name; rows that repeat an item's name are one item.  Texts of any length are
read whole.  Only the id and text columns are read, so further columns can have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K

#: Benchmarks of more windows, or of windows with more bytes, are joined by a shuffle instead of being sent to every executor.
BROADCAST_WINDOWS, BROADCAST_BYTES = 400_000, 1 << 26
_TABLE_BITS = 20
_NO_ITEMS = hashlib.sha256(b"").hexdigest()


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n = len(g) - width + 1
    out = g[:n].copy()
    for i in range(1, width):
        np.minimum(out, g[i : i + n], out=out)
    return out


def fingerprints(h: np.ndarray, doc: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions at which a window of one document starts, fingerprint of each)."""
    at = np.flatnonzero(K.within(doc, length))
    if not len(at):
        return at, np.zeros(0, np.uint64)
    k = min(k, length)
    return at, _least(K.grams(h, k), length - k + 1)[at]


def windows(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the windows that start at the given words."""
    if not len(at):
        return np.zeros(0, np.uint64)
    return K.grams(h[at[:, None] + np.arange(length)].ravel(), length)[::length].copy() if length > 1 else K.grams(h[at], 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = 10, k: int = 5) -> DataFrame:
    """(item_id string, length int, gate long, win long, words binary): every window of every item, each once."""
    schema = pa.schema([("item_id", pa.string()), ("length", pa.int32()), ("gate", pa.int64()), ("win", pa.int64()), ("words", pa.binary())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = np.asarray(batch.column(0).to_pylist(), dtype=object)
        for a, _, data, off in K.slices(batch.column(1)):
            w = K.words(data, off, K.ALNUM)
            counts = np.diff(w.bounds())
            for length in range(1, span + 1):
                own = np.flatnonzero(((counts == length) if length < span else (counts >= span))[w.doc])
                h, doc = w.hash[own], w.doc[own]
                at, gate = fingerprints(h, doc, length, k)
                if len(at):
                    written = [w.written(i, length) for i in own[at].tolist()]
                    yield {"item_id": ids[a + doc[at]], "length": np.full(len(at), length, np.int32), "gate": _signed(gate), "win": _signed(windows(h, at, length)), "words": pa.array(written, pa.binary())}

    found = items.select(F.col(id_col).cast("string"), F.col(text_col)).where(F.col(id_col).isNotNull())
    return found.mapInArrow(K.mapper(rows, schema), "item_id string, length int, gate long, win long, words binary").distinct()


class _Index:
    """The benchmark's windows, sorted by their hashes, with the items of each by its words."""

    def __init__(self, table: pa.Table, k: int):
        self.k = k
        names, item = np.unique(np.asarray(table["item_id"].to_pylist(), dtype=object), return_inverse=True) if len(table) else (np.zeros(0, object), np.zeros(0, np.int64))
        self.names = names
        self.items: dict[bytes, list[int]] = {}
        for words, i in zip(table["words"].to_pylist(), item.tolist(), strict=True):
            self.items.setdefault(words, []).append(i)
        length, gate, win = (table[c].to_numpy() for c in ("length", "gate", "win"))
        self.by_length = {}
        for n in np.unique(length):
            own = length == n
            g = np.unique(gate[own].view(np.uint64))
            seen = np.zeros(1 << _TABLE_BITS, dtype=bool)
            seen[(g & np.uint64(len(seen) - 1)).astype(np.int64)] = True
            self.by_length[int(n)] = (seen, g, np.unique(win[own].view(np.uint64)))

    def hits(self, w: K.Words) -> Iterator[tuple[int, np.ndarray, list[list[int]]]]:
        """(length, word positions of windows that the benchmark has, items of each)."""
        for length, (seen, gates, keys) in self.by_length.items():
            at, gate = fingerprints(w.hash, w.doc, length, self.k)
            at = at[maybe] if len(maybe := np.flatnonzero(seen[(gate & np.uint64(len(seen) - 1)).astype(np.int64)])) else at[:0]
            at = at[_member(gates, gate[maybe])]
            at = at[_member(keys, windows(w.hash, at, length))]
            items = [self.items.get(w.written(i, length)) for i in at.tolist()]
            if any(items):
                yield length, at[[x is not None for x in items]], [x for x in items if x is not None]


def _member(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys) or not len(x):
        return np.zeros(len(x), bool)
    i = np.searchsorted(keys, x)
    return keys[np.minimum(i, len(keys) - 1)] == x


def _covered(at: list[np.ndarray], length: list[int], n: int) -> np.ndarray:
    """Which of n words lie in some window."""
    step = np.zeros(n + 1, dtype=np.int32)
    for a, size in zip(at, length, strict=True):
        np.add.at(step, a, 1)
        np.add.at(step, a + size, -1)
    return np.cumsum(step[:-1]) > 0


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("item_ids", pa.list_(pa.string()))])
_DDL = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>"


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 10, k: int = 5, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids (sorted as strings)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bench = benchmark_windows(items, span=span, k=k).persist(StorageLevel.DISK_ONLY)
    n, size = bench.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    if n <= broadcast_windows and size <= BROADCAST_BYTES:
        table = bench.toArrow()
        bench.unpersist()
        return _by_broadcast(docs, table, k)
    return _by_join(docs, bench, k)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", span: int = 10, k: int = 5, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The rows of ``docs`` whose texts hold no window of an item, with all their columns.

    Each row is judged by its text, whatever its id: rows without an id, or that share one with a hit text, stay if they are clean.
    """
    bench = benchmark_windows(items, span=span, k=k).persist(StorageLevel.DISK_ONLY)
    n, size = bench.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    if n > broadcast_windows or size > BROADCAST_BYTES:
        known = docs.withColumn("_of", F.unhex(F.sha2(text_col, 256)))
        met = _met(known.select(F.col("_of").alias("of"), F.col(text_col).alias("text")), bench, k)[0]
        return known.join(met.select(F.col("of").alias("_of")).distinct(), "_of", "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(bench.toArrow())
    bench.unpersist()
    column = docs.columns.index(text_col)
    made: list[_Index] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.released(batches):
            if not made:
                made.append(_Index(shared.value, k))
            for a, b, data, off in K.slices(batch.column(column)):
                w = K.words(data, off, K.ALNUM)
                keep = np.ones(b - a, bool)
                for _, at, _ in made[0].hits(w):
                    keep[w.doc[at]] = False
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _by_broadcast(docs: DataFrame, table: pa.Table, k: int) -> DataFrame:
    """One pass over the documents, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    made: list[_Index] = []

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        if not made:
            made.append(_Index(shared.value, k))
        index = made[0]
        for a, b, data, off in K.slices(batch.column(1)):
            w = K.words(data, off, K.ALNUM)
            bounds = w.bounds()
            found = list(index.hits(w))
            hit = _covered([f[1] for f in found], [f[0] for f in found], len(w.doc))
            cum = np.append(0, np.cumsum(hit))
            own: list[set[int]] = [set() for _ in range(b - a)]
            for _, at, of in found:
                for doc, x in zip(w.doc[at].tolist(), of, strict=True):
                    own[doc].update(x)
            lists = [list(index.names[sorted(x)]) for x in own]
            n_hit = cum[bounds[1:]] - cum[bounds[:-1]]
            yield {
                "doc_id": batch.column(0).slice(a, b - a),
                "n_words": np.diff(bounds),
                "n_hit": n_hit,
                "n_items": [len(x) for x in lists],
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() if x else _NO_ITEMS for x in lists],
                "contaminated": n_hit > 0,
                "item_ids": lists,
            }

    return docs.mapInArrow(K.mapper(rows, _SCHEMA), _DDL)


def _met(known: DataFrame, bench: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(of, pos, length, list): windows of texts that the benchmark has, and (length, words, items, list): the items of each.

    ``known`` has (of, text): each text is expanded once, however many copies it has.
    """
    lengths = sorted(r[0] for r in bench.select("length").distinct().collect())  # at most span of them
    known = known.where("of is not null").dropDuplicates(["of"])

    def prints(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, _, data, off in K.slices(batch.column(1)):
            w = K.words(data, off, K.ALNUM)
            for length in lengths:
                at, gate = fingerprints(w.hash, w.doc, length, k)
                new = np.ones(len(at), bool)
                new[1:] = (gate[1:] != gate[:-1]) | (w.doc[at][1:] != w.doc[at][:-1])
                yield {"of": batch.column(0).take(pa.array(a + w.doc[at][new])), "gate": _signed(gate[new])}

    def spans(batch: pa.RecordBatch) -> Iterator[dict]:
        gates = batch.column(2)
        for a, _, data, off in K.slices(batch.column(1)):
            w = K.words(data, off, K.ALNUM)
            bounds = w.bounds()
            wanted = np.unique(gates.slice(a, len(off) - 1).flatten().to_numpy().view(np.uint64))
            for length in lengths:
                at, gate = fingerprints(w.hash, w.doc, length, k)
                at = at[_member(wanted, gate)]
                yield {"of": batch.column(0).take(pa.array(a + w.doc[at])), "pos": at - bounds[w.doc[at]], "length": np.full(len(at), length, np.int32), "words": pa.array([w.written(i, length) for i in at.tolist()], pa.binary())}

    digest = pa.binary()
    fps = known.mapInArrow(K.mapper(prints, pa.schema([("of", digest), ("gate", pa.int64())])), "of binary, gate long")
    wanted = fps.join(bench.select("gate").distinct(), "gate", "left_semi").groupBy("of").agg(F.collect_set("gate").alias("gates"))
    wins = known.join(wanted, "of").mapInArrow(
        K.mapper(spans, pa.schema([("of", digest), ("pos", pa.int64()), ("length", pa.int32()), ("words", pa.binary())])), "of binary, pos long, length int, words binary"
    )
    lists = bench.groupBy("length", "words").agg(F.array_sort(F.collect_set("item_id")).alias("items")).withColumn("list", F.md5(F.to_json("items")))
    return wins.join(lists.select("length", "words", "list"), ["length", "words"]), lists


def _by_join(docs: DataFrame, bench: DataFrame, k: int) -> DataFrame:
    """For a benchmark of any size: fingerprints meet in a shuffled join, and only texts that meet one are extended.

    Texts are known by their digests, so that copies are extended alike and a row's id plays no part.  Windows that the
    same items have share one list of them, which a text joins once, however many of those windows it holds.
    """
    docs = docs.withColumn("of", F.unhex(F.sha2("text", 256)))

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, b, data, off in K.slices(batch.column(2)):
            yield {"doc_id": batch.column(0).slice(a, b - a), "of": batch.column(1).slice(a, b - a), "n_words": np.diff(K.words(data, off, K.ALNUM).bounds())}

    met, lists = _met(docs.select("of", "text"), bench, k)
    ends = met.groupBy("of", "pos").agg(F.max(F.col("pos") + F.col("length")).alias("to"))
    # A document's intervals are no more than its own words: they are united in order of their starts.
    united = ends.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("pos", "to"))).alias("s")).select(
        "of",
        F.aggregate(
            "s",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
            lambda acc, x: F.struct((acc.n + F.greatest(F.lit(0), x.to - F.greatest(x.pos, acc.to))).alias("n"), F.greatest(acc.to, x.to).alias("to")),
            lambda acc: acc.n,
        ).alias("n_hit"),
    )
    distinct_lists = lists.groupBy("list").agg(F.first("items").alias("items"))
    items = met.select("of", "list").distinct().join(distinct_lists, "list").groupBy("of").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    total = docs.select("doc_id", "of", "text").mapInArrow(K.mapper(count, pa.schema([("doc_id", pa.int64()), ("of", pa.binary()), ("n_words", pa.int64())])), "doc_id long, of binary, n_words long")
    none = F.expr("cast(array() as array<string>)")
    return total.join(united.join(items, "of"), "of", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.when(F.col("item_ids").isNull(), F.lit(0)).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("item_ids", none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("item_ids", none).alias("item_ids"),
    )
