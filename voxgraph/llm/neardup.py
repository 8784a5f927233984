"""Near duplicates: MinHash signatures in a multi-index Hamming join.

A document's set is its distinct word shingles, each known by a 64-bit hash of
its words.  Texts with equal sets, told by 128 bits over all shingles, are one
*node*.  A signature has ``CHUNKS`` chunks of ``WIDTH`` b-bit symbols.  If two
signatures differ in fewer than ``CHUNKS * (ERRORS + 1)`` symbols, some chunk
differs in at most one; its neighbourhood is enumerated by leaving out each
symbol in turn, so that such a pair shares a key for certain.  Links are
confirmed on the full sets.

Hot keys never make all their pairs.  First each member of a key is compared
with the key's least member, and links become components.  Only keys whose
members are then still in several components are looked at again.  Nodes with
the same chunk are one *cell*; of the cells of such a key the largest is home
to the key, and only members of its other cells, which deviate in one symbol,
are brought there: a node comes once for each chunk and once for each home
that it deviates from, not once for each key.  Signatures and sizes in a home
say who may be linked to another component.  Members that may be linked to a
component of many nodes are held against that component, whose sets are dealt
over blocks of bounded size once; all others are held against each other in
blocks of their home.  Full sets meet inside blocks, and only links that join
components leave them.  So every allowed pair is confirmed, refuted or within
one component already, without a cap and without its row.

Rows: one for each input row; an empty table has none.  Null and empty texts,
or texts without words, have no shingles and are linked with nothing.  A text
of fewer words than a shingle is one shingle as a whole; a text of any length
is read whole.  Repeated rows are one node; rows that repeat an id with another
text are judged by their own texts; a row without an id is never linked.  Of
several least members the smaller id names a component, so there are no ties.
Only the id and text columns are read; others can have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.operators.graph import connected_components
from voxgraph.plans.lineage import by_ids, cut, release

CHUNKS, WIDTH, ERRORS = 10, 5, 1
SYMBOLS = CHUNKS * WIDTH
#: Members of a home whose signatures one block holds on average: about a megabyte.
BLOCK = 8192
#: Members of a home up to which its signatures travel in one row.
SMALL = 64
#: Nodes of a component from which on others are held against the component, and no longer against members in homes.
LARGE = 32
#: Members, and shingles of their sets, that one block holds on average where sets are compared.
SET_BLOCK, BLOCK_SHINGLES = 1024, 200_000

_U = np.uint64
_A = K.mix(np.arange(1, SYMBOLS + 1, dtype=_U)) | _U(1)
_B = K.mix(np.arange(1001, SYMBOLS + 1001, dtype=_U))
_DIGEST = (_U(0x5851F42D4C957F2D), _U(0x2545F4914F6CDD1D))
#: Bytes of a cell: the chunk's number and its symbols.
_CELL = 2 * (WIDTH + 1)


@dataclass(frozen=True)
class Rule:
    """Shingle words, and the similarity as a fraction: linked if den * intersection >= num * union."""

    words: int = 5
    num: int = 80
    den: int = 100

    def distance(self) -> int:
        """Differing symbols beyond which a linked pair is not to be expected (6.5 standard deviations over the mean at the least similarity)."""
        j = self.num / self.den
        return min(SYMBOLS, math.ceil(SYMBOLS * (1 - j) + 6.5 * math.sqrt(SYMBOLS * j * (1 - j))))


def shingles(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of every document's distinct shingles, sorted; offsets of each document's)."""
    w = K.words(data, off, K.SPACED)
    counts = np.diff(w.bounds())
    docs, parts = [], []
    for size in range(1, k + 1):
        own = (counts == size) if size < k else (counts >= k)
        if own.any():
            keep = own[w.doc]
            h, doc = w.hash[keep], w.doc[keep]
            ok = K.within(doc, size)
            docs.append(doc[: len(ok)][ok])
            parts.append(K.grams(h, size)[ok])
    if not docs:
        return np.zeros(0, _U), np.zeros(len(counts) + 1, np.int64)
    doc, h = np.concatenate(docs), np.concatenate(parts)
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order]
    cut_ = np.searchsorted(doc, np.arange(len(counts) + 1))
    for a, b in zip(cut_[:-1].tolist(), cut_[1:].tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(counts) + 1))


def signature(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of symbols, two order-free hashes of the set) for each non-empty set."""
    head = off[:-1][np.diff(off) > 0]
    if not len(head):
        return np.zeros((0, SYMBOLS), np.uint16), np.zeros((2, 0), _U)
    sig = np.empty((len(head), SYMBOLS), np.uint16)
    for i in range(SYMBOLS):
        sig[:, i] = K.mix(np.minimum.reduceat((h ^ _B[i]) * _A[i], head)) >> _U(48)
    return sig, set_digest(h, head)


def set_digest(h: np.ndarray, head: np.ndarray) -> np.ndarray:
    return np.stack([np.add.reduceat(K.mix(h ^ x), head) for x in _DIGEST]) if len(head) else np.zeros((2, 0), _U)


def neighbour_keys(sig: np.ndarray) -> np.ndarray:
    """One row of keys for each signature: every chunk with each of its symbols left out."""
    return np.concatenate([chunk_keys(sig[:, c * WIDTH : (c + 1) * WIDTH], np.full(len(sig), c, _U)) for c in range(CHUNKS)], axis=1)


def chunk_keys(symbols: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """One row of keys for each chunk of the given number: each of its symbols left out."""
    out = np.empty((len(symbols), WIDTH), _U)
    for i in range(WIDTH):
        key = chunk * _U(WIDTH) + _U(i + 1)
        for j in range(WIDTH):
            if j != i:
                key = K.mix(key) ^ symbols[:, j].astype(_U)
        out[:, i] = K.mix(key)
    return out


def _symbols(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _cut_sets(h: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [h[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, da, db, sig) of rows of (doc_id, text); an empty set has no hashes and no signature."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("da", pa.int64()), ("db", pa.int64()), ("sig", pa.binary())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, b, data, off in K.slices(batch.column(1)):
            h, at = shingles(data, off, rule.words)
            n = np.diff(at)
            sig, digest = signature(h, at)
            full = np.flatnonzero(n > 0)
            raw, which = sig.tobytes(), np.full(b - a, -1)
            which[full] = np.arange(len(full))
            size = 2 * SYMBOLS
            every = np.zeros((2, b - a), np.int64)
            every[:, full] = digest.view(np.int64)
            yield {
                "doc_id": batch.column(0).slice(a, b - a),
                "n_shingles": n,
                "da": pa.array(every[0], mask=n == 0),
                "db": pa.array(every[1], mask=n == 0),
                "sig": [None if i < 0 else raw[i * size : (i + 1) * size] for i in which.tolist()],
            }

    return docs.mapInArrow(K.mapper(rows, schema), "doc_id long, n_shingles long, da long, db long, sig binary")


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, node) for every key of every node."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            yield {"key": neighbour_keys(_symbols(part.column(1))).ravel().view(np.int64), "node": np.repeat(part.column(0).to_numpy(), SYMBOLS)}

    return nodes.select("node", "sig").mapInArrow(K.mapper(rows, schema), "key long, node long")


def _met(a: DataFrame, b: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that grow with the documents: sorted and merged, as neither is to be gathered by the driver."""
    return a.join(b.hint("merge"), on, how)


def _close(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Those (x, y) whose sizes and signatures allow a link."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])
    most = rule.distance()

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            ok = (_symbols(part.column(2)) != _symbols(part.column(3))).sum(axis=1) <= most
            yield {"x": part.column(0).to_numpy()[ok], "y": part.column(1).to_numpy()[ok]}

    a = nodes.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("sig").alias("sx"))
    b = nodes.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("sig").alias("sy"))
    fits = F.least("nx", "ny") * rule.den >= F.greatest("nx", "ny") * rule.num
    return _met(_met(pairs, a, "x"), b, "y").where(fits).select("x", "y", "sx", "sy").mapInArrow(K.mapper(rows, schema), "x long, y long")


def full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """(node, set binary) of the wanted nodes, once each, from the text of the least document that has the set."""
    schema = pa.schema([("doc_id", pa.int64()), ("da", pa.int64()), ("db", pa.int64()), ("set", pa.binary())])

    def sets(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, b, data, off in K.slices(batch.column(1)):
            h, at = shingles(data, off, rule.words)
            full = np.flatnonzero(np.diff(at) > 0)
            every = np.zeros((2, b - a), np.int64)
            every[:, full] = set_digest(h, at[:-1][full]).view(np.int64)
            yield {"doc_id": batch.column(0).slice(a, b - a), "da": every[0], "db": every[1], "set": [x.tobytes() for x in _cut_sets(h, at)]}

    named = cut(_met(nodes.select("node", F.col("least").alias("doc_id"), "da", "db"), wanted.select("node").distinct(), "node"))
    made = by_ids(docs, named, "doc_id").mapInArrow(K.mapper(sets, schema), "doc_id long, da long, db long, set binary")
    # An id can stand for several texts, and a row can be repeated.
    return _met(made, named, ["doc_id", "da", "db"]).groupBy("node").agg(F.first("set").alias("set"))


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Those (x, y) that are linked, held against the full sets of both."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ok = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            a, b = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
            both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
            ok[i] = rule.den * both >= rule.num * (len(a) + len(b) - both)
        yield {"x": batch.column(0).to_numpy()[ok], "y": batch.column(1).to_numpy()[ok]}

    sets = full_sets(pairs.select(F.col("x").alias("node")).union(pairs.select("y")), nodes, docs, rule)
    a = sets.select(F.col("node").alias("x"), F.col("set").alias("tx"))
    b = sets.select(F.col("node").alias("y"), F.col("set").alias("ty"))
    return _met(_met(pairs, a, "x"), b, "y").select("x", "y", "tx", "ty").mapInArrow(K.mapper(rows, schema), "x long, y long")


def _cells(nodes: DataFrame) -> DataFrame:
    """(cell, node, comp) for every chunk of every node; a cell is the chunk's number and symbols."""
    schema = pa.schema([("cell", pa.binary()), ("node", pa.int64()), ("comp", pa.int64())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            sig = _symbols(part.column(2))
            chunk = np.broadcast_to(np.arange(CHUNKS, dtype=np.uint16)[:, None], (len(sig), CHUNKS, 1))
            raw = np.ascontiguousarray(np.concatenate([chunk, sig.reshape(-1, CHUNKS, WIDTH)], axis=2))
            ends = pa.array(np.arange(len(sig) * CHUNKS + 1, dtype=np.int32) * _CELL)
            cell = pa.Array.from_buffers(pa.binary(), len(sig) * CHUNKS, [None, ends.buffers()[1], pa.py_buffer(raw.tobytes())])
            yield {"cell": cell, "node": np.repeat(part.column(0).to_numpy(), CHUNKS), "comp": np.repeat(part.column(1).to_numpy(), CHUNKS)}

    return nodes.select("node", "comp", "sig").mapInArrow(K.mapper(rows, schema), "cell binary, node long, comp long")


def _homes(cells: DataFrame) -> DataFrame:
    """(home, cell, key): cells that meet in the home of a key whose members are in several components; the home's own cell has no key.

    A cell deviates from a home in one symbol, so it has one key there.
    """
    schema = pa.schema([("key", pa.int64()), ("cell", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64()), ("size", pa.int64())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            raw = np.frombuffer(b"".join(part.column(0).to_pylist()), np.uint16).reshape(-1, WIDTH + 1)
            which = np.repeat(np.arange(len(raw)), WIDTH)
            yield {"key": chunk_keys(raw[:, 1:], raw[:, 0].astype(_U)).ravel().view(np.int64), **{c: part.column(i).take(pa.array(which)) for i, c in enumerate(("cell", "lo", "hi", "size"))}}

    of_cells = cells.groupBy("cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
    keys = of_cells.mapInArrow(K.mapper(rows, schema), "key long, cell binary, lo long, hi long, size long")
    mixed = keys.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("size").alias("size")).where("lo < hi and size > 2").select("key")
    of_mixed = cut(_met(keys, mixed, "key").select("key", "cell", "size"))
    home = of_mixed.groupBy("key").agg(F.max(F.struct("size", "cell")).alias("top")).select("key", F.col("top.cell").alias("home"))
    met = _met(of_mixed, home, "key")
    return met.select("home", "cell", F.when(F.col("cell") == F.col("home"), None).otherwise(F.col("key")).alias("key")).distinct()


def _dealt(members: DataFrame, blocks: F.Column) -> DataFrame:
    """Members of each home dealt into blocks, one copy for each pair of blocks (i, j) that their own is part of."""
    return (
        members.withColumn("blocks", F.greatest(F.lit(1), F.ceil(blocks)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
        .drop("other", "blocks")
    )


def _asked(nodes: DataFrame, rule: Rule) -> DataFrame:
    """(home, node, large): members that may be linked to a member of another component; with ``large``, to one of that component.

    A pair counts in the first chunk that brings it together.  Pairs are seen within a block and never leave it.
    """
    schema = pa.schema([("home", pa.binary()), ("node", pa.int64()), ("large", pa.int64())])
    ddl = "home binary, node long, large long"
    most = rule.distance()

    def wanted(home: bytes, node: np.ndarray, key: np.ndarray, comp: np.ndarray, many: np.ndarray, n: np.ndarray, sig: np.ndarray) -> list[tuple[int, int]]:
        """``key`` is 0 for the home's own members; ``many`` counts the nodes of each component."""
        chunk = int.from_bytes(home[:2], "little")
        names, of, size = np.unique(comp, return_inverse=True, return_counts=True)
        if len(names) < 2:
            return []
        # Members of the component that has most here wait for the others.
        order = np.argsort(of == size.argmax(), kind="stable")
        node, key, comp, many, n, sig = (x[order] for x in (node, key, comp, many, n, sig))
        small, large = np.zeros(len(node), bool), set()
        for k in range(len(node) - int(size.max())):
            at = k + 1 + np.flatnonzero(comp[k + 1 :] != comp[k])
            at = at[(key[at] == key[k]) | (key[at] == 0) | (key[k] == 0)]
            at = at[np.minimum(n[at], n[k]) * rule.den >= np.maximum(n[at], n[k]) * rule.num]
            differ = sig[at] != sig[k]
            ok = differ.sum(axis=1) <= most
            if chunk:
                ok &= ~(differ[:, : chunk * WIDTH].reshape(len(at), chunk, WIDTH).sum(axis=2) <= ERRORS).any(axis=1)
            at = at[ok]
            for c in np.unique(comp[at]).tolist():
                own = at[comp[at] == c]
                if max(many[k], many[own[0]]) < LARGE:
                    small[k] = True
                    small[own] = True
                elif (many[k], comp[k]) < (many[own[0]], c):
                    large.add((int(node[k]), c))
                else:
                    large.update((i, int(comp[k])) for i in node[own].tolist())
        return [(i, -1) for i in node[small].tolist()] + sorted(large)

    def made(found: list[tuple[bytes, int, int]]) -> dict:
        return {"home": pa.array([f[0] for f in found], pa.binary()), "node": [f[1] for f in found], "large": pa.array([None if f[2] < 0 else f[2] for f in found], pa.int64())}

    def few(batch: pa.RecordBatch) -> Iterator[dict]:
        group = batch.column(1)
        offsets, flat = group.offsets.to_numpy(), group.values
        columns = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(5)]
        sig = _symbols(flat.field(5))
        found = []
        for home, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            found += [(home, *x) for x in wanted(home, *(c[a:b] for c in columns), sig[a:b])]
        yield made(found)

    def block(table: pa.Table) -> pa.Table:
        home = table["home"][0].as_py()
        found = wanted(home, *(table[c].to_numpy() for c in ("node", "key", "comp", "many", "n")), _symbols(table["sig"]))
        return pa.table(made([(home, *x) for x in found]), schema=schema)

    cells = _cells(nodes)
    meets = cut(_homes(cells))
    members = cut(_met(cells.select("cell", "node"), meets, "cell").select("home", "node", F.coalesce("key", F.lit(0)).alias("key")))
    sizes = members.groupBy("home").agg(F.count("*").alias("size")).where("size > 1")
    held = _met(_met(members, sizes, "home"), nodes.select("node", "comp", "many", "n", "sig"), "node")
    # Small groups come many to a batch; of large ones a task holds one block at a time.
    grouped = held.where(F.col("size") <= SMALL).groupBy("home").agg(F.collect_list(F.struct("node", "key", "comp", "many", "n", "sig")).alias("g"))
    blocks = _dealt(held.where(F.col("size") > SMALL), F.col("size") / BLOCK)
    found = grouped.mapInArrow(K.mapper(few, schema), ddl).unionByName(blocks.groupBy("home", "i", "j").applyInArrow(block, ddl))
    return found.withColumn("home", F.when(F.col("large").isNull(), F.col("home"))).distinct()


def _meeting(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all x with all y."""
    both = np.zeros((len(xs), len(ys)), np.float32)
    _, col = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    size = np.array([len(s) for s in (*xs, *ys)])
    row = np.repeat(np.arange(len(size)), size)
    seen = np.zeros((2, int(col.max()) + 1), bool)
    is_y = row >= len(xs)
    seen[is_y.astype(int), col] = True
    shared = seen.all(axis=0)  # what only one side has is in no intersection
    keep = shared[col]
    row, col, is_y = row[keep], (np.cumsum(shared) - 1)[col[keep]], is_y[keep]
    order = np.argsort(col, kind="stable")
    row, col, is_y = row[order], col[order], is_y[order]
    for at in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(col, [at, at + 4096])
        part = np.zeros((len(size), 4096), np.float32)
        part[row[a:b], col[a:b] - at] = 1
        both += part[: len(xs)] @ part[len(xs) :].T
    return both


def _linked(xs: list[np.ndarray], ys: list[np.ndarray], rule: Rule) -> np.ndarray:
    both = _meeting(xs, ys)
    return rule.den * both >= rule.num * (np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys]) - both)


def _forest(sets: list[np.ndarray], comp: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links between components that some pair of the sets confirms, as many as it takes to join those components (at most one less than sets)."""
    out, of = [], comp.copy()
    for x, y in zip(*np.nonzero(np.triu(_linked(sets, sets, rule), 1)), strict=True):
        if of[x] != of[y]:
            out.append((int(x), int(y)))
            of[of == max(of[x], of[y])] = min(of[x], of[y])
    return out


def _between(nodes: DataFrame, comps: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """(x, y): confirmed links that join components which share a key, held against the full sets within blocks of bounded size."""
    asked = cut(_asked(nodes, rule))
    release(docs.sparkSession)
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def load(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), _U) for c in table["set"].chunks for x in c]

    def in_home(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        found = np.array(_forest(load(table), table["comp"].to_numpy(), rule), np.int64).reshape(-1, 2)
        return pa.table({"x": node[found[:, 0]], "y": node[found[:, 1]]}, schema=schema)

    def against_component(table: pa.Table) -> pa.Table:
        is_x = table["asks"].combine_chunks()
        a, b = table.filter(is_x), table.filter(pc.invert(is_x))
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        linked = _linked(load(a), load(b), rule)
        some = linked.any(axis=1)
        return pa.table({"x": a["node"].to_numpy()[some], "y": b["node"].to_numpy()[linked.argmax(axis=1)[some]]}, schema=schema)

    facts = nodes.select("node", "comp", "n")
    small = _met(asked.where("large is null").select("home", "node"), facts, "node")
    held = small.groupBy("home").agg(F.sum("n").alias("total"), F.count("*").alias("size")).where("size > 1")
    blocks = _dealt(small.join(held, "home"), F.greatest(F.col("total") / BLOCK_SHINGLES, F.col("size") / SET_BLOCK)).select("home", "i", "j", "node", "comp")

    def parts(size: F.Column, total: F.Column) -> F.Column:
        return F.greatest(F.lit(1), F.ceil(F.greatest(total / BLOCK_SHINGLES, size / SET_BLOCK))).cast("long")

    asking = _met(asked.where("large is not null").select("node", "large").distinct(), facts.select("node", "n"), "node")
    across = asking.groupBy("large").agg(parts(F.count("*"), F.sum("n")).alias("rows"))
    grid = cut(across.join(comps.withColumnRenamed("comp", "large"), "large").select("large", "rows", parts(F.col("many"), F.col("total")).alias("columns")))
    member = facts.withColumnRenamed("comp", "large")

    def placed(df: DataFrame, own: str, other: str, by: str, asks: bool) -> DataFrame:
        return df.join(grid, "large").select("large", F.pmod(F.xxhash64("node"), F.col(by)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns" if by == "rows" else "rows") - 1)).alias(other), "node", F.lit(asks).alias("asks"))

    cells = cut(placed(asking, "i", "j", "rows", True).unionByName(placed(member, "j", "i", "columns", False)))
    blocks = cut(blocks)
    release(docs.sparkSession)
    sets = full_sets(blocks.select("node").union(cells.select("node")), nodes, docs, rule)
    one = _met(blocks, sets, "node").groupBy("home", "i", "j").applyInArrow(in_home, "x long, y long")
    two = _met(cells, sets, "node").groupBy("large", "i", "j").applyInArrow(against_component, "x long, y long")
    return one.unionByName(two).distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    feats = cut(signatures(docs, rule))
    classes = feats.where("sig is not null and doc_id is not null").groupBy("da", "db", F.col("n_shingles").alias("n")).agg(F.min(F.struct("doc_id", "sig")).alias("r"))
    nodes = cut(classes.select("da", "db", "n", F.col("r.doc_id").alias("least"), F.col("r.sig").alias("sig")).withColumn("node", F.monotonically_increasing_id()))
    keys = _keys(nodes)
    heads = keys.groupBy("key").agg(F.min("node").alias("y"), F.max("node").alias("top")).where("y < top").select("key", "y")
    starred = cut(_met(keys, heads, "key").where("node <> y").select(F.col("node").alias("x"), "y").distinct())
    release(docs.sparkSession)  # once a table is made, what it took goes
    close = cut(_close(starred, nodes, rule))
    release(docs.sparkSession)
    links = cut(confirm(close, nodes, docs, rule))
    release(docs.sparkSession)
    parts = connected_components(links, "x", "y").withColumnRenamed("component", "comp")
    comps = cut(_met(parts, nodes.select("node", "n"), "node").groupBy("comp").agg(F.count("*").alias("many"), F.sum("n").alias("total")))
    placed = _met(nodes, _met(parts, comps.drop("total"), "comp"), "node", "left").withColumns({"comp": F.coalesce("comp", "node"), "many": F.coalesce("many", F.lit(1))})
    placed = cut(placed)
    release(docs.sparkSession)
    # Nodes that share no key with another have no part in the second look.
    met = starred.select(F.col("x").alias("node")).union(starred.select("y")).distinct()
    more = cut(_between(_met(placed, met, "node", "left_semi"), comps, docs, rule))
    release(docs.sparkSession)
    if not more.isEmpty():
        of = placed.select("node", "comp")
        joined = more.join(of.select(F.col("node").alias("x"), F.col("comp").alias("a")), "x").join(of.select(F.col("node").alias("y"), F.col("comp").alias("b")), "y")
        up = connected_components(joined, "a", "b").select(F.col("node").alias("comp"), "component")
        placed = placed.join(up, "comp", "left").withColumn("comp", F.coalesce("component", "comp")).drop("component")
    names = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = _met(placed, names, "comp").select("da", "db", F.col("n").alias("n_shingles"), "component_id")
    own = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return (
        _met(feats.select("doc_id", "n_shingles", "da", "db"), found, ["da", "db", "n_shingles"], "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group of near duplicates; an id with several texts stays if one of them does."""
    judged = near_duplicates(docs, rule, id_col, text_col).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return by_ids(docs, judged.where("not kept").select(F.col("doc_id").alias(id_col)), id_col, "left_anti")
