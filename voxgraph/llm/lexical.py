"""Ranked lexical search over dual-sorted wavelet trees, one for each shard of documents.

*Index*: a shard holds some megabytes of texts of one task, documents in the
order of their ids, and for every term the documents that hold it with counts.
Shards are rows, made where the texts are read; nothing is shuffled.  Counts and
not impacts are kept, as impacts depend on the whole corpus, which may grow.

*Tree*: a task that loads a shard takes the lists of the asked terms, each in
the order of falling impact, as one sequence of documents: the root of a wavelet
tree.  Every level parts a node's sequence stably by one bit of the document, so
that a term's postings within a range of documents are a stretch of the node and
still begin with the one of greatest impact.

*Search*: a node bounds the score of all its documents by the weighted impacts
at the starts of its terms' stretches.  The nodes of greatest bound are opened
first, many queries and nodes at a time; a leaf is a document, and its bound its
score.  Nodes that cannot beat a query's k-th document, of this or an earlier
shard of the task, are never opened.  The result is exact.

Rows: every row with at least one term is a document, whether its id is null
(last of equal scores), repeated or not; null and empty texts are none, but never
fail.  Every row of the queries is a query of its own, answered under its id;
those without known terms have no rows.  Equal scores go by ascending id, those of
rows that share an id in any order.  Texts of any length are read whole; empty
tables give no rows.  Only ids and texts are read, so that further columns can have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.plans.lineage import cut

#: Bytes of text of a shard, and documents of one at most.
SHARD_BYTES, SHARD_DOCS = 1 << 23, 1 << 16
#: Bytes of query texts that are sent to the executors at once; more queries are so many passes over the index.
QUERY_BYTES = 1 << 22
#: Queries whose nodes are held at once, and nodes that each opens in one step.
TOGETHER, OPENED = 64, 128
_LAST = np.iinfo(np.int64).max


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(filled, terms, body): the index, one row a shard, with its documents that have terms and all their terms counted."""
    schema = pa.schema([("filled", pa.int64()), ("terms", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.gathered(K.released(batches), SHARD_BYTES):
            for a in range(0, batch.num_rows, SHARD_DOCS):
                for one in _shards(batch.slice(a, SHARD_DOCS)):
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(one, schema, strict=True)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "filled long, terms long, body binary")


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
    ids = np.where(known, ids, 0).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    order = np.lexsort((ids, ~known))
    ids, known = ids[order], known[order]
    for a, b, data, off in K.slices(batch.column(1).take(pa.array(order)), 2 * SHARD_BYTES):
        w = K.words(data, off, K.ALNUM)
        p = K.postings(w)
        n = np.diff(w.bounds())
        size = p.end - p.start
        text = b"".join([w.lanes.raw[x:y].tobytes() for x, y in zip(p.start.tolist(), p.end.tolist(), strict=True)])
        body = K.packed(
            ids=ids[a:b], known=known[a:b], n=n, hash=p.hash, stop=np.cumsum(size), bytes=text,
            ptr=np.searchsorted(p.word, np.arange(len(p.hash) + 1)).astype(np.int32), doc=p.doc.astype(np.int32), count=p.count.astype(np.int32),
        )
        yield int((n > 0).sum()), int(n.sum()), body


class Shard:
    """A loaded row of the index."""

    def __init__(self, body: bytes):
        x = K.unpacked(body)
        self.ids, self.known, self.n, self.hash, self.ptr, self.doc, self.count = (x[c] for c in ("ids", "known", "n", "hash", "ptr", "doc", "count"))
        self.stop, self.bytes = x["stop"], x["bytes"]

    def places(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Number of each word in the shard's dictionary, -1 where it has none; hashes are confirmed on bytes."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.hash):
            return out
        at = np.searchsorted(self.hash, hashes)
        for i in np.flatnonzero(self.hash[np.minimum(at, len(self.hash) - 1)] == hashes).tolist():
            j = int(at[i])
            while j < len(self.hash) and self.hash[j] == hashes[i]:
                if self.bytes[(self.stop[j - 1] if j else 0) : self.stop[j]] == words[i]:
                    out[i] = j
                j += 1
        return out


class Queries:
    """Queries as counts of terms, with the terms' own numbers; weights come with the corpus's counts."""

    def __init__(self, texts: list[str | None]):
        self.n = len(texts)
        self.words: list[bytes] = []
        numbers: dict[bytes, int] = {}
        query, term, repeats, hashes = [], [], [], []
        first = 0
        for a, b, data, off in K.slices(pa.array(texts, pa.string())):
            w = K.words(data, off, K.ALNUM)
            p = K.postings(w)
            own = []
            for s, e, h in zip(p.start.tolist(), p.end.tolist(), p.hash.tolist(), strict=True):
                word = w.lanes.raw[s:e].tobytes()
                if word not in numbers:
                    numbers[word] = len(numbers)
                    self.words.append(word)
                    hashes.append(h)
                own.append(numbers[word])
            query.append(p.doc + first)
            term.append(np.array(own, np.int64)[p.word] if len(own) else p.word)
            repeats.append(p.count)
            first += b - a
        none = np.zeros(0, np.int64)
        self.hash = np.array(hashes, np.uint64)
        self.query, self.term, self.repeats = (np.concatenate(x) if x else none for x in (query, term, repeats))
        order = np.lexsort((self.term, self.query))
        self.query, self.term, self.repeats = self.query[order], self.term[order], self.repeats[order]


@dataclass
class Corpus:
    """Documents with terms, all their terms, and for each term of the queries the documents that hold it."""

    filled: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.filled + 2) / (2 * d + 1))) for d in self.holding.tolist()], np.int64)

    def impacts(self, count: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of postings: counts in documents of n terms."""
        if self.terms == 0:
            return np.zeros(len(count), np.int64)
        small = len(n) == 0 or 75 * int(n.max()) * self.filled < 1 << 62
        m = 25 + (75 * n * self.filled) // self.terms if small else np.array([25 + (75 * int(x) * self.filled) // self.terms for x in n.tolist()], np.int64)
        return 1_000_000_000 * count // (1000 * count + 8 * m)


class Tree:
    """The wavelet tree of the postings of some terms of a shard: for each level the zeros before each place, and the impacts in the level's order."""

    def __init__(self, shard: Shard, places: np.ndarray, corpus: Corpus):
        docs = max(1, len(shard.ids))
        self.levels = max(1, (docs - 1).bit_length())
        begin, size = shard.ptr[places].astype(np.int64), (shard.ptr[places + 1] - shard.ptr[places]).astype(np.int64)
        self.start = np.append(0, np.cumsum(size))
        at = np.repeat(begin - self.start[:-1], size) + np.arange(self.start[-1])
        doc, count = shard.doc[at], shard.count[at].astype(np.int64)
        impact = corpus.impacts(count, shard.n[doc])
        order = np.lexsort((doc, -impact, np.repeat(np.arange(len(places)), size)))
        doc, impact = doc[order], impact[order].astype(np.int32)
        p = len(doc)
        self.zeros = np.zeros((self.levels, p + 1), np.int32)
        self.impact = np.zeros((self.levels + 1, max(p, 1)), np.int32)
        self.impact[0, :p] = impact
        for level in range(self.levels):
            bit = (doc >> (self.levels - 1 - level)) & 1 == 1
            np.cumsum(~bit, out=self.zeros[level, 1:])
            doc, impact = np.concatenate([doc[~bit], doc[bit]]), np.concatenate([impact[~bit], impact[bit]])
            self.impact[level + 1, :p] = impact
        self.width = p


class Best:
    """The k best documents of each query so far: falling scores, of equals rising ids, null last."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.zeros((queries, k), np.int64)
        self.id = np.full((queries, k), _LAST)
        self.null = np.ones((queries, k), bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        for q in np.unique(query).tolist():
            own = query == q
            s, i, n = (np.append(old[q], new[own]) for old, new in ((self.score, score), (self.id, ids), (self.null, null)))
            order = np.lexsort((i, n, -s))[: self.k]
            self.score[q], self.id[q], self.null[q] = s[order], i[order], n[order]


def search_shard(shard: Shard, queries: Queries, corpus: Corpus, weights: np.ndarray, best: Best) -> None:
    """Adds the shard's documents to the best ones of every query."""
    places = shard.places(queries.hash, queries.words)
    held = np.flatnonzero(places >= 0)
    if not len(held):
        return
    local = np.full(len(places), -1, np.int64)
    local[held] = np.arange(len(held))
    tree = Tree(shard, places[held], corpus)
    own = np.flatnonzero((local[queries.term] >= 0) & (weights[queries.term] > 0))
    query, term = queries.query[own], local[queries.term[own]]
    weight = weights[queries.term[own]] * queries.repeats[own]
    for q in range(0, queries.n, TOGETHER):
        part = slice(*np.searchsorted(query, [q, q + TOGETHER]))
        _search(tree, shard, query[part], term[part], weight[part], best)


def _search(tree: Tree, shard: Shard, query: np.ndarray, term: np.ndarray, weight: np.ndarray, best: Best) -> None:
    if not len(query):
        return
    zeros, impact, p = tree.zeros.ravel(), tree.impact.ravel(), tree.width
    # Stretches of all nodes that were made: place of start and end, weight.
    a, b, w = tree.start[term], tree.start[term + 1], weight
    head = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    # Open nodes: query, level, number within the level, bound, first stretch and number of stretches.
    nq, first, many = query[head], head, np.diff(np.append(head, len(query)))
    level, number = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
    bound = np.add.reduceat(w * impact[a], head)

    def useful(q: np.ndarray, bound: np.ndarray, level: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Nodes that may hold a document better than their query's k-th."""
        low = best.score[q, -1]
        doc = np.minimum(number << (tree.levels - level), len(shard.ids) - 1)  # the node's least id
        earlier = np.where(best.null[q, -1], shard.known[doc], shard.known[doc] & (shard.ids[doc] < best.id[q, -1]))
        return (bound > low) | ((bound == low) & (low > 0) & earlier)

    while len(nq):
        keep = np.flatnonzero(useful(nq, bound, level, number))
        order = keep[np.lexsort((number[keep] << (tree.levels - level[keep]), -bound[keep], nq[keep]))]
        if not len(order):
            return
        starts = np.flatnonzero(np.append(True, nq[order][1:] != nq[order][:-1]))
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        chosen, rest = order[nth < OPENED], order[nth >= OPENED]
        # Both children of every chosen node: their terms' stretches follow from the zeros before the ends.
        size = many[chosen]
        offset = np.cumsum(size) - size
        at = np.repeat(first[chosen] - offset, size) + np.arange(size.sum())
        lv = np.repeat(level[chosen], size)
        za, zb = zeros[lv * (p + 1) + a[at]].astype(np.int64), zeros[lv * (p + 1) + b[at]].astype(np.int64)
        ones = zeros[lv * (p + 1) + p].astype(np.int64)
        node = np.repeat(np.arange(len(chosen)), size)
        ca, cb = np.concatenate([za, ones + a[at] - za]), np.concatenate([zb, ones + b[at] - zb])
        cw, cn = np.concatenate([w[at], w[at]]), np.concatenate([2 * node, 2 * node + 1])
        some = np.flatnonzero(ca < cb)
        some = some[np.argsort(cn[some], kind="stable")]
        ca, cb, cw, cn = ca[some], cb[some], cw[some], cn[some]
        head = np.flatnonzero(np.append(True, cn[1:] != cn[:-1])) if len(cn) else cn
        of = cn[head]
        cl = level[chosen][of >> 1] + 1
        cq, cnum = nq[chosen][of >> 1], 2 * number[chosen][of >> 1] + (of & 1)
        cbound = np.add.reduceat(cw * impact[np.repeat(cl, np.diff(np.append(head, len(cn)))) * max(p, 1) + ca], head) if len(head) else head
        leaf = cl == tree.levels
        if leaf.any():
            good = np.flatnonzero(leaf & (cbound > 0))
            good = good[useful(cq[good], cbound[good], cl[good], cnum[good])]
            best.add(cq[good], cbound[good], np.where(shard.known[cnum[good]], shard.ids[cnum[good]], _LAST), ~shard.known[cnum[good]])
        stay = np.flatnonzero(~leaf)
        stay = stay[useful(cq[stay], cbound[stay], cl[stay], cnum[stay])]
        # The stretches of nodes that are still open stand after each other again.
        many_c = np.diff(np.append(head, len(cn)))
        pool, sizes = np.concatenate([first[rest], len(a) + head[stay]]), np.concatenate([many[rest], many_c[stay]])
        a, b, w = np.concatenate([a, ca]), np.concatenate([b, cb]), np.concatenate([w, cw])
        if len(a) > 1 << 20 and len(a) > 4 * sizes.sum():
            begin = np.cumsum(sizes) - sizes
            at = np.repeat(pool - begin, sizes) + np.arange(sizes.sum())
            a, b, w, pool = a[at], b[at], w[at], begin
        first, many = pool, sizes
        nq, level, number, bound = (np.concatenate([x[rest], y[stay]]) for x, y in ((nq, cq), (level, cl), (number, cnum), (bound, cbound)))


def _holding(index: DataFrame, queries: Queries) -> np.ndarray:
    """For each term of the queries the documents that hold it: tasks count, one row for each term and task is summed."""
    shared = index.sparkSession.sparkContext.broadcast((queries.hash, queries.words))
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, words = shared.value
        n = np.zeros(len(words), np.int64)
        for batch in K.released(batches):
            for body in batch.column(0):
                shard = Shard(body.as_py())
                places = shard.places(hashes, words)
                held = np.flatnonzero(places >= 0)
                n[held] += shard.ptr[places[held] + 1] - shard.ptr[places[held]]
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], schema=schema)

    got = index.select("body").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # no more rows than a block of queries has terms
    out = np.zeros(len(queries.words), np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out


def _answers(index: DataFrame, queries: Queries, corpus: Corpus, k: int) -> DataFrame:
    """(query, doc_id, score): for each task at most k documents of each query."""
    shared = index.sparkSession.sparkContext.broadcast((queries, corpus, corpus.weights()))
    schema = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, corpus, weights = shared.value
        best = Best(queries.n, k)
        for batch in K.released(batches):
            for body in batch.column(0):
                search_shard(Shard(body.as_py()), queries, corpus, weights, best)
        q, i = np.nonzero(best.score)
        ids = pa.array(best.id[q, i], pa.int64(), mask=best.null[q, i])
        yield pa.RecordBatch.from_arrays([pa.array(q), ids, pa.array(best.score[q, i])], schema=schema)

    return index.select("body").mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text", block_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query with a score above 0."""
    return search_index(cut(shards(docs, id_col, text_col)), queries, k, id_col, query_id, query_text, block_bytes)


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", query_id: str = "item_id", query_text: str = "text", block_bytes: int = QUERY_BYTES) -> DataFrame:
    """As ``search``, of an index that ``shards`` made and that was written.

    Queries come in blocks of bounded bytes, whose number their total size sets; each block is a pass over the index.
    """
    asked = queries.select(F.col(query_id).alias("_id"), F.col(query_text).alias("_text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("_text") + 32), F.lit(0))).first()[0]
    filled, terms = index.agg(F.coalesce(F.sum("filled"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    blocks = max(1, -(-size // block_bytes))
    out = None
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == i).toArrow()
        block = Queries(rows["_text"].to_pylist())
        found = _answers(index, block, Corpus(filled, terms, _holding(index, block)), k)
        names = index.sparkSession.createDataFrame(pa.table({"query": pa.array(np.arange(len(rows))), query_id: rows["_id"]}), f"query long, {query_id} {dict(asked.dtypes)['_id']}")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        one = ranked.join(names, "query").select(query_id, "rank", F.col("doc_id").alias(id_col), "score")
        one = cut(one) if blocks > 1 else one
        out = one if out is None else out.unionByName(one)
    return out
