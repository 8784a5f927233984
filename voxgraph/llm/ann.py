"""Approximate nearest neighbours by inner product.

Vectors are quantised to four bits for each pair of dimensions.  Codebooks and
codes minimise a score-aware, anisotropic loss: the part of the residual that
is parallel to the vector, which shifts its large inner products, costs
``eta`` times the rest.  A query scans codes through tables (one entry for
each byte, that is two codes), and the best ``RERANK`` of a block are scored
exactly, in double precision, on the original vectors.  So is every other unit
of the block that its code does not rule out: one whose score, raised by
``SIGMAS`` standard deviations of what codes leave out, reaches the k-th best.
Where codes tell vectors apart these are few; of near copies they are all.

Equal vectors are one unit with its least ids, as many as a result can need,
so that copies cost nothing and ties go to the smaller id.  A coarse partition
(k-means on the sample) deals units into bins of bounded size, neighbouring
partitions together and large ones over several bins.  The longest vectors,
which are near to many and close to no centre, are a partition that every query
visits.  The number of
partitions is the root of the number of units: where that is more than the
sample can carry, each partition is split by a k-means of its own, one task
each, on rows of that partition alone.  A query goes to the bins
of the partitions whose centres it has the largest inner products with, as many
as hold ``COVER`` of the true neighbours that some queries have in the sample: few where the data have
clusters, all where they have none.  Each bin returns its best, and the best of
the bins are the result.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part; neither do rows without an id.  Shorter vectors are filled up with
zeros.  Rows that repeat an id count once, with the first of their vectors in
the order of components.  An empty table has no results; other columns can have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.llm.sampling import hashed_share
from voxgraph.plans.lineage import cut

#: Vectors on which codebooks are fitted, on average where there are more; every row is indexed.
SAMPLE = 20_000
#: Units of a block that a query scores exactly at least, and standard deviations of the error of a code within which it scores all others.
RERANK, SIGMAS = 200, 3.0
#: Units and queries that meet in one task, on average.
UNIT_BLOCK, QUERY_BLOCK = 16_384, 16_384
#: Partitions of the first level at most, vectors of the sample for each at least, and the share of true neighbours that the probed partitions hold in the sample.
PARTITIONS, PER_PARTITION, COVER = 1_024, 16, 0.98
#: Vectors on which a task splits one partition at most, and bytes of the centres that the splits may have in all, as every task holds them.
SPLIT_ROWS, CENTRE_BYTES = 16_384, 64 << 20
#: Queries on which probes are measured, on average where there are more, and the share of units, the longest, that every query visits.
ASKED, LONGEST = 500, 0.01
_CHUNK = 64


@dataclass(frozen=True)
class Codebooks:
    """``centres[m, k]``: 16 centres of each subspace; dimensions are padded with zeros to an even number of subspaces."""

    centres: np.ndarray
    eta: float

    def padded(self, x: np.ndarray) -> np.ndarray:
        m, _, d = self.centres.shape
        out = np.zeros((len(x), m * d))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), m, d)

    def codes(self, x: np.ndarray, sweeps: int = 3) -> np.ndarray:
        """One code for each subspace, by coordinate descent on the anisotropic loss."""
        return assign(self.padded(x), self.centres, self.eta, sweeps)[0]

    def packed(self, x: np.ndarray) -> np.ndarray:
        c = self.codes(x)
        return (c[:, 0::2] * 16 + c[:, 1::2]).astype(np.uint8)

    def decoded(self, packed: np.ndarray, dims: int) -> np.ndarray:
        """The vectors that codes stand for."""
        codes = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(packed), -1)
        return self.centres[np.arange(codes.shape[1]), codes].reshape(len(packed), -1)[:, :dims]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(query, byte of the code, value of the byte): the two subspaces' share of the inner product."""
        t = np.einsum("qmd,mkd->qmk", self.padded(q), self.centres).astype(np.float32)
        return (t[:, 0::2, :, None] + t[:, 1::2, None, :]).reshape(len(q), t.shape[1] // 2, 256)


def assign(x: np.ndarray, centres: np.ndarray, eta: float, sweeps: int, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, parallel part of each vector's residual)."""
    n, m, _ = x.shape
    norm = np.sqrt((x * x).sum(axis=(1, 2), keepdims=True))
    u = x / np.where(norm > 0, norm, 1)
    if codes is None:
        codes = np.stack([((x[:, j, None, :] - centres[j]) ** 2).sum(axis=2).argmin(axis=1) for j in range(m)], axis=1)
    res = x - centres[np.arange(m), codes]
    along = (res * u).sum(axis=(1, 2))
    for _ in range(sweeps):
        for j in range(m):
            rest = along - (res[:, j] * u[:, j]).sum(axis=1)
            r = x[:, j, None, :] - centres[j]
            loss = (r * r).sum(axis=2) + (eta - 1) * (rest[:, None] + (r * u[:, j, None, :]).sum(axis=2)) ** 2
            codes[:, j] = loss.argmin(axis=1)
            res[:, j] = r[np.arange(n), codes[:, j]]
            along = rest + (res[:, j] * u[:, j]).sum(axis=1)
    return codes, along


def fit(x: np.ndarray, threshold: float = 0.2, rounds: int = 6, seed: int = 7) -> Codebooks:
    """Alternate between codes and the centres that solve the weighted least squares of their members."""
    dims = x.shape[1]
    m = -(-dims // 4) * 2
    eta = max(1.0, (dims - 1) * threshold**2 / (1 - threshold**2))
    padded = np.zeros((len(x), m * 2))
    padded[:, :dims] = x
    x = padded.reshape(len(x), m, 2)
    norm = np.sqrt((x * x).sum(axis=(1, 2), keepdims=True))
    u = x / np.where(norm > 0, norm, 1)
    rng = np.random.default_rng(seed)
    centres = np.stack([x[rng.choice(len(x), 16, replace=len(x) < 16), j] for j in range(m)])
    codes = None
    for _ in range(rounds):
        codes, along = assign(x, centres, eta, 1, codes)
        for j in range(m):
            xj, uj, c = x[:, j], u[:, j], codes[:, j]
            rest = along - ((xj - centres[j][c]) * uj).sum(axis=1)
            outer = uj[:, :, None] * uj[:, None, :]
            want = xj + (eta - 1) * (rest + (xj * uj).sum(axis=1))[:, None] * uj
            for k in range(16):
                own = c == k
                if own.any():
                    a = own.sum() * np.eye(2) + (eta - 1) * outer[own].sum(axis=0)
                    centres[j, k] = np.linalg.solve(a, want[own].sum(axis=0))
                else:
                    centres[j, k] = xj[rng.integers(len(xj))]
            along = rest + ((xj - centres[j][c]) * uj).sum(axis=1)
    return Codebooks(centres, eta)


def _length(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (centres**2).sum(axis=1)
    return np.concatenate([(square - 2 * x[at : at + 4096] @ centres.T).argmin(axis=1) for at in range(0, len(x), 4096)] or [np.zeros(0, int)])


@dataclass(frozen=True)
class Coarse:
    """Centres of the partitions, in an order in which neighbours stand close, and how many of them a query probes.

    With ``tops``, a vector is placed by those first, and then among ``centres[first[t] : first[t + 1]]`` of its top ``t``.
    Vectors longer than ``longest`` are a partition of their own, the last, which all probe.
    """

    centres: np.ndarray
    probes: int
    tops: np.ndarray | None = None
    first: np.ndarray | None = None
    longest: float = np.inf

    def placed(self, x: np.ndarray) -> np.ndarray:
        """Partition of each vector; that of the longest comes after those of the centres."""
        return np.where(_length(x) > self.longest, len(self.centres), self.part(x))

    def part(self, x: np.ndarray) -> np.ndarray:
        if self.tops is None:
            return _closest(x, self.centres)
        top = _closest(x, self.tops)
        order = np.argsort(top, kind="stable")
        out = np.empty(len(x), np.int64)
        for own in np.split(order, np.flatnonzero(np.diff(top[order])) + 1):
            if len(own):
                lo, hi = self.first[top[own[0]]], self.first[top[own[0]] + 1]
                out[own] = lo + _closest(x[own], self.centres[lo:hi])
        return out

    def probed(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(q @ self.centres.T), axis=1, kind="stable")[:, : self.probes]


def k_means(x: np.ndarray, n: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """n centres; along the direction in which they vary most, neighbours come near each other."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), n, replace=False)]
    for _ in range(rounds):
        part = _closest(x, centres)
        size = np.bincount(part, minlength=n)
        total = np.zeros_like(centres)
        np.add.at(total, part, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.choice(len(x), n)])
    middle = centres - centres.mean(axis=0)
    return centres[np.argsort(middle @ np.linalg.svd(middle, full_matrices=False)[2][0], kind="stable")]


def with_probes(coarse: Coarse, x: np.ndarray, k: int, asked: tuple[np.ndarray, np.ndarray] | None = None) -> Coarse:
    """As many probes as find the share ``COVER`` of the neighbours within the sample, which are farther than those among all rows.

    ``asked``: vectors of queries, and where each stands in the sample itself (-1: nowhere).
    """
    coarse = replace(coarse, probes=len(coarse.centres))
    q, own = asked if asked is not None and len(asked[0]) else (x[:ASKED], np.arange(min(ASKED, len(x))))
    part = coarse.placed(x)
    found = []
    for at in range(0, len(q), 64):
        scores = q[at : at + 64] @ x.T
        there = np.flatnonzero(own[at : at + 64] >= 0)
        scores[there, own[at : at + 64][there]] = -np.inf
        most = min(k, max(1, len(x) - 1))
        near = part[np.argpartition(-scores, most - 1, axis=1)[:, :most]]
        place = np.argsort(coarse.probed(q[at : at + 64]), axis=1)  # of each partition among a query's probes
        place = np.concatenate([place, np.zeros((len(place), 1), int)], axis=1)  # all probe the last
        found.append(np.take_along_axis(place, near, axis=1).ravel())
    every = np.sort(np.concatenate(found))
    return replace(coarse, probes=int(every[min(len(every) - 1, int(np.ceil(COVER * len(every))))]) + 1)


def fit_coarse(x: np.ndarray, units: int, k: int, asked: tuple[np.ndarray, np.ndarray] | None = None) -> Coarse:
    """k-means on the sample; the number of partitions follows the root of the number of units, as far as the sample carries it."""
    length = _length(x)
    longest = float(np.quantile(length, 1 - LONGEST, method="higher"))
    n = max(1, min(PARTITIONS, len(x) // PER_PARTITION, int(np.sqrt(units))))
    return with_probes(Coarse(k_means(x[length <= longest], n), n, longest=longest), x, k, asked)


def split(coarse: Coarse, units: DataFrame, n_units: int, x: np.ndarray, k: int, asked: tuple[np.ndarray, np.ndarray] | None = None) -> Coarse:
    """Partitions split until their number is about the root of the number of units, each by one task on its own rows."""
    tops = coarse.centres
    want = min(int(np.sqrt(n_units)), CENTRE_BYTES // tops[0].nbytes)
    if want < 2 * len(tops):
        return coarse
    placing, longest = units.sparkSession.sparkContext.broadcast(tops), coarse.longest

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_length(_vectors(batch.column(1))) <= longest))
            top = pa.array(_closest(_vectors(batch.column(1)), placing.value).astype(np.int32))
            yield pa.RecordBatch.from_arrays([top, batch.column(0), batch.column(1)], names=["top", "first", "v"])

    def centres(table: pa.Table) -> pa.Table:
        table = table.sort_by("first")
        own = _vectors(table["v"])
        made = k_means(own, max(1, len(own) // PER_PARTITION))
        return pa.table({"top": pa.array([table["top"][0].as_py()] * len(made), pa.int32()), "nth": pa.array(range(len(made)), pa.int32()), "centre": pa.array(list(made), pa.list_(pa.float64()))})

    rows = hashed_share(units.select(F.col("ids")[0].alias("first"), "v"), "first", want * PER_PARTITION, n_units)
    dealt = rows.mapInArrow(placed, "top int, first long, v array<double>")
    nth = Window.partitionBy("top").orderBy(F.xxhash64("first"), "first")
    dealt = dealt.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= SPLIT_ROWS).drop("nth")
    made = dealt.groupBy("top").applyInArrow(centres, "top int, nth int, centre array<double>").orderBy("top", "nth").toArrow()  # at most ``want`` rows and one a top
    top, found = made["top"].to_numpy(), _vectors(made["centre"])
    parts = [found[top == t] if (top == t).any() else tops[t : t + 1] for t in range(len(tops))]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return with_probes(replace(coarse, centres=np.concatenate(parts), tops=tops, first=first), x, k, asked)


def bins(sizes: np.ndarray) -> list[tuple[int, int]]:
    """(first bin, number of bins) of each partition: neighbours share a bin while they fit, large ones have several of their own."""
    out, at, room = [], -1, 0
    for size in sizes.tolist():
        if size > room:
            own = max(1, -(-size // UNIT_BLOCK))
            out.append((at + 1, own))
            at, room = at + own, UNIT_BLOCK - size if own == 1 else 0
        else:
            out.append((at, 1))
            room -= size
    return out


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, one for each id, all of one length."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where(good)
    least, most = v.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if least != most:
        v = v.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(most) - F.size("v"))))
    return v.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``."""
    spark = rows.sparkSession
    points = cut(usable(rows, id_col, vector_col))
    by_id = Window.partitionBy("v").orderBy("vec_id")
    least = points.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
    units = cut(least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    queries = points.where(F.col("vec_id") % every == 0)
    n_units = units.count()
    sampled = hashed_share(units.select(F.col("ids")[0].alias("first"), "v"), "first", SAMPLE, n_units).orderBy("first").toArrow()
    sample, first = _vectors(sampled["v"]), sampled["first"].to_numpy()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = hashed_share(queries, "vec_id", ASKED).orderBy("vec_id").toArrow()
    at = np.minimum(np.searchsorted(first, some["vec_id"].to_numpy()), len(first) - 1)
    asked = _vectors(some["v"]), np.where(first[at] == some["vec_id"].to_numpy(), at, -1)
    books = spark.sparkContext.broadcast((fit(sample), split(fit_coarse(sample, n_units, k, asked), units, n_units, sample, k, asked)))

    def with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, coarse = books.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _vectors(part.column(0))
                code = pa.array([c.tobytes() for c in book.packed(x)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), code, pa.array(coarse.placed(x).astype(np.int32))], names=["v", "ids", "code", "part"])

    coded = cut(units.mapInArrow(with_codes, "v array<double>, ids array<long>, code binary, part int"))
    sizes = np.zeros(len(books.value[1].centres) + 1, np.int64)
    for part, n in coded.groupBy("part").count().collect():  # one row a partition, see CENTRE_BYTES
        sizes[part] = n
    where = bins(sizes)
    always = [len(where) - 1] if sizes[-1] else []

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, own = np.array(where).T
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                asked = [np.unique(np.concatenate([np.arange(first[p], first[p] + own[p]) for p in (*probed, *always)])) for probed in books.value[1].probed(_vectors(part.column(1)))]
                rows_ = pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in asked]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(asked).astype(np.int32)), part.column(0).take(rows_), part.column(1).take(rows_)], names=["a", "query_id", "v"])

    routes = cut(queries.select(F.col("vec_id").alias("query_id"), "v").mapInArrow(routed, "a int, query_id long, v array<double>"))
    down = routes.groupBy("a").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("down"))
    of_part = spark.createDataFrame([(i, *w) for i, w in enumerate(where)], "part int, bin int, own int")
    side_a = (
        coded.join(F.broadcast(of_part), "part")  # one row a partition
        .withColumn("a", (F.col("bin") + F.pmod(F.xxhash64(F.col("ids")[0]), F.col("own").cast("long"))).cast("int"))
        .join(down, "a")
        .select("a", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("b"), F.lit(None).cast("long").alias("query_id"), "v", "ids", "code")
    )
    side_b = routes.join(down, "a").select(
        "a", F.pmod(F.xxhash64("query_id"), F.col("down").cast("long")).cast("int").alias("b"), "query_id", "v", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("binary").alias("code"),
    )
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def cell(table: pa.Table) -> pa.Table:
        is_query = np.array(table["query_id"].is_valid())
        asked, held = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        x, q = _vectors(held["v"]), _vectors(asked["v"])
        book = books.value[0]
        packed = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(x), -1)
        codes = packed.T.astype(np.intp)
        ids, qid = held["ids"].to_pylist(), asked["query_id"].to_numpy()
        first = np.array([i[0] for i in ids])
        # What the codes leave out: its length for each unit, and how its directions spread.
        rest = x - book.decoded(packed, x.shape[1])
        far = _length(rest)
        rest /= np.where(far > 0, far, 1)[:, None]
        spread = rest.T @ rest / len(x)
        out_q, out_v, out_s = [], [], []
        for at in range(0, len(q), _CHUNK):
            long = _length(q[at : at + _CHUNK])
            u = q[at : at + _CHUNK] / long[:, None]
            tables = book.tables(u)
            rough = np.zeros((tables.shape[0], len(x)), np.float32)
            for byte, code in enumerate(codes):
                rough += tables[:, byte].take(code, axis=1)
            most = min(max(rerank, k + 1), len(x))
            best = np.argpartition(-rough, most - 1, axis=1)[:, :most]
            error = SIGMAS * np.sqrt(np.maximum(((u @ spread) * u).sum(axis=1), 0))
            rounding = 1e-5 * np.abs(rough).max(axis=1)
            for i, own in enumerate(best):
                exact = x[own] @ q[at + i]
                if most < len(x):
                    reach = np.partition(exact, most - k - 1)[most - k - 1] / long[i] - rounding[i]
                    open_ = rough[i] + far * error[i] >= reach
                    open_[own] = True
                    own = np.flatnonzero(open_)
                    exact = x[own] @ q[at + i] if 4 * len(own) < len(x) else (x @ q[at + i])[own]
                order = np.lexsort((first[own], -exact))[: k + 1]
                me = qid[at + i]
                found = sorted((-exact[j], v) for j in order.tolist() for v in ids[own[j]] if v != me)[:k]
                out_q += [me] * len(found)
                out_v += [v for _, v in found]
                out_s += [-s for s, _ in found]
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], schema=schema)

    best = side_a.unionByName(side_b).groupBy("a", "b").applyInArrow(cell, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
