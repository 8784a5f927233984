"""Source divergence audit: how the words of each source of a language differ from those of the others.

*Counts* are made where texts are read, and only sums over some megabytes of text
are shuffled: first the documents of a language that hold a term, which say what
terms are kept, then the occurrences of kept terms by language and source.  The
kept terms are sent to all tasks if they are few by count and bytes; else all
terms are counted and joined with them.

*Cells*: the groups (language, source) of a language are dealt to cells of some
groups each, and the kept terms to blocks by their hashes; a cell's counts in a
block are one compressed row, a pack, of bounded size.  Divergences are sums over
terms, so that blocks are independent.

*Rotation*: packs are placed once by their key, in an exchange that all rounds
reuse, and stay there while their peers come to them: in each round of a round-robin tournament (one cell stands, the others move
on by one place) every cell meets one other, and the pack of the later one is sent
to the earlier, where both directions of every pair of groups are taken from one
meeting.  With C cells that are C - 1 rounds, and every pair of cells meets once.
Pairs within a cell are met at home, where the language's own counts come by too
and a local heap keeps the terms of each group that stand out most.

All numbers are integers, and results exact.

Rows: each row is a document of its language and source, repeated or without id
or not; null text, language and source are ''.  A group without kept terms has an
empty vector and takes part; a language with one source has no pairs; empty tables
give no rows.  Ranks are unique: of equal values the item that comes first in
UTF-8.  Texts of any length are read whole.  Only text, lang and source are read,
so that further columns can have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.plans.lineage import cut

#: Bytes of text whose counts a task sums before it gives them on, and bytes that are counted at a time.
GATHER_BYTES, SLICE_BYTES = 1 << 24, 1 << 21
#: Kept terms, and bytes of them, up to which they are sent to every executor.
SENT_TERMS, SENT_BYTES = 2_000_000, 1 << 25
#: Groups of a cell at least, cells of a language at most, and counts of a pack (groups by terms) at most, about.
CELL_GROUPS, MAX_CELLS, PACK_COUNTS = 8, 64, 1 << 20
#: Terms stand in the audit if so many documents of their language hold them; added to every count; unit of the shares.
LEAST_DOCS, PRIOR, UNIT = 30, 5, 1_000_000_000
_PACK = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("cell", pa.int32()), ("body", pa.binary())])
_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])
_TERMS = pa.schema([("lang", pa.string()), ("g", pa.int64()), ("item", pa.string()), ("value", pa.int64())])


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), three digits at a time, so that nothing overflows."""
    rest, whole = np.asarray(count, np.int64) + PRIOR, int(total) + PRIOR * int(terms)
    out = np.zeros(len(rest), np.int64)
    for _ in range(3):
        rest = rest * 1000
        digit = rest // whole
        out, rest = out * 1000 + digit, rest - digit * whole
    return out + 1


class Kept:
    """The kept terms of each language in the order of their hashes."""

    def __init__(self, table: pa.Table):
        self.of: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, K.Lanes]] = {}
        for lang in table["lang"].unique().to_pylist():
            words = [t.encode() for t in table.filter(pc.equal(table["lang"], lang))["term"].to_pylist()]
            lanes = K.Lanes(np.frombuffer(b"".join(words), np.uint8))
            size = np.fromiter(map(len, words), np.int64, len(words))
            start = np.cumsum(size) - size
            h = lanes.hash(start, start + size)
            order = np.argsort(h, kind="stable")
            self.of[lang] = h[order], start[order], size[order], lanes

    def holds(self, lang: str, p: K.Postings, lanes: K.Lanes) -> np.ndarray:
        """Which of the distinct words are kept in the language: found by hash, confirmed on bytes."""
        out = np.zeros(len(p.hash), bool)
        if lang not in self.of:
            return out
        hashes, start, size, own = self.of[lang]
        at = np.searchsorted(hashes, p.hash)
        open_ = np.flatnonzero((at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == p.hash))
        while len(open_):
            i = at[open_]
            same = size[i] == (p.end - p.start)[open_]
            out[open_] |= same & lanes.equal(p.start[open_], start[i], np.where(same, size[i], 0), own)
            at[open_] += 1  # terms with one hash stand next to each other
            more = ~out[open_] & (at[open_] < len(hashes))
            open_ = open_[more]
            open_ = open_[hashes[at[open_]] == p.hash[open_]]
        return out


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])


def _sums(batch: pa.RecordBatch, kept: Kept | None) -> pa.Table:
    """(lang, source, term, tf, df) of a batch of (lang, source, text)."""
    lang, source = (batch.column(i).dictionary_encode() for i in range(2))
    langs, n_sources = lang.dictionary.to_pylist(), len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
    parts = []
    for a, _, data, off in K.slices(batch.column(2), SLICE_BYTES):
        w = K.words(data, off, K.ALPHA)
        p = K.postings(w)
        if not len(p.word):
            continue
        key, count = group[a + p.doc] * len(p.hash) + p.word, p.count
        if kept:
            row = lang.indices.to_numpy()[a + p.doc]
            good = np.zeros(len(key), bool)
            for i in np.unique(row).tolist():
                own = row == i
                good[own] = kept.holds(langs[i], p, w.lanes)[p.word[own]]
            key, count = key[good], count[good]
            if not len(key):
                continue
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        tf, df = np.add.reduceat(count[order], head), np.diff(np.append(head, len(key)))
        g, word = np.divmod(key[head], len(p.hash))
        used, word = np.unique(word, return_inverse=True)
        text = [w.lanes.raw[x:y].tobytes() for x, y in zip(p.start[used].tolist(), p.end[used].tolist(), strict=True)]
        names = pa.array(text, pa.binary()).cast(pa.string())
        columns = [lang.dictionary.take(pa.array(g // n_sources)), source.dictionary.take(pa.array(g % n_sources)), names.take(pa.array(word)), pa.array(tf), pa.array(df)]
        parts.append(pa.Table.from_arrays(columns, schema=_COUNTS))
    if len(parts) < 2:
        return parts[0] if parts else _COUNTS.empty_table()
    return pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("tf", "sum"), ("df", "sum")]).select(["lang", "source", "term", "tf_sum", "df_sum"]).rename_columns(_COUNTS.names)


def group_counts(docs: DataFrame, kept: pa.Table | None = None) -> DataFrame:
    """(lang, source, term, tf, df): occurrences, and documents with the term, of each group; of kept terms (lang, term) only, if they are given."""
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else Kept(shared.value)
        for batch in K.gathered(K.released(batches), GATHER_BYTES):
            yield from _sums(batch, own).combine_chunks().to_batches(max_chunksize=50_000)

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, tf long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _packs(entries: DataFrame) -> DataFrame:
    """(lang, block, cell, body): the counts of a cell's groups in a block, groups and terms by number; rows without a term only name their group."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        g, no, tf, n, v = (rows[c].to_numpy() for c in ("g", "no", "tf", "n", "v"))
        groups, first = np.unique(g, return_index=True)
        some = no >= 0
        order = np.lexsort((no[some], g[some]))
        ptr = np.searchsorted(g[some][order], np.append(groups, np.iinfo(np.int64).max))
        body = K.packed(groups=groups, total=n[first], v=v[first], size=rows["size"].to_numpy()[:1], ptr=ptr, no=no[some][order].astype(np.int32), tf=tf[some][order])
        return pa.Table.from_pylist([{"lang": key[0].as_py(), "block": key[1].as_py(), "cell": key[2].as_py(), "body": body}], _PACK)

    return entries.groupBy("lang", "block", "cell").applyInArrow(pack, "lang string, block int, cell int, body binary")


class Pack:
    """Shares of some groups in a block of terms, as a matrix."""

    def __init__(self, body: bytes):
        x = K.unpacked(body)
        self.groups, self.no, self.ptr = x["groups"], x["no"], x["ptr"]
        self.p = np.zeros((len(self.groups), int(x["size"][0])), np.int64)
        for i, (n, v) in enumerate(zip(x["total"].tolist(), x["v"].tolist(), strict=True)):
            if self.p.shape[1]:
                own = slice(self.ptr[i], self.ptr[i + 1])
                self.p[i] = shares(np.zeros(1, np.int64), n, v)[0]
                self.p[i, self.no[own]] = shares(x["tf"][own], n, v)


def _met(lang: str, here: Pack, there: Pack | None) -> dict:
    """Both directions of every pair of a meeting of two packs, or of the pairs within one."""
    a, b, value = [], [], []
    for i in range(len(here.groups)):
        j = 0 if there is not None else i + 1
        other = here if there is None else there
        d = np.abs(other.p[j:] - here.p[i]).sum(axis=1)
        a += [np.full(len(d), here.groups[i]), other.groups[j:]]
        b += [other.groups[j:], np.full(len(d), here.groups[i])]
        value += [d, d]
    a, b, value = (np.concatenate(x) for x in (a, b, value))
    return {"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value}


def _home(packs: DataFrame) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for lang, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield _met(lang, Pack(body.as_py()), None)

    return packs.select("lang", "body").mapInArrow(K.mapper(rows, _PAIRS), "lang string, a long, b long, value long")


def _round(packs: DataFrame, at: int, cells: int) -> DataFrame:
    """One round: of each two cells that meet, the later one's packs go to the earlier one's."""
    turn = cells - 1
    other = F.pmod(F.lit(2 * at) - F.col("cell"), F.lit(turn))
    partner = F.when(F.col("cell") == turn, F.lit(at)).when(other == F.col("cell"), F.lit(turn)).otherwise(other)
    guests = packs.withColumn("_to", partner.cast("int")).where("_to < cell").select("lang", "block", F.col("_to").alias("cell"), F.col("body").alias("guest"))

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for lang, body, guest in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            yield _met(lang, Pack(body.as_py()), Pack(guest.as_py()))

    meeting = packs.join(guests.hint("merge"), ["lang", "block", "cell"]).select("lang", "body", "guest")
    return meeting.mapInArrow(K.mapper(rows, _PAIRS), "lang string, a long, b long, value long")


def _standing_out(packs: DataFrame, own: DataFrame, top: int) -> DataFrame:
    """(lang, g, item, value): of each group's terms in a block those that exceed the language's share most, by a local heap."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for lang, body, terms, counts, n, v in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in range(1, 6)), strict=True):
            pack, names = Pack(body.as_py()), terms.as_py()
            q = shares(counts.values.to_numpy(), n.as_py(), v.as_py())
            for i, g in enumerate(pack.groups.tolist()):
                no = pack.no[pack.ptr[i] : pack.ptr[i + 1]]
                value = pack.p[i, no] - q[no]
                no, value = no[value > 0], value[value > 0]
                # Terms of a block are numbered in the order of UTF-8.
                best = heapq.nsmallest(top, zip((-value).tolist(), no.tolist(), strict=True))
                yield {"lang": pa.array([lang] * len(best), pa.string()), "g": np.full(len(best), g), "item": pa.array([names[t] for _, t in best], pa.string()), "value": np.array([-d for d, _ in best], np.int64)}

    met = packs.join(own.hint("merge"), ["lang", "block"]).select("lang", "body", "terms", "counts", "n_lang", "v")
    return met.mapInArrow(K.mapper(rows, _TERMS), "lang string, g long, item string, value long")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = 50, cell_groups: int = CELL_GROUPS, pack_counts: int = PACK_COUNTS, sent_terms: int = SENT_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): see above; part ``pair`` has all other sources of the language, part ``term`` at most ``top`` terms of a group."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = cut(group_counts(docs.withColumn("source", F.lit(""))).where(F.col("df") >= least).select("lang", "term"))
    n, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if n <= sent_terms and size <= SENT_BYTES:
        counts = group_counts(docs, kept.toArrow())
    else:
        counts = group_counts(docs).join(kept, ["lang", "term"])
    counts = cut(counts.drop("df"))
    terms = counts.groupBy("lang", "term").agg(F.sum("tf").alias("c"))
    langs = cut(terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("n_lang")))
    known = docs.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("tf").alias("n"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # one row a source, which the result has squared
    groups = known.join(totals, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang", "left")
    groups = cut(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), number.cast("long").alias("g")))
    most = groups.agg(F.coalesce(F.max("g") + 1, F.lit(0))).first()[0]
    widest = langs.agg(F.coalesce(F.max("v"), F.lit(0))).first()[0]
    size = max(cell_groups, -(-most // MAX_CELLS))
    blocks = max(1, -(-widest * size // pack_counts))
    groups = groups.withColumn("cell", F.expr(f"cast(g div {size} as int)"))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    own = Window.partitionBy("lang", "block")
    numbered = cut(terms.withColumn("block", block).withColumns({"no": (F.row_number().over(own.orderBy("term")) - 1).cast("long"), "size": F.count("*").over(own)}))
    sizes = numbered.groupBy("lang", "block").agg(F.first("size").alias("size"))
    full = counts.join(numbered.select("lang", "term", "block", "no"), ["lang", "term"]).select("lang", "source", "block", "no", "tf")
    # Every group stands in every block, with or without counts there.
    bare = groups.select("lang", "source", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(-1).cast("long").alias("no"), F.lit(0).cast("long").alias("tf"))
    entries = full.unionByName(bare).join(groups.select("lang", "source", "n", "v", "g", "cell"), ["lang", "source"]).join(sizes, ["lang", "block"], "left").withColumn("size", F.coalesce("size", F.lit(0).cast("long")))
    packs = cut(_packs(entries.select("lang", "block", "cell", "g", "no", "tf", "n", "v", "size")))
    # Terms and counts of a block, in the order of their numbers; a block is bounded, as a pack is.
    listed = numbered.groupBy("lang", "block").agg(F.array_sort(F.collect_list(F.struct("no", "term", "c"))).alias("x"))
    home = listed.select("lang", "block", F.col("x.term").alias("terms"), F.col("x.c").alias("counts")).join(langs, "lang")
    met = _home(packs)
    cells = -(-most // size)
    cells += cells % 2
    for at in range(cells - 1):
        one = _round(packs, at, cells)
        met = met.unionByName(one)
        if at % 8 == 7:
            met = cut(met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    of = groups.select("lang", F.col("g").alias("a"), "source")
    pairs = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).join(of, ["lang", "a"]).join(of.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    out = _standing_out(packs, home, top).join(of.withColumnRenamed("a", "g"), ["lang", "g"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")) for x, part in ((pairs, "pair"), (out, "term"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
