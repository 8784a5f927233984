"""Toxicity by cumulative-link ordinal regression.

Features are sparse and come from the text alone: words, and starts of words of
4 to 9 bytes, in lower case.  A vocabulary keeps the features that tell toxic
labels from others; each is known by its 64-bit hash, so that words outside the
vocabulary never collide with one inside.  A text's value for a feature is the
logarithm of one plus its count.

Labels are 0 or 1, so grades of severity are made for the labelled rows: 0 for
label 0, and 1 to ``GRADES`` for label 1, by the tertiles of the number of
tokens that carry a vocabulary feature.  One weight vector is shared by the
ordered thresholds: P(grade >= g) = logistic(w.x - t[g]).  The result is the
expected severity, the sum of these, and a text is rejected where
P(grade >= 1) is at least ``REJECT``.

Rows: one for each input row, repeated rows alike; an empty table has none.  Null
and empty texts have no features, and the lowest severity; texts of any length
are read whole; other columns can have any name.  Features of equal worth enter
the vocabulary in the order of their hashes.  Without both labels in the sample the vocabulary is empty and
nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K

#: Labelled rows that training uses, on average, where there are more; and most features of the vocabulary.
TRAIN_ROWS, VOCABULARY = 20_000, 8_192
GRADES = 3
REJECT = 0.5
#: A feature enters the vocabulary if it stands in this many toxic texts and its log odds ratio is at least this.
LEAST_TEXTS, LEAST_ODDS = 3, 2.0
_STARTS = range(4, 10)
_U = np.uint64


def tokens(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, token number, feature hash) of words and of starts of words."""
    w = K.words(data, off, K.ALNUM)
    at = np.arange(len(w.doc))
    yield w.doc, at, w.hash
    size = w.end - w.start
    for n in _STARTS:
        own = np.flatnonzero(size > n)
        yield w.doc[own], own, K.mix(w.lanes.hash(w.start[own], w.start[own] + n) + _U(n))


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the rising thresholds."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def _filter(self) -> np.ndarray:
        seen = np.zeros(1 << 20, bool)
        seen[(self.keys & _U((1 << 20) - 1)).astype(np.int64)] = True
        return seen

    def counts(self, data: np.ndarray, off: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, feature number, count) of the features that occur, and the tokens that carry any, by document."""
        docs, feats, toks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.int64)]
        for doc, at, h in tokens(data, off):
            maybe = np.flatnonzero(seen[(h & _U(len(seen) - 1)).astype(np.int64)])
            if len(maybe):
                i = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                ok = self.keys[i] == h[maybe]
                docs.append(doc[maybe[ok]])
                feats.append(i[ok])
                toks.append(np.stack([doc[maybe[ok]], at[maybe[ok]]]))
        key, n = np.unique(np.concatenate(docs) * len(self.keys) + np.concatenate(feats), return_counts=True) if len(self.keys) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        carrying = np.bincount(np.unique(np.concatenate(toks, axis=1), axis=1)[0], minlength=len(off) - 1)
        return key // max(1, len(self.keys)), key % max(1, len(self.keys)), n, carrying

    def margins(self, data: np.ndarray, off: np.ndarray, seen: np.ndarray) -> np.ndarray:
        d, f, n, _ = self.counts(data, off, seen)
        return np.bincount(d, weights=self.weights[f] * np.log1p(n), minlength=len(off) - 1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, n_cols: int, grades: int = GRADES, l2: float = 0.1, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that maximise the penalised likelihood of the grades under cumulative links, by accelerated gradient steps."""
    n = len(grade)
    w, t = np.zeros(n_cols), np.linspace(0.5, 1.5, grades)
    gap = np.concatenate([t[:1], np.log(np.diff(t))])  # thresholds rise: first, then logarithms of the gaps
    state = np.concatenate([w, gap])
    m1, m2 = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        w, gap = state[:n_cols], state[n_cols:]
        t = gap[0] + np.concatenate([[0.0], np.cumsum(np.exp(gap[1:]))])
        above = _logistic(np.bincount(rows, weights=values * w[cols], minlength=n)[:, None] - t)  # P(grade >= g), g = 1..grades
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-9)
        slope = full * (1 - full)
        lo, hi = slope[at, grade], slope[at, grade + 1]
        by_margin = (lo - hi) / p  # of the log likelihood
        by_t = np.zeros((n, grades + 2))
        by_t[at, grade] -= lo / p
        by_t[at, grade + 1] += hi / p
        by_t = by_t[:, 1:-1].sum(axis=0)
        rest = np.cumsum(by_t[::-1])[::-1]
        g = np.concatenate([np.bincount(cols, weights=values * by_margin[rows], minlength=n_cols) - l2 * w, [rest[0]], rest[1:] * np.exp(gap[1:])]) / max(n, 1)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        state = state + 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    gap = state[n_cols:]
    return state[:n_cols], gap[0] + np.concatenate([[0.0], np.cumsum(np.exp(gap[1:]))])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", vocabulary: int = VOCABULARY) -> Model:
    """Fit on labelled texts; rows without a label or an id are left out.

    The rows' features of the vocabulary come to the driver: bound the rows with ``hashed_share``.
    """
    sample = (
        labelled.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .select((F.col(label_col) > 0).cast("int").alias("label"), F.col(text_col).alias("text"))
        .cache()
    )
    schema = pa.schema([("key", pa.int64()), ("bad", pa.int64()), ("good", pa.int64())])

    def seen_in(batch: pa.RecordBatch) -> Iterator[dict]:
        label = batch.column(0).to_numpy()
        for a, b, data, off in K.slices(batch.column(1)):
            parts = [(d, h) for d, _, h in tokens(data, off)]
            doc, h = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            key, at = np.unique(h[new], return_inverse=True)
            bad = np.bincount(at, weights=label[a:b][doc[new]], minlength=len(key)).astype(np.int64)
            yield {"key": key.view(np.int64), "bad": bad, "good": np.bincount(at, minlength=len(key)) - bad}

    n = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    n_bad, n_good = n.get(1, 0), n.get(0, 0)
    empty = Model(np.zeros(0, _U), np.zeros(0), np.linspace(4.0, 6.0, GRADES))
    if not n_bad or not n_good:
        sample.unpersist()
        return empty
    odds = F.log((F.col("bad") + 0.25) / (n_bad - F.col("bad") + 0.25)) - F.log((F.col("good") + 0.25) / (n_good - F.col("good") + 0.25))
    kept = (
        sample.mapInArrow(K.mapper(seen_in, schema), "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "key").limit(vocabulary).select("key").toArrow()
    )
    keys = np.sort(kept["key"].to_numpy().view(_U))
    if not len(keys):
        sample.unpersist()
        return empty
    draft = Model(keys, np.zeros(len(keys)), np.zeros(GRADES))
    found = pa.schema([("label", pa.int64()), ("carrying", pa.int64()), ("cols", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def sparse(batch: pa.RecordBatch) -> Iterator[dict]:
        filter_ = draft._filter()
        for a, b, data, off in K.slices(batch.column(1)):
            d, f, c, carrying = draft.counts(data, off, filter_)
            cut = pa.array(np.searchsorted(d, np.arange(b - a + 1)).astype(np.int32))
            yield {"label": batch.column(0).slice(a, b - a).cast(pa.int64()), "carrying": carrying, "cols": pa.ListArray.from_arrays(cut, pa.array(f.astype(np.int32))), "counts": pa.ListArray.from_arrays(cut, pa.array(c.astype(np.int32)))}

    table = sample.mapInArrow(K.mapper(sparse, found), "label long, carrying long, cols array<int>, counts array<int>").toArrow()
    sample.unpersist()
    label, carrying = table["label"].to_numpy(), table["carrying"].to_numpy()
    tertiles = np.quantile(carrying[label == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(label == 1, 1 + np.searchsorted(tertiles, carrying, side="left"), 0)
    cols = table["cols"].combine_chunks()
    size = np.diff(cols.offsets.to_numpy())
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(label)), size), cols.flatten().to_numpy(), np.log1p(table["counts"].combine_chunks().flatten().to_numpy()), grade, len(keys))
    return Model(keys, weights, thresholds)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """(doc_id, severity, p_toxic, rejected) of every row; severity is the expected grade."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY features
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("p_toxic", pa.float64()), ("rejected", pa.bool_())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        filter_ = shared.value._filter()
        for a, b, data, off in K.slices(batch.column(1)):
            p = _logistic(shared.value.margins(data, off, filter_)[:, None] - shared.value.thresholds)
            yield {"doc_id": batch.column(0).slice(a, b - a), "severity": p.sum(axis=1), "p_toxic": p[:, 0], "rejected": p[:, 0] >= reject}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.mapper(rows, schema), "doc_id long, severity double, p_toxic double, rejected boolean")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``docs``, same columns, without the rows that the model rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = shared.value._filter()
        for batch in K.released(batches):
            keep = np.ones(batch.num_rows, bool)
            for a, b, data, off in K.slices(batch.column(at)):
                keep[a:b] = _logistic(shared.value.margins(data, off, filter_) - shared.value.thresholds[0]) < reject
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(rows, docs.schema)
