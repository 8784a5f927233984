"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text becomes a sequence of tokens (words, and runs of punctuation) and a
parallel sequence of token shapes (case, script, punctuation itself, whether
the token repeats its neighbour or stood earlier in the text).  Unigrams and
bigrams of the tokens and unigrams to trigrams of the shapes are hashed into
``2**bits`` buckets; a few n-grams over bins of whole-text statistics (length,
share of repeated tokens, share of each shape) complete them.  A feature's
value is its share of the text, so a score is one sparse dot product that needs
no sorting of features.

Only the text is an input of a score.  Null and empty texts have the features
of the empty text and get a score like all others; texts of any length are read
whole.  Each input row gives one row; repeated rows get equal scores; an empty
table has no rows; without labelled rows every score is 0.5.  Equal scores are
not ranked, so there are no ties.  Other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.plans.lineage import cut

BITS = 18
#: Labelled rows that training uses, on average, where there are more.
TRAIN_ROWS = 6_000
#: Features of those rows that the driver takes, at most: 12 bytes each, and 12 more while they are put in order.
ENTRIES = 20_000_000
#: Weight of the shares in a text, so that steps of the learner suit them.
SCALE = np.float32(8.0)

_U = np.uint64
_OTHER, _SPACE, _WORD = 0, 1, 2


def _classes() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[K.ALNUM] = _WORD
    t[~K.SPACED] = _SPACE
    return t


_CLASS = _classes()
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.zeros(256, bool)
_HIGH[128:] = True


def _bins(share: np.ndarray) -> np.ndarray:
    """Shares 0 to 1 in 12 steps, finer near 0."""
    return np.floor(12 * np.sqrt(np.clip(share, 0, 1))).astype(np.int64)


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of a slice of texts, grouped by document; a bucket can occur again and again."""
    n_docs = len(off) - 1
    kind = _CLASS[data]
    ws, we = K.runs(kind == _WORD, off)
    ps, pe = K.runs(kind == _OTHER, off)
    start = np.concatenate([ws, ps])
    order = np.argsort(start, kind="stable")
    start, end, is_word = start[order], np.concatenate([we, pe])[order], (np.arange(len(start)) < len(ws))[order]
    doc = np.searchsorted(off, start, side="right") - 1
    h = K.Lanes(K.LOWER[data]).hash(start, end)

    def total(flag: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flag, out=c[1:])
        return c[end] - c[start]

    size = end - start
    upper, digit, high = total(_UPPER[data]), total(_DIGIT[data]), total(_HIGH[data])
    shape = np.where(is_word, 1 + (upper == size) * (size > 1) + 2 * ((upper > 0) & (upper < size)) + 4 * (digit > 0) + 8 * (high > 0), 0).astype(_U)
    shape = np.where(is_word, shape, h)  # punctuation stands for itself
    # Tokens that stood earlier in their own text, and those equal to the token or to the word before.
    own = K.mix(h ^ (doc.astype(_U) * _U(0x632BE59BD9B4E019)))
    by = np.argsort(own, kind="stable")
    seen = np.zeros(len(h), bool)
    seen[by[1:]] = own[by[1:]] == own[by[:-1]]
    again = np.zeros(len(h), bool)
    for back in (1, 2):
        if len(h) > back:
            again[back:] |= is_word[back:] & (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
    shape = shape * _U(4) + seen.astype(_U) * _U(2) + again.astype(_U)

    n = np.bincount(doc, minlength=n_docs).astype(np.float64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for seq, most, salt in ((h, 2, 1), (shape, 3, 11)):
        for k in range(1, most + 1):
            ok = K.within(doc, k)
            parts.append((doc[: len(ok)][ok], K.grams(seq, k)[ok] + _U(salt + k)))
    d = np.concatenate([p[0] for p in parts])
    bucket = (K.mix(np.concatenate([p[1] for p in parts])) >> _U(64 - bits)).astype(np.int64)
    value = (SCALE / np.maximum(n, 1)[d]).astype(np.float32)

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=flag, minlength=n_docs) / np.maximum(n, 1)

    length = np.floor(np.log2(n + 1)).astype(np.int64)
    stats = [share(seen), share(again), share(is_word & (upper == size) & (size > 1)), share(~is_word), share(is_word & (upper > 0)), share(digit > 0)]
    whole = [length * 100 + 99]
    for i, s in enumerate(stats):
        whole += [_bins(s) + 1000 * (i + 1), _bins(s) + 100 * length + 100_000 * (i + 1)]
    every = np.concatenate(whole).astype(_U) + _STEP
    d = np.concatenate([d, np.tile(np.arange(n_docs), len(whole))])
    bucket = np.concatenate([bucket, (K.mix(every) >> _U(64 - bits)).astype(np.int64)])
    value = np.concatenate([value, np.full(len(every), 0.3, np.float32)])
    return d, bucket, value


_STEP = _U(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Ftrl:
    """Settings of the learner: step, L1, L2, passes over the sample."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    passes: int = 4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int

    def margin(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        d, bucket, value = features(data, off, self.bits)
        return self.bias + np.bincount(d, weights=self.weights[bucket] * value, minlength=len(off) - 1)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(data, off), -35, 35)))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, bits: int = BITS, how: Ftrl = Ftrl()) -> Model:
    """Follow the regularised leader, one example at a time, in the order given."""
    z, s = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = sb = 0.0

    def weight(zi, si):
        return -np.sign(zi) * np.maximum(np.abs(zi) - how.l1, 0) / ((how.beta + np.sqrt(si)) / how.alpha + how.l2)

    for _ in range(how.passes):
        for (i, x), label in zip(rows, y, strict=True):
            w = weight(z[i], s[i])
            b = -zb / ((how.beta + np.sqrt(sb)) / how.alpha)
            p = 1 / (1 + np.exp(-np.clip(w @ x + b, -35, 35)))
            g = (p - label) * x
            g2 = g * g
            z[i] += g - (np.sqrt(s[i] + g2) - np.sqrt(s[i])) / how.alpha * w
            s[i] += g2
            gb = p - label
            zb += gb - (np.sqrt(sb + gb * gb) - np.sqrt(sb)) / how.alpha * b
            sb += gb * gb
    return Model(weight(z, s).astype(np.float32), float(-zb / ((how.beta + np.sqrt(sb)) / how.alpha)), bits)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", bits: int = BITS, how: Ftrl = Ftrl(), entries: int = ENTRIES) -> Model:
    """Fit on labelled texts, in the order of their hashed ids; rows without a label or an id are left out.

    Features come to the driver: bound the rows with ``hashed_share``.  Of those rows, the first are learned from that have at most
    ``entries`` features together (a first text that alone has more is learned from), so that long texts do not fill the driver.
    """
    schema = pa.schema([("place", pa.int64()), ("label", pa.float64()), ("bucket", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])

    def sparse(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, b, data, off in K.slices(batch.column(2)):
            d, bucket, value = features(data, off, bits)
            key, at = np.unique((d << bits) | bucket, return_inverse=True)
            total = np.bincount(at, weights=value).astype(np.float32)
            ends = np.searchsorted(key >> bits, np.arange(b - a + 1)).astype(np.int32)
            yield {
                "place": batch.column(0).slice(a, b - a),
                "label": batch.column(1).slice(a, b - a),
                "bucket": pa.ListArray.from_arrays(pa.array(ends), pa.array((key & ((1 << bits) - 1)).astype(np.int32))),
                "value": pa.ListArray.from_arrays(pa.array(ends), pa.array(total)),
            }

    known = labelled.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = known.select(F.xxhash64(F.col(id_col)).alias("place"), F.col(label_col).cast("double").alias("label"), F.col(text_col).alias("text"))
    made = cut(rows.mapInArrow(K.mapper(sparse, schema), "place long, label double, bucket array<int>, value array<float>"))
    sizes = made.groupBy("place").agg(F.sum(F.size("bucket")).alias("n")).toArrow().sort_by("place")
    if sizes.num_rows and sizes["n"].to_numpy().sum() > entries:
        fits = int((sizes["n"].to_numpy().cumsum() <= entries).sum())
        made = made.where(F.col("place") <= sizes["place"][max(fits, 1) - 1].as_py())
    table = made.toArrow().sort_by("place")
    sets = [(np.asarray(i.values), np.asarray(x.values).astype(np.float64)) for i, x in zip(table["bucket"], table["value"], strict=True)]
    return fit_ftrl(sets, table["label"].to_numpy(), bits, how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.3) -> DataFrame:
    """(doc_id, score double, predicted int) of every row; predicted is 1 where the score is ``keep`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits floats, whatever the input's size
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for a, b, data, off in K.slices(batch.column(1)):
            p = shared.value.score(data, off)
            yield {"doc_id": batch.column(0).slice(a, b - a), "score": p, "predicted": (p >= keep).astype(np.int32)}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.mapper(rows, schema), "doc_id long, score double, predicted int")
