"""Quality and toxicity: held-out accuracy, and odd inputs."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.llm import quality, queries, toxicity
from voxgraph.llm.sampling import hashed_share

SF = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, score double, label int"
ROWS = [(1, None, 0.1, None), (2, "", 0.2, None), (3, "one", 0.3, None), (3, "one", 0.3, None), (4, "word " * 300_000, 0.4, None), (5, "\x00\t\n é 🙂", None, None), (None, "x", 0.0, None)]


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = (y == 1).sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (y == 0).sum())


def labelled(spark, df, label):
    out = df.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    return out[out.held_out], out.held_out, out


def test_quality_on_held_out_labels(spark):
    df = queries.op1_quality(spark, SF)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and df.count() == 1000
    held, flag, every = labelled(spark, df, "quality")
    assert list(flag) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in every.doc_id]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert ((held.score >= 0.3) == (held.predicted == 1)).all() and (held.predicted == held.quality).mean() > 0.93


def test_toxicity_on_held_out_labels(spark):
    held, _, every = labelled(spark, queries.op6_toxicity(spark, SF), "toxic")
    assert held[held.toxic == 0].rejected.mean() < 0.03
    assert every[every.toxic == 1].rejected.mean() > 0.8 and held[held.toxic == 1].rejected.mean() > 0.6
    assert every.severity.between(0, toxicity.GRADES).all()


def test_quality_equals_plain_follow_the_leader():
    """Weights and scores against the learner written out with dictionaries, one feature at a time."""
    texts = [("good plain words here and more of them " if i % 2 else "BAD !!! words %%% 123 ") * (1 + i % 4) for i in range(24)]
    how = quality.Ftrl(passes=2)

    def sparse(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, bucket, value = quality.features(raw, np.array([0, len(raw)]))
        out = {}
        for b, v in zip(bucket.tolist(), value.tolist()):
            out[b] = out.get(b, 0.0) + v
        return out

    rows, y = [sparse(t) for t in texts], [i % 2 for i in range(24)]
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def weight(b):
        zi = z.get(b, 0.0)
        if abs(zi) <= how.l1:
            return 0.0
        return -(zi - math.copysign(how.l1, zi)) / ((how.beta + math.sqrt(n.get(b, 0.0))) / how.alpha + how.l2)

    for _ in range(how.passes):
        for x, label in zip(rows, y):
            w = {b: weight(b) for b in x}
            bias = -zb / ((how.beta + math.sqrt(nb)) / how.alpha)
            p = 1 / (1 + math.exp(-(sum(w[b] * v for b, v in x.items()) + bias)))
            for b, v in x.items():
                g = (p - label) * v
                z[b] = z.get(b, 0.0) + g - (math.sqrt(n.get(b, 0.0) + g * g) - math.sqrt(n.get(b, 0.0))) / how.alpha * w[b]
                n[b] = n.get(b, 0.0) + g * g
            g = p - label
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / how.alpha * bias
            nb += g * g
    m = quality.fit_ftrl([(np.array(list(x)), np.array(list(x.values()))) for x in rows], np.array(y), how=how)
    assert all(abs(m.weights[b] - weight(b)) < 1e-5 for b in z) and np.count_nonzero(m.weights) == sum(weight(b) != 0 for b in z)
    whole = "".join(texts).encode()
    got = m.score(np.frombuffer(whole, np.uint8), np.cumsum([0, *(len(t) for t in texts)]))
    bias = -zb / ((how.beta + math.sqrt(nb)) / how.alpha)
    assert np.allclose(got, [1 / (1 + math.exp(-(sum(weight(b) * v for b, v in x.items()) + bias))) for x in rows], atol=1e-4)


def plain_severity(model, text):
    """(expected severity, P(grade >= 1)) by counting words and their starts one by one."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    index = {int(k): i for i, k in enumerate(model.keys)}
    count = {}
    for w in words:
        raw = w.encode()
        one = K.Lanes(np.frombuffer(raw, np.uint8))
        keys = [int(one.hash(np.array([0]), np.array([len(raw)]))[0])]
        keys += [int(K.mix(one.hash(np.array([0]), np.array([n])) + np.uint64(n))[0]) for n in range(4, 10) if len(raw) > n]
        for k in keys:
            if k in index:
                count[index[k]] = count.get(index[k], 0) + 1
    margin = sum(model.weights[i] * math.log1p(n) for i, n in count.items())
    above = [1 / (1 + math.exp(-(margin - t))) for t in model.thresholds]
    return sum(above), above[0]


def test_toxicity_equals_plain_counting(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = queries.toxicity_model(docs, labels, ~queries.held_out())
    got = {r.doc_id: (r.severity, r.p_toxic) for r in queries.op6_toxicity(spark, SF).collect()}
    for r in docs.where("doc_id % 7 = 0").collect():
        want = plain_severity(model, r.text)
        assert np.allclose(got[r.doc_id], want, atol=1e-9)


def test_ordinal_fit_has_no_slope():
    """At the fit, the penalised likelihood written out in plain Python falls in every direction."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, size=(200, 4)).astype(float)
    grade = np.clip((x @ [1.0, 0.5, -0.5, 0.2] + rng.normal(size=200)).astype(int), 0, 3)
    rows, cols = np.nonzero(x)
    w, t = toxicity.fit_ordinal(rows, cols, x[rows, cols], grade, 4, steps=3_000)

    def likelihood(w, t):
        total = -0.05 * float(np.dot(w, w))
        for xi, g in zip(x, grade):
            above = [1.0, *(1 / (1 + math.exp(-(float(np.dot(w, xi)) - b))) for b in t), 0.0]
            total += math.log(max(above[g] - above[g + 1], 1e-9))
        return total

    best = likelihood(w, t)
    for i in range(4):
        for step in (-0.02, 0.02):
            assert likelihood(w + step * np.eye(4)[i], t) < best
    for i in range(3):
        for step in (-0.02, 0.02):
            assert likelihood(w, t + step * np.eye(3)[i]) < best


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, ODD)
    rows = [(i, ("good plain words here " if i % 2 else "bad !!! words %%% ") * 5, i % 2) for i in range(60)]
    some = spark.createDataFrame(rows, "doc_id long, text string, label int")
    m = quality.train(some)
    got = {(r.doc_id, r.score) for r in quality.score(docs, m).collect()}
    assert len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    ids = spark.createDataFrame([(1,), (None,)], "doc_id long").select(queries.held_out().alias("h")).collect()
    assert all(r.h is not None for r in ids)
    assert quality.score(docs.where("false"), m).count() == 0
    assert {r.score for r in quality.score(docs, quality.train(some.where("false"))).collect()} == {0.5}
    t = toxicity.train(some.withColumn("label", 1 - F.col("label")))
    got = toxicity.score(docs, t).collect()
    assert len(got) == 7 and not any(r.rejected for r in got if r.doc_id in (1, 2))
    empty = toxicity.train(some.where("label = 1"))
    assert toxicity.drop_toxic(docs, empty).count() == 7 and toxicity.drop_toxic(docs, empty).columns == docs.columns
    assert toxicity.drop_toxic(some, t).count() == 30


def test_training_sample_is_bounded_and_stable(spark):
    rows = [(i, f"w{i % 7} ok" if i % 2 else "bad %%%", i % 2) for i in range(80)]
    some = spark.createDataFrame(rows, "doc_id long, text string, label int")
    part = hashed_share(some, "doc_id", 30)
    assert 15 < part.count() < 45 and hashed_share(some, "doc_id", 80).count() == 80
    a, b = quality.train(hashed_share(some.repartition(5), "doc_id", 30)), quality.train(hashed_share(some.repartition(2), "doc_id", 30))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_ordinal_thresholds_share_weights():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, 400)
    w, t = toxicity.fit_ordinal(np.arange(400), np.zeros(400, int), x.astype(float), np.minimum(x, 3), 1)
    assert w[0] > 0 and (np.diff(t) > 0).all()
    grade = (1 / (1 + np.exp(-(w[0] * np.arange(4)[:, None] - t)))).sum(axis=1)
    assert (np.diff(grade) > 0).all()


def test_span_hashes_depend_on_bytes_only():
    import pyarrow as pa

    (_, _, data, off), *_ = K.slices(pa.array(["ab cd ab", None, "xx ab"]))
    w = K.words(data, off, K.SPACED)
    assert w.doc.tolist() == [0, 0, 0, 2, 2] and w.hash[0] == w.hash[2] == w.hash[4] != w.hash[1]
    assert len(set(w.hash.tolist())) == 3


@pytest.mark.parametrize("text", ["a" * (3 * K.CHUNK_BYTES), "b " * K.CHUNK_BYTES])
def test_texts_longer_than_a_slice(text):
    import pyarrow as pa

    parts = list(K.slices(pa.array(["x", text, "y"])))
    assert [(a, b) for a, b, _, _ in parts][0][0] == 0 and parts[-1][1] == 3
    assert sum(len(d) for _, _, d, _ in parts) == len(text) + 2


def test_quality_learns_from_what_fits(spark):
    """Rows are learned from in the order of their hashed ids, as long as their features fit; a long text alone still counts."""
    rows = spark.createDataFrame([(i, "word%d and some more of them " % i * (1 + 40 * (i % 3)), i % 2) for i in range(30)], "doc_id long, text string, label int")
    placed = rows.orderBy(F.xxhash64("doc_id"))
    every = quality.train(rows)
    assert np.array_equal(quality.train(rows, entries=10**6).weights, every.weights)
    first = spark.createDataFrame(placed.limit(1).collect(), rows.schema)
    assert np.array_equal(quality.train(rows, entries=1).weights, quality.train(first).weights)
    raw = [np.frombuffer(r.text.encode(), np.uint8) for r in placed.collect()]
    sizes = np.cumsum([len(np.unique(quality.features(x, np.array([0, len(x)]))[1])) for x in raw])
    n = int((sizes <= 600).sum())
    assert 1 < n < 30
    fits = spark.createDataFrame(placed.limit(n).collect(), rows.schema)
    assert np.array_equal(quality.train(rows, entries=600).weights, quality.train(fits).weights)
