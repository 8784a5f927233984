"""Near duplicates, decontamination and nearest neighbours against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from voxgraph.llm import ann, decontam, neardup, queries

SF = "/root/testdata/sf0.001"
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def sets(text, k):
    w = SPACED.findall(low(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, rule):
    s = {i: sets(t, rule.words) for i, t in rows}
    to = {i: i for i in s}

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    order = sorted(s)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if s[a] and s[b] and rule.den * len(s[a] & s[b]) >= rule.num * len(s[a] | s[b]):
                x, y = find(a), find(b)
                to[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in s}


def changed(words, n, rnd):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


def family_rows(seed=5):
    """Chains, stars with members just under the threshold, copies, short and empty texts."""
    rnd = random.Random(seed)
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1

    for _ in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([40, 120, 300]))]
        add(changed(base, max(1, len(base) // 30), rnd))
        for _ in range(rnd.randrange(2, 14)):
            add(changed(base, rnd.choice([0, 1, 2, len(base) // 40, len(base) // 20, len(base) // 12]), rnd))
        chain = base
        for _ in range(4):
            chain = changed(chain, max(1, len(base) // 40), rnd).split()
            add(" ".join(chain))
    for t in (None, "", "  \n", "one", "ONE", "one two", "one two three", "One  two\tthree", "é è", "the same", "the same"):
        add(t)
    return rows


@pytest.mark.parametrize("rule", [neardup.Rule(3, 85, 100), neardup.Rule(5, 80, 100)])
def test_components_equal_brute_force(spark, rule, monkeypatch):
    rows = family_rows()
    df = spark.createDataFrame([(i, t, "clash", 1, "k") for i, t in rows], "doc_id long, text string, rep string, n int, key string")
    want = brute_components(rows, rule)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, rule).collect()}
    assert got == want
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "LARGE", 3)
    monkeypatch.setattr(neardup, "SET_BLOCK", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, rule).collect()} == want


def many_near_misses(n_family=300, n_other=10_000, seed=11):
    """A family whose members are about as often just under the threshold as over it, and thousands of texts that share a passage."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(90)]
    rows = [(i, changed(base, rnd.choice([1, 2, 2, 3]), rnd)) for i in range(n_family)]
    passage = " ".join(f"p{i}" for i in range(6))
    for i in range(n_other):
        own = " ".join(f"o{rnd.randrange(10**6)}" for _ in range(rnd.randrange(5, 9)))
        rows.append((n_family + i, f"{passage} {own}" if i % 3 == 0 else own))
    return rows


def test_components_of_ten_thousand_sets(spark):
    rows = many_near_misses()
    rule = neardup.Rule(3, 85, 100)
    s = {i: sets(t, 3) for i, t in rows}
    holders = {}
    for i, own in s.items():
        for x in own:
            holders.setdefault(x, []).append(i)
    # Texts outside the family have at most 12 shingles, of which the passage's 4 reach no link; so pairs of the family are all that can be linked.
    to = {i: i for i in s}

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    missed = 0
    for a in range(300):
        for b in range(a + 1, 300):
            if 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                to[max(x, y)] = min(x, y)
            else:
                missed += 1
    assert missed > 10_000 and max(len(s[i]) for i in s if i >= 300) <= 12
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, rule).collect()}
    assert got == {i: (len(s[i]), find(i)) for i in s}


def opposites(n=2048):
    """A word of the letters a and b, and its complement: equal under polynomial hashes modulo powers of two."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_complements_are_other_words(spark):
    for size in (64, 256, 2048):
        a, b = opposites(size)
        df = spark.createDataFrame([(1, f"{a} x y z"), (2, f"{b} x y z"), (3, a), (4, b)], "doc_id long, text string")
        assert all(r.kept for r in neardup.near_duplicates(df).collect())
        items = spark.createDataFrame([(1, a)], "item_id long, text string")
        for limit in (decontam.BROADCAST_WINDOWS, 0):
            assert {r.doc_id: r.n_hit for r in decontam.decontaminate(df, items, broadcast_windows=limit).collect()} == {1: 1, 2: 0, 3: 1, 4: 0}


def test_ids_with_several_texts_and_long_texts(spark):
    rnd = random.Random(4)
    long = " ".join(f"w{rnd.randrange(10**5)}" for _ in range(200_000))
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w"), (2, "q r s t u v w"), (3, "a b c d e f g"), (7, long), (8, long + " end"), (9, "x" * 1_000_000)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, node string, comp long")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect())
    assert [(i, c) for i, _, c in got] == [(1, 1), (1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9)]
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(df).collect()) == [1, 1, 7, 9]


def test_near_duplicates_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_components(rows, neardup.Rule(3, 85, 100))
    got = queries.op7_near_duplicates(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [("1", "1", True), ("1", "1", True), ("2", "2", True), ("None", "None", True)]
    assert neardup.near_duplicates(df.where("false")).count() == 0
    assert neardup.drop_near_duplicates(df.where("doc_id is not null")).count() == 3


def brute_hits(docs, items):
    wins = {}
    for i, t in items:
        w = ALNUM.findall(low(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w = ALNUM.findall(low(t))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if (x := wins.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= x
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_decontamination_equals_brute_force(spark, limit):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "x-y", "don't", "日本"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 5, 9, 10, 11, 30])))) for i in range(40)] + [(40, None), (41, "?!"), (2, "again an item with the same id as one before it")]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 2, 50])))) for i in range(30)] + [(100, None), (101, "")]
    for i in range(60):
        part = (rnd.choice(items)[1] or "").split()
        cut = part[: rnd.randrange(len(part) + 1)]
        docs.append((200 + i, " ".join([*(rnd.choice(words) for _ in range(rnd.randrange(9))), *cut, "Tail", *(part * rnd.randrange(2))]).upper()))
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    # Rows that repeat an id with another text, and rows without one, are judged by their own texts.
    again = [(200, "clean words of another text"), (200, docs[32][1]), (None, docs[40][1])]
    docs = [*docs, *again]
    a = spark.createDataFrame([(*d, "clash", 3) for d in docs], "doc_id long, text string, words string, item_id int")
    got = decontam.decontaminate(a, b, broadcast_windows=limit).drop("item_ids")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_hits(docs, items)
    assert {r.contaminated for r in decontam.decontaminate(a, b.where("false"), broadcast_windows=limit).collect()} == {False}
    assert decontam.decontaminate(a.where("false"), b, broadcast_windows=limit).count() == 0


def test_decontamination_on_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op8_decontamination(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_hits(docs, items) and any(r.contaminated for r in got)


def brute_nearest(rows, k=20, every=20):
    out = {}
    for q, v in rows:
        if q % every == 0:
            s = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def test_nearest_recall(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows)
    got = {}
    for r in queries.op10_nearest(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(exact[q, i] - s) < 1e-12 for q in got for i, s in got[q] if (q, i) in exact)


def test_nearest_odd_rows(spark, monkeypatch):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 60)] + [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [float("nan"), 1.0, 1.0]), (105, [float("inf"), 1.0, 1.0]), (106, [1.0, 2.0]), (None, same), (200, [-1.0, 0.0, 0.5]), (200, [-1.0, 0.0, 0.5]), (220, [2.0, 2.0, 2.0]), (220, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "vec_id long, embedding array<double>, code string, part int")
    got = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 20, 40, 200, 220}
    # Of two vectors of id 220 the first in order counts; the shorter vector of id 106 is filled up with zeros.
    assert got[0] == list(range(1, 21)) and got[20] == [i for i in range(21) if i != 20] and got[220][:3] == [0, 1, 2]
    few = ann.nearest(df.where("vec_id in (0, 1, 2)"))
    assert [(r.rank, r.vec_id) for r in few.orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(df.where("false")).count() == 0 and ann.nearest(df.where("vec_id = 102")).count() == 0
    rng = np.random.default_rng(2)
    many = [(i, rng.normal(size=9).tolist()) for i in range(300)]
    monkeypatch.setattr(ann, "UNIT_BLOCK", 64)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    monkeypatch.setattr(ann, "COVER", 1.0)
    got = {}
    for r in ann.nearest(spark.createDataFrame(many, "vec_id long, embedding array<double>"), rerank=64).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = brute_nearest([(i, np.array(v)) for i, v in many])
    assert {q: [x[r] for r in range(1, 21)] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


@pytest.mark.parametrize("n, clusters", [(2_000, 0), (50_000, 0), (50_000, 300)])
def test_recall_and_moved_rows_at_sizes(spark, monkeypatch, n, clusters):
    """Recall against brute force; where the data have clusters, a query visits few bins."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 32))
    if clusters:
        x = 0.25 * x + rng.normal(size=(clusters, 32))[rng.integers(clusters, size=n)]
    monkeypatch.setattr(ann, "UNIT_BLOCK", 2_048)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)}))
    got = ann.nearest(df, every=500).toPandas().groupby("query_id").vec_id.agg(set)
    q = np.arange(0, n, 500)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[i] & set(w.tolist())) / 20 for i, w in zip(q.tolist(), want, strict=True)]) >= 0.9
    if clusters:
        coarse = ann.fit_coarse(x[rng.permutation(n)[:20_000]], n, 20)
        assert coarse.probes < 0.2 * len(coarse.centres)


@pytest.mark.parametrize("norms, hot", [(False, False), (True, False), (False, True)])
def test_partitions_grow_with_the_root_of_the_rows(spark, monkeypatch, norms, hot):
    """Partitions beyond what the sample carries come from splits, also where norms vary widely and where one cluster holds a third of all rows."""
    rng = np.random.default_rng(4)
    n, at = 20_000, rng.integers(80, size=20_000)
    if hot:
        at[: n // 3] = 0
    x = 0.4 * rng.normal(size=(n, 24)) + rng.normal(size=(80, 24))[at]
    if norms:
        x *= rng.lognormal(sigma=0.7, size=(n, 1))
    monkeypatch.setattr(ann, "PARTITIONS", 16)
    monkeypatch.setattr(ann, "UNIT_BLOCK", 512)
    kept = []
    monkeypatch.setattr(ann, "split", lambda *a, made=ann.split: kept.append(made(*a)) or kept[-1])
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)}))
    got = ann.nearest(df, every=200).toPandas().groupby("query_id").vec_id.agg(set)
    (coarse,) = kept
    assert len(coarse.tops) == 16 and 100 <= len(coarse.centres) <= 160 and coarse.first[-1] == len(coarse.centres)
    part = coarse.part(x)
    top = ((coarse.tops**2).sum(axis=1) - 2 * x @ coarse.tops.T).argmin(axis=1)
    assert np.array_equal(top, np.searchsorted(coarse.first, part, side="right") - 1)
    if hot:
        assert np.bincount(part).max() < n // 12  # the cluster is many partitions
    q = np.arange(0, n, 200)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[i] & set(w.tolist())) / 20 for i, w in zip(q.tolist(), want, strict=True)]) >= 0.9


@pytest.mark.parametrize("kind", ["near copies", "heavy tails", "few long"])
def test_recall_where_codes_or_centres_tell_little(spark, monkeypatch, kind):
    """Near copies have one code, heavy tails spoil codebooks, and long vectors that the sample misses are near to all."""
    rng = np.random.default_rng(6)
    n = 6_000
    x = rng.normal(size=(n, 32))
    if kind == "near copies":
        x = rng.normal(size=(8, 32))[rng.integers(8, size=n)] + 1e-3 * x
    elif kind == "heavy tails":
        x = rng.standard_t(2, size=(n, 32))
    else:
        monkeypatch.setattr(ann, "UNIT_BLOCK", 256)
        monkeypatch.setattr(ann, "SAMPLE", 1_500)
        x = x + 4 * rng.normal(size=(40, 32))[rng.integers(40, size=n)]
        x[7::200] = 50 * rng.normal(size=(n // 200, 32))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)}))
    got = ann.nearest(df, every=100).toPandas().groupby("query_id").vec_id.agg(set)
    q = np.arange(0, n, 100)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[i] & set(w.tolist())) / 20 for i, w in zip(q.tolist(), want, strict=True)]) >= 0.95


def test_split_without_rows_for_a_partition(spark, monkeypatch):
    """A partition that the rows of the split miss stays whole; few rows, or centres that would be too many bytes, are not split."""
    x = np.random.default_rng(5).normal(size=(400, 6))
    units = spark.createDataFrame([(v.tolist(), [i]) for i, v in enumerate(x)], "v array<double>, ids array<long>")
    coarse = ann.Coarse(np.concatenate([x[:3], np.full((1, 6), 1e6)]), 4)
    made = ann.split(coarse, units, 400, x, 5)
    assert made.first[-1] - made.first[-2] == 1 and np.array_equal(made.centres[-1], coarse.centres[-1])
    assert made.part(np.full((1, 6), 1e6)).tolist() == [len(made.centres) - 1] and len(made.part(x[:0])) == 0
    assert ann.split(coarse, units, 60, x, 5) is coarse
    monkeypatch.setattr(ann, "CENTRE_BYTES", 7 * 48)
    assert ann.split(coarse, units, 400, x, 5) is coarse
