"""Search, divergence and token counts against plain Python and the library."""

import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from voxgraph.llm import divergence, lexical, tokencount

ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, query string, word string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def table(spark, rows):
    """(doc_id, text, lang, source) with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], ODD)


def searched(docs, items, k=10):
    words = [re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(d[1])) for d in docs]
    counts = [Counter(w) for w in words]
    n, total, df = sum(bool(w) for w in words), sum(map(len, words)), Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, w, c in zip(docs, words, counts):
            s = 0
            for t in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text)):
                if c[t]:
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * len(w) * n // total)))
            if s > 0:
                scored.append((-s, d[0] is None, d[0] or 0, d[0]))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    """Copies, ties, nulls, empty and long texts, one hot source."""
    r = random.Random(5)
    names = [f"w{i}" for i in range(60)] + ["Éa", "ÀB", "straße", "x1y"]
    text = lambda n: " ".join(r.choice(names) for _ in range(n))
    made = [(i, text(r.randint(1, 25)), r.choice(["en", "de"]), "hot" if r.random() < 0.4 else f"s{r.randint(0, 20)}") for i in range(400)]
    made += [(500 + i, made[0][1], "en", "copies") for i in range(60)]
    made += [(7, text(5), "en", "s1"), (None, text(9), "en", None), (None, text(9), None, None), (900, "", "fr", "a"), (901, None, "fr", "b"), (902, "  \n", "fr", "c"), (903, text(30_000), "en", "long")]
    r.shuffle(made)
    return made


@pytest.mark.parametrize("opened", [2, 128])
def test_search_equals_brute_force(spark, rows, monkeypatch, opened):
    monkeypatch.setattr(lexical, "OPENED", opened)
    monkeypatch.setattr(lexical, "SHARD_BYTES", 1 << 12)
    r = random.Random(6)
    items = [(i, " ".join(f"w{r.randint(0, 70)}" for _ in range(r.randint(0, 12)))) for i in range(80)] + [(100, None), (101, ""), (None, "éa STRASSE straße"), (3, "w1 w1 w1 x1y")]
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    got = [tuple(x) for x in lexical.search(table(spark, rows).repartition(5), queries).collect()]
    assert sorted(got, key=repr) == searched(rows, items)
    # More queries than are sent at once.
    got = [tuple(x) for x in lexical.search(table(spark, rows), queries, k=3, block_bytes=1500).collect()]
    assert sorted(got, key=repr) == searched(rows, items, 3)


def test_search_of_nothing(spark, rows):
    queries = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search(table(spark, []), queries).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(table(spark, []), queries).count() == 0
    assert lexical.search(table(spark, [(1, "", "a", "b"), (2, None, "a", "b")]), queries).count() == 0
    assert lexical.search(table(spark, rows), queries.limit(0)).count() == 0


def audited(rows, least, top=50):
    docs = [(x[2] or "", x[3] or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(x[1]))) for x in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t in df if df[t] >= least}
        groups = {s: Counter() for x, s, _ in docs if x == lang}
        for x, s, w in docs:
            if x == lang:
                groups[s].update(t for t in w if t in kept)
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pair = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in groups if x != s]
            term = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize(("least", "cell", "counts", "top", "sent"), [(30, 8, 1 << 20, 50, 1000), (5, 3, 40, 4, 0), (1, 2, 16, 50, 1000)])
def test_audit_equals_brute_force(spark, rows, least, cell, counts, top, sent):
    """Small cells and packs make many rounds and blocks; kept terms are sent or joined."""
    got = divergence.audit(table(spark, rows).repartition(3), least=least, top=top, cell_groups=cell, pack_counts=counts, sent_terms=sent)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == audited(rows, least, top)


def test_audit_of_little(spark):
    assert divergence.audit(table(spark, [])).count() == 0
    assert divergence.audit(table(spark, [(1, "a b", "en", "x")])).count() == 0
    got = divergence.audit(table(spark, [(1, None, "en", "x"), (2, "a", "en", None)])).select("source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == [("", "pair", "x", 0, 1), ("x", "pair", "", 0, 1)]


def test_shares_are_exact():
    for count, total, terms in ((0, 0, 1), (10**13, 3 * 10**14, 10**7), (123_456_789, 123_456_789, 1), (7, 22, 3)):
        assert divergence.shares([count], total, terms)[0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def test_token_counts_equal_the_library(spark, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = random.Random(3)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "é", "漢字", "😀", "123", "_", "ing", "\u0000", " ", "​", "word", "."]
    texts = ["", " ", "\n", " \n", "a ", " a", "\n\n", "▁", None, "x" * 70_000, "ab\n" * 9_000] + ["".join(r.choice(parts) for _ in range(r.randint(1, 40))) for _ in range(1500)]
    every = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, "a b", None, None), (1, "a", None, None)] + rows
    want = sorted((repr(x[0]), len((x[1] or "").encode()), n := len(model.encode(x[1] or "")), n > 4096) for x in every)
    got = tokencount.count_tokens(table(spark, every), PIECES)
    assert sorted((repr(x[0]), *x[1:]) for x in map(tuple, got.collect())) == want
    # The first tier changes no count, whatever it holds.
    for first in (tokencount.frequent(table(spark, every).select("doc_id", "text"), PIECES, rows=20, entries=5), tokencount._table(tokencount.load(PIECES), [])):
        got = tokencount.count_tokens(table(spark, every), PIECES, table=first)
        assert sorted((repr(x[0]), *x[1:]) for x in map(tuple, got.collect())) == want
    assert tokencount.count_tokens(table(spark, []), PIECES).count() == 0
