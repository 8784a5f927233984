"""License scans, with DataFrame functions only.

Texts and templates are normalised (A-Z to lower case, anything but letters a-z
and digits separates words) and become sequences of word bigrams.  A *window* is
a stretch of a text that begins where a run of bigrams of a template begins,
and ends where such a run ends: a notice may share its line with other words,
be wrapped over lines or stand amid a long text.  A window matches a template
if the Dice coefficient 2|A and B| / (|A| + |B|) of their bags of bigrams is at
least ``LEAST``.  As |A and B| is at most the smaller size, only windows with
LEAST/(2-LEAST) * |B| <= |A| <= (2-LEAST)/LEAST * |B| can match; templates of
which a text holds too few bigrams within that reach are left before any window
is compared.  A match shares so many bigrams that some of them hold one of a
few words chosen from the templates, and texts without any such word are left
before they are split.

Templates are full texts of short public licences, the heads of long ones, and
the notices by which licences are stated; their file is a parameter.

Rows: one for each input row, repeated rows alike; an empty table has none.
Null, empty and one-word texts match nothing; texts of any length are read
whole.  Of equal coefficients the smaller license name is the best.  Only the
id and text columns are read; others can have any name.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEAST = 0.8
#: File of the templates: a line ``@ NAME`` begins one.
TEMPLATE_FILE = str(Path(__file__).with_name("license_templates.txt"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words so common that they do not tell a licence from other texts.
COMMON = frozenset("a all an and any are as at be but by can for from has in is it may not of on one or other that the these this to under use was what which who will with without you your".split())


def read_templates(path: str = TEMPLATE_FILE) -> list[tuple[str, str]]:
    """(name, text) of a file that the driver has."""
    out: list[tuple[str, list[str]]] = []
    with open(path, encoding="utf-8") as f:
        for line in f:
            if line.startswith("@ "):
                out.append((line[2:].strip(), []))
            elif out:
                out[-1][1].append(line)
    return [(name, "".join(lines)) for name, lines in out]


def template_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def template_bigrams(text: str) -> Counter:
    """Word bigrams of a normalised template, with their counts."""
    words = template_words(text)
    return Counter(f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True))


def bounds(size: int, least: float = LEAST) -> tuple[int, int]:
    """Least and most bigrams with which a window can reach the coefficient against a template of ``size``."""
    whole = round(least * 1000)
    return -(-whole * size // (2000 - whole)), (2000 - whole) * size // whole


@dataclass(frozen=True)
class Template:
    name: str
    bag: Counter
    size: int
    lo: int
    hi: int
    need: int


def prepared(templates: Sequence[tuple[str, str]], least: float = LEAST) -> list[Template]:
    """Templates that have bigrams, in order of their names, with their bounds and the fewest bigrams that a match shares."""
    out = []
    for name, text in sorted(templates):
        if bag := template_bigrams(text):
            lo, hi = bounds(bag.total(), least)
            out.append(Template(name, bag, bag.total(), lo, hi, -(-round(least * 1000) * (lo + bag.total()) // 2000)))
    return out


def telling_words(templates: Sequence[Template]) -> list[str]:
    """Words of which every match of every template holds at least one.

    Of each template, words are chosen until fewer bigrams are without any than a match shares; those that
    stand in most of them come first, common ones last.
    """
    chosen: set[str] = set()
    for t in templates:
        while True:
            left = Counter({b: n for b, n in t.bag.items() if not chosen.intersection(b.split())})
            if left.total() < t.need:
                break
            score: Counter = Counter()
            for b, n in left.items():
                for w in set(b.split()):
                    score[w] += n
            chosen.add(min(score, key=lambda w: (w in COMMON, -score[w], w)))
    return sorted(chosen)


def _table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(t, b, times, size, lo, hi, need): a row for each distinct bigram of each template; as many as the templates have, whatever the input."""
    rows = [{"t": i, "b": b, "times": n, "size": t.size, "lo": t.lo, "hi": t.hi, "need": t.need} for i, t in enumerate(templates) for b, n in t.bag.items()]
    kind = "array<struct<t int, b string, times int, size int, lo int, hi int, need int>>"
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] | None = None, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, dice, n_templates, licenses): best match or null, templates that match, all matched names in order."""
    known = prepared(read_templates() if templates is None else templates, least)
    gate = rf"(?i)(?<![a-z0-9])(?:{'|'.join(telling_words(known))})(?![a-z0-9])"
    names = F.array(*[F.lit(t.name) for t in known])
    reach = max(t.hi for t in known) - 1
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Texts are known by their digests, so that copies are scanned once and a row's id plays no part.
    digest = F.when(F.col("text").rlike(gate), F.sha2("text", 256))
    texts = docs.select(digest.alias("of"), "text").where("of is not null").groupBy("of").agg(F.first("text").alias("text"))
    words = F.filter(F.split(F.translate("text", _UPPER, _LOWER), "[^a-z0-9]+"), lambda w: w != "")
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    bigrams = texts.select("of", words.alias("w")).where(F.size("w") > 1).select("of", F.posexplode(pairs).alias("pos", "b"))
    met = bigrams.join(F.broadcast(_table(docs.sparkSession, known)), "b").where(F.col("size") > 0)

    own = Window.partitionBy("of", "t")
    along, same = own.orderBy("pos"), Window.partitionBy("of", "t", "b").orderBy("pos")
    ahead = along.rangeBetween(0, reach)
    # A bigram counts in a window unless it already stands there as often as the template has it.
    limits = sorted({n for t in known for n in t.bag.values()})
    before: Column = F.coalesce(*[F.when(F.col("times") == n, F.lag("pos", n).over(same)) for n in limits], F.lit(-1))
    held = met.withColumn("all", F.count("*").over(own)).where(F.col("all") >= F.col("need")).withColumn("before", before)
    held = held.withColumns({"first": F.coalesce(F.col("pos") - F.lag("pos").over(along) > 1, F.lit(True)), "last": F.coalesce(F.lead("pos").over(along) - F.col("pos") > 1, F.lit(True)), "near": F.count("*").over(ahead)})
    held = held.withColumn("ahead", F.collect_list(F.when(F.col("near") >= 1, F.struct("pos", "before", "last"))).over(ahead)).where(F.col("first") & (F.col("near") >= F.col("need")))

    def dice(end: Column) -> Column:
        shared = F.size(F.filter("ahead", lambda x: (x.pos <= end.pos) & (x.before < F.col("pos"))))
        return 2.0 * shared / (end.pos - F.col("pos") + 1 + F.col("size"))

    ends = F.filter("ahead", lambda x: x["last"] & (x.pos - F.col("pos") + 1).between(F.col("lo"), F.col("hi")))
    matched = held.groupBy("of", "t").agg(F.max(F.array_max(F.transform(ends, dice))).alias("dice")).where(F.col("dice") >= least)
    found = matched.groupBy("of").agg(
        F.max(F.struct("dice", (-F.col("t")).alias("order"))).alias("top"), F.count("*").alias("n_templates"), F.array_join(F.array_sort(F.collect_set(F.element_at(names, F.col("t") + 1))), ",").alias("licenses")
    )
    # Rows that no text can join are dealt by their ids.
    keyed = docs.select("doc_id", F.coalesce(digest, F.xxhash64("doc_id").cast("string")).alias("of"))
    return keyed.join(found, "of", "left").select(
        "doc_id",
        F.when(F.col("top").isNotNull(), F.element_at(names, 1 - F.col("top.order"))).alias("license"),
        F.round("top.dice", 6).alias("dice"),
        F.coalesce("n_templates", F.lit(0)).alias("n_templates"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
    )


def oracle_sql(templates: Sequence[tuple[str, str]] | None = None, least: float = LEAST) -> str:
    """The same in DuckDB: every window of every text against every template that shares a bigram."""
    known = prepared(read_templates() if templates is None else templates, least)
    rows = ", ".join(f"({i}, '{t.name}', {t.size}, {t.lo}, {t.hi}, '{b}', {n})" for i, t in enumerate(known) for b, n in t.bag.items())
    return f"""
WITH t(i, name, size, lo, hi, b, n) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(low, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT r, unnest(range(1, len(w))) AS pos, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) AS b FROM w WHERE len(w) > 1),
m AS (SELECT r, i, name, size, lo, hi, n, g.b, pos, lag(pos) OVER (PARTITION BY r, i ORDER BY pos) AS earlier, lead(pos) OVER (PARTITION BY r, i ORDER BY pos) AS later FROM g JOIN t USING (b)),
v AS (
  SELECT a.r, a.i, a.name, a.size, a.pos AS s, e.pos AS e FROM m a JOIN m e ON a.r = e.r AND a.i = e.i AND e.pos - a.pos + 1 BETWEEN a.lo AND a.hi
  WHERE (a.earlier IS NULL OR a.pos - a.earlier > 1) AND (e.later IS NULL OR e.later - e.pos > 1)),
c AS (SELECT v.r, v.i, v.name, v.size, s, e, m.b, least(count(*), any_value(m.n)) AS shared FROM v JOIN m ON m.r = v.r AND m.i = v.i AND m.pos BETWEEN s AND e GROUP BY v.r, v.i, v.name, v.size, s, e, m.b),
x AS (SELECT r, i, name, 2.0::DOUBLE * sum(shared)::DOUBLE / (e - s + 1 + size) AS dice FROM c GROUP BY r, i, name, size, s, e),
one AS (SELECT r, i, name, max(dice) AS dice FROM x GROUP BY r, i, name HAVING max(dice) >= {least}),
k AS (SELECT r, arg_min(name, (-dice, i)) AS license, round(max(dice), 6) AS dice, count(*) AS n_templates, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM one GROUP BY r)
SELECT doc_id, license, dice, coalesce(n_templates, 0)::BIGINT AS n_templates, coalesce(licenses, '') AS licenses FROM d LEFT JOIN k USING (r)"""
