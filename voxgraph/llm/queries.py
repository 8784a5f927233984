"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.llm import ann, bpe, decontam, divergence, htmltext, lexical, licenses, neardup, quality, secrets, tokencount, toxicity, urlfilter
from voxgraph.llm.sampling import hashed_share

#: File of the tokenizer that encodes; a name of the public tokenizers package or a path.
TOKENIZER = "byte_bpe_50k.json"
#: File of the model that counts tokens.
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    K.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether the remainder is 0; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels of held-out documents are not learned from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where("quality is not null").where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    chosen = hashed_share(labels, "doc_id", quality.TRAIN_ROWS)
    model = quality.train(docs.join(F.broadcast(chosen), "doc_id"))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "cut")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), neardup.Rule(words=3, num=85, den=100))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("item_ids")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def toxicity_model(docs: DataFrame, labels: DataFrame, keep: F.Column | None = None) -> toxicity.Model:
    """Fitted on the labelled documents, a bounded sample of them, or those for which ``keep`` holds."""
    labels = labels.where("toxic is not null").where(keep if keep is not None else F.lit(True)).select("doc_id", F.col("toxic").alias("label"))
    chosen = hashed_share(labels, "doc_id", toxicity.TRAIN_ROWS)
    return toxicity.train(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, severity, p_toxic, rejected of every document; labels of held-out documents are not learned from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, _table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "severity", "p_toxic", "rejected")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), blocked=urlfilter.read_list(urlfilter.BLOCK_LIST))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality, op2_licenses, op3_secrets, op4_bpe, op5_main_text, op6_toxicity, op7_near_duplicates, op8_decontamination, op9_url_filter, op10_nearest, op11_source_divergence, op12_lexical_search, op13_token_counts)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Every pair of sets that shares a shingle, counted; links followed to their ends.
NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, got) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.got),
k AS (SELECT doc_id, min(got) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN k USING (doc_id)"""

#: Every window of every item against every window of every document, as text.
DECONTAMINATION_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
v AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda j: array_to_string(w[j : j + least(10, len(w)) - 1], ' '))) AS x FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM v),
d AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, unnest(list_transform(range(1, len(w) - size + 2), lambda j: array_to_string(w[j : j + size - 1], ' '))) AS x FROM w, sizes WHERE len(w) >= size),
m AS (SELECT doc_id, d.size, pos, item_id FROM d JOIN v ON d.size = v.size AND d.x = v.x),
h AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM m) GROUP BY doc_id),
k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""


#: Every group of a language against every other, over all kept terms.
DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v)::HUGEINT AS p FROM n JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term),
ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY lang),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v)::HUGEINT AS q FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)) WHERE part = 'pair' OR rank <= 50"""

#: Every item's terms against every document's.
LEXICAL_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(w)) AS l FROM d WHERE len(w) > 0),
p AS (SELECT r, w AS term, count(*) AS tf FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
w AS (SELECT i, item_id, term, times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), s),
m AS (SELECT r, doc_id, 25 + (75 * len(w)::BIGINT * n_docs) // l::BIGINT AS m FROM d, s),
x AS (SELECT i, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM w JOIN p USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank FROM x WHERE score > 0) WHERE rank <= 10"""


def url_filter_sql() -> str:
    """Every URL against every rule and every entry of the list."""
    rules = ", ".join(f"('{verdict}', '{entry}')" for verdict, entry in urlfilter.RULES)
    listed = ", ".join(f"('{entry}')" for entry in urlfilter.read_list())

    def fits(entry: str) -> str:
        host, path = f"regexp_extract({entry}, '^[^/]*')", f"regexp_extract({entry}, '/.*$')"
        return f"(host = {host} OR ends_with(host, '.' || {host})) AND starts_with(path, {path})"

    return f"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://((?s:.*))$', 1) END AS rest FROM pages),
s AS (SELECT r, page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
rules(verdict, rule) AS (VALUES {rules}),
list(listed) AS (VALUES {listed}),
f AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM s JOIN rules ON {fits("rule")} GROUP BY r),
b AS (SELECT r, arg_max(listed, length(listed)) AS listed FROM s JOIN list ON {fits("listed")} GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed FROM s LEFT JOIN f USING (r) LEFT JOIN b USING (r)"""


ORACLE_SQL: dict[str, str] = {"op2_licenses": licenses.oracle_sql(), "op7_near_duplicates": NEAR_DUPLICATES_SQL, "op8_decontamination": DECONTAMINATION_SQL, "op9_url_filter": url_filter_sql(), "op11_source_divergence": DIVERGENCE_SQL, "op12_lexical_search": LEXICAL_SQL}
