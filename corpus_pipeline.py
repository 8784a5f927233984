"""From raw documents to token ids: five stages, each one operator of ``voxgraph.llm``.

Every stage reads all that the stage before it kept, and its decisions take
effect.  All but the last return the columns of ``documents``.

Rows: texts decide, and ids only which document of a group of near duplicates
stays, the one of least id; a row without an id is never dropped as a duplicate,
and rows that share an id stay or go as duplicates together.  Null and empty texts
are neither toxic, nor duplicates, nor hit: they pass through all stages and have
no tokens.  Empty tables give no rows, and further columns go.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxgraph.llm import kernels as K
from voxgraph.llm import bpe, decontam, neardup, secrets, toxicity
from voxgraph.llm.queries import tokenizer_path, toxicity_model
from voxgraph.plans.lineage import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; it is fitted on the labelled ones."""
    docs = docs.select(*COLUMNS)
    return toxicity.drop_toxic(docs, toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    return neardup.drop_near_duplicates(docs.select(*COLUMNS), neardup.Rule(words=5, num=80, den=100))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a span with a benchmark item go; each row is judged by its own text, whatever its id."""
    return decontam.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, which all stay."""
    return secrets.redact(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as token ids."""
    return bpe.encode(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage with Arrow batches that suit long texts."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        K.small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _bounded(toxic)),
    ("near_duplicates", _bounded(near_duplicates)),
    ("benchmark", _bounded(benchmark)),
    ("secrets", _bounded(secret_scan)),
    ("bpe", _bounded(tokens)),
]

#: The stages are not SQL: they are tested against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each stage's rows written to the checkpoint folder before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
