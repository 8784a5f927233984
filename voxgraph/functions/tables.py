"""Small relational tools on rows of numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(df: DataFrame, columns: Sequence[str], index: str) -> DataFrame:
    """Distinct rows with the first index of each."""
    return df.groupBy(*columns).agg(F.min(index).alias("first_index"))


def matching_rows(x: DataFrame, y: DataFrame, columns: Sequence[str], index: str) -> DataFrame:
    """(x_index, y_index) of rows of y that x has; of equal rows of x the last counts."""
    last = x.groupBy(*columns).agg(F.max(index).alias("x_index"))
    return y.withColumnRenamed(index, "y_index").join(last, list(columns)).select("x_index", "y_index")


def rows_within(df: DataFrame, columns: Sequence[str], values: DataFrame, value: str) -> DataFrame:
    """Rows of which every one of the columns is among the values."""
    return reduce(lambda d, c: d.join(values.select(F.col(value).alias(c)).distinct(), c, "left_semi"), columns, df).select(*df.columns)


def replaced(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Values looked up in a mapping; a value that it lacks is an error."""
    m = mapping.select(F.col(key).alias(column), F.col(value).alias("_to"))
    out = df.join(m, column, "left")
    missing = F.raise_error(F.concat(F.lit("no entry for "), F.col(column).cast("string")))
    return out.withColumn(column, F.when(F.col("_to").isNull() & F.col(column).isNotNull(), missing).otherwise(F.col("_to"))).select(*df.columns)


def cartesian(*sets: DataFrame) -> DataFrame:
    """Every combination of rows of small sets."""
    return reduce(lambda a, b: a.crossJoin(b), sets)


def node_pairs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges between any two of the nodes."""
    a, b = nodes.select(F.col("node").alias("u")), nodes.select(F.col("node").alias("v"))
    return edges.join(a, "u", "left_semi").join(b, "v", "left_semi").select(*edges.columns)


def edge_permutation(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_id, b_id): the same edges in two numberings, ends in any order."""

    def canonical(e: DataFrame, name: str) -> DataFrame:
        return e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.col("edge_id").alias(name))

    return canonical(a, "a_id").join(canonical(b, "b_id"), ["u", "v"]).select("a_id", "b_id")
