"""Dense ids without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.plans.lineage import cut


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with consecutive ids in the order of columns that identify its rows.

    Rows are range partitioned; each partition counts its own, and the partitions'
    running totals (one row each) are added.
    """
    placed = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.withColumn("_nth", within).join(F.broadcast(totals), "_part").withColumn(name, F.col("_before") + F.col("_nth") - 1 + start).drop("_part", "_nth", "_before")


def prefix_offsets(totals: DataFrame, key: str, size: str, name: str = "offset", start: int = 0) -> DataFrame:
    """Exclusive running sums of a small table, one row for each slice or block."""
    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(size).over(w), F.lit(0)) + start)


def runs(df: DataFrame, key: str, name: str = "run") -> DataFrame:
    """Consecutive integers get one run number, the first of the run; ``pos`` counts from 1 within it, ``run_len`` is its length."""
    placed = dense_ids(df, [key], "_rn").withColumn("_g", F.col(key) - F.col("_rn"))
    own = placed.groupBy("_g").agg(F.min(key).alias(name), F.count("*").alias("run_len"))
    return placed.join(own, "_g").withColumn("pos", (F.col(key) - F.col(name) + 1).cast("int")).drop("_rn", "_g")
