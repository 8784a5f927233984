"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.plans.lineage import cut


def ranked_quantiles(values: DataFrame, keys: Sequence[str], columns: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """(keys, columns): for each group and column an array of its interpolated quantiles, as ``percentile`` gives them.

    Equal values are counted before the shuffle.  What is left is dealt by ranges of group, column and value, so that a large group
    is many tasks; each counts its own stretch, and the totals of the stretches before it (one row for each) make ranks of it.  No
    group is held in memory.  Nulls do not count; a group without other values has a null array.
    """
    keys = list(keys)
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns))))
    counted = values.select(*keys, each.alias("_e")).select(*keys, F.col("_e.c").alias("_c"), F.col("_e.v").alias("_v")).where("_v is not null").groupBy(*keys, "_c", "_v").agg(F.count("*").alias("_n"))
    placed = cut(counted.repartitionByRange(*keys, "_c", "_v").withColumn("_part", F.spark_partition_id()))
    group = [*keys, "_c"]
    of = Window.partitionBy(*group)
    stretches = placed.groupBy(*group, "_part").agg(F.sum("_n").alias("_own"))
    stretches = stretches.select(*group, "_part", (F.sum("_own").over(of.orderBy("_part")) - F.col("_own")).alias("_before"), F.sum("_own").over(of).alias("_all"))
    within = Window.partitionBy("_part", *group).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("_to", F.sum("_n").over(within)).join(stretches, [*group, "_part"])
    end = F.col("_before") + F.col("_to")
    at = [F.lit(float(q)) * (F.col("_all") - 1) for q in quantiles]

    def value_at(rank):
        """The value whose equal ones take the ranks around this one."""
        return F.max(F.when((rank < end) & (rank >= end - F.col("_n")), F.col("_v")))

    picks = [p.alias(f"{side}{i}") for i, x in enumerate(at) for side, p in (("lo", value_at(F.floor(x))), ("hi", value_at(F.ceil(x))))]
    found = ranked.groupBy(*group, "_all").agg(*picks)
    made = F.array(*(F.col(f"lo{i}") + (x - F.floor(x)) * (F.col(f"hi{i}") - F.col(f"lo{i}")) for i, x in enumerate(at)))
    one = found.select(*group, made.alias("_q"))
    wide = one.groupBy(*keys).agg(*(F.max(F.when(F.col("_c") == i, F.col("_q"))).alias(c) for i, c in enumerate(columns)))
    return wide
