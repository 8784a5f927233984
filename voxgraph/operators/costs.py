"""From edge probabilities to signed costs, and ground truth of edges."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.plans.lineage import large

#: Probabilities are kept this far from 0 and 1.
MARGIN = 0.001


def bias(beta: float) -> float:
    return 0.0 if beta == 0.5 else math.log((1 - beta) / beta)


def cost_of(p: Column, beta: float = 0.5) -> Column:
    """Log odds against a cut; positive costs attract."""
    inner = (1 - 2 * MARGIN) * F.when(F.isnan(p), 0.5).otherwise(p) + MARGIN
    return F.log((1 - inner) / inner) + bias(beta)


def weighted(edges: DataFrame, scheme: str = "z", weight: float = 16.0, cost: str = "cost", length: str = "length") -> DataFrame:
    """Costs scaled by relative length: ``z`` only between slices, ``xyz`` by the greatest of each kind, ``all`` by the greatest of all, other schemes not at all.

    Skip edges are edges between slices.  A kind without edges leaves costs as they are.
    """
    if scheme not in ("z", "xyz", "all"):
        return edges
    between = F.col("edge_type").isin("z", "skip")
    most = edges.agg(F.max(F.when(between, F.col(length))).alias("_z"), F.max(F.when(F.col("edge_type") == "xy", F.col(length))).alias("_xy"), F.max(length).alias("_all"))
    z_cost = F.col(cost) * weight * F.col(length) / F.col("_z")
    scaled = {
        "z": F.when(between, z_cost).otherwise(F.col(cost)),
        "xyz": F.when(between, z_cost).when(F.col("edge_type") == "xy", F.col(cost) * weight * F.col(length) / F.col("_xy")).otherwise(F.col(cost)),
        "all": F.col(cost) * weight * F.col(length) / F.col("_all"),
    }[scheme]
    return edges.crossJoin(F.broadcast(most)).withColumn(cost, scaled).drop("_z", "_xy", "_all")


def ignore_costs(edges: DataFrame, flag: str = "is_ignored", cost: str = "cost") -> DataFrame:
    """Ignored edges repel most: twice the least cost."""
    least = edges.agg(F.min(cost).alias("_least"))
    return edges.crossJoin(F.broadcast(least)).withColumn(cost, F.when(F.col(flag), 2 * F.col("_least")).otherwise(F.col(cost))).drop("_least")


def multicut_problem(edges: DataFrame, probabilities: DataFrame, beta: float = 0.5, scheme: str = "z", weight: float = 16.0) -> DataFrame:
    """(u, v, edge_type, length, prob, cost); a cost that is not finite is an error.

    Of edges with ``is_ignored``, those so marked repel most, whatever their probability.
    """
    joined = edges.join(probabilities.select("u", "v", "edge_type", "prob"), ["u", "v", "edge_type"])
    out = weighted(joined.withColumn("cost", cost_of(F.col("prob"), beta)), scheme, weight)
    if "is_ignored" in edges.columns:
        out = ignore_costs(out)
    bad = F.isnan("cost") | (F.abs("cost") == float("inf"))
    return out.withColumn("cost", F.when(bad, F.raise_error(F.lit("a cost is not finite"))).otherwise(F.col("cost"))).select("u", "v", "edge_type", "length", "prob", "cost")


def cost_statistics(edges: DataFrame, cost: str = "cost") -> DataFrame:
    """Mean, standard deviation, least and greatest cost of each kind of edge."""
    return edges.groupBy("edge_type").agg(F.avg(cost).alias("mean"), F.stddev_pop(cost).alias("std"), F.min(cost).alias("min"), F.max(cost).alias("max"))


def node_truth(voxels: DataFrame, seg: str = "seg", gt: str = "gt") -> DataFrame:
    """(node, gt): the label that most of a region's voxels have, the smallest of equals."""
    n = voxels.groupBy(F.col(seg).alias("node"), F.col(gt).alias("gt")).agg(F.count("*").alias("n"))
    return n.groupBy("node").agg(F.max_by("gt", F.struct("n", -F.col("gt"))).alias("gt"))


def edge_truth(edges: DataFrame, truth: DataFrame, ignore_label: int = -1) -> DataFrame:
    """(u, v, edge_type, u_gt, v_gt, is_cut, is_labelled)."""
    a = truth.select(F.col("node").alias("u"), F.col("gt").alias("u_gt"))
    b = truth.select(F.col("node").alias("v"), F.col("gt").alias("v_gt"))
    return edges.join(large(a), "u").join(large(b), "v").select(
        "u", "v", "edge_type", "u_gt", "v_gt", (F.col("u_gt") != F.col("v_gt")).cast("int").alias("is_cut"), ((F.col("u_gt") != ignore_label) & (F.col("v_gt") != ignore_label)).alias("is_labelled")
    )


def clipped(probabilities: DataFrame, prob: str = "prob") -> DataFrame:
    """Predictions that are NaN or infinite are undecided."""
    return probabilities.withColumn(prob, F.when(F.isnan(prob) | (F.abs(prob) == float("inf")), 0.5).otherwise(F.col(prob)))


def max_by_kind(edges: DataFrame, value: str = "length") -> DataFrame:
    """Edges with the greatest value of their kind beside them."""
    return edges.withColumn(f"max_{value}", F.max(value).over(Window.partitionBy("edge_type")))
