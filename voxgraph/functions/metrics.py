"""How far a segmentation is from the truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(voxels: DataFrame, seg: str = "seg", gt: str = "gt", ignore_gt: int = 0) -> DataFrame:
    """(s, g, n): voxels of each pair of labels; voxels of the ignored truth are left out."""
    return voxels.where(F.col(gt) != ignore_gt).groupBy(F.col(seg).alias("s"), F.col(gt).alias("g")).agg(F.count("*").alias("n"))


def scores(voxels: DataFrame, seg: str = "seg", gt: str = "gt", ignore_gt: int = 0) -> DataFrame:
    """One row: vi_split, vi_merge (bits) and adapted_rand error; lower is better."""
    table = contingency(voxels, seg, gt, ignore_gt)
    s = table.groupBy("s").agg(F.sum("n").alias("n"))
    g = table.groupBy("g").agg(F.sum("n").alias("n"))

    def sums(t: DataFrame, name: str) -> DataFrame:
        return t.agg(F.sum(F.col("n") * F.log2("n")).alias(f"h_{name}"), F.sum(F.col("n").cast("double") * F.col("n")).alias(f"q_{name}"), F.sum("n").alias(f"n_{name}"))

    one = sums(table, "sg").crossJoin(sums(s, "s")).crossJoin(sums(g, "g"))
    n = F.col("n_sg")
    precision, recall = F.col("q_sg") / F.col("q_s"), F.col("q_sg") / F.col("q_g")
    return one.select(
        ((F.col("h_g") - F.col("h_sg")) / n).alias("vi_split"),
        ((F.col("h_s") - F.col("h_sg")) / n).alias("vi_merge"),
        (1 - 2 * precision * recall / (precision + recall)).alias("adapted_rand"),
    )
