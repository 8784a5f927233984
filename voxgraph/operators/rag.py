"""Region adjacency graphs of flat superpixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.functions.ids import dense_ids
from voxgraph.operators.labels import neighbours_in_slice

Z_BOTH, Z_LOWER, Z_UPPER = 0, 1, 2


def adjacent_voxels(voxels: DataFrame, seg: str = "seg", *values: str, kinds: tuple[str, ...] = ("xy", "z")) -> DataFrame:
    """(edge_type, z, u, v, values, n_*): neighbouring voxels of different regions, u < v, values in the order of the voxels.

    Each part is one exchange of the voxels, by slice or by column, and no join.
    """
    out = None
    if "xy" in kinds:
        out = neighbours_in_slice(voxels, seg, *values).drop("dy", "dx").withColumn("edge_type", F.lit("xy"))
    if "z" in kinds:
        w = Window.partitionBy("y", "x").orderBy("z")
        up = voxels.select("z", "y", "x", seg, *values).withColumns({f"n_{c}": F.lead(c).over(w) for c in ("z", seg, *values)})
        up = up.where("n_z = z + 1").drop("n_z").withColumn("edge_type", F.lit("z"))
        out = up if out is None else out.unionByName(up)
    a, b = F.col(seg), F.col(f"n_{seg}")
    return out.where(a != b).select("edge_type", "z", F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), *values, *(f"n_{c}" for c in values))


def rag_edges(voxels: DataFrame, seg: str = "seg", ignore_label: int = -1) -> DataFrame:
    """(u, v, edge_type, z, length): pairs of regions, the lower slice, and the number of neighbouring voxel pairs; edges at the ignored label are left out."""
    pairs = adjacent_voxels(voxels, seg).where((F.col("u") != ignore_label) & (F.col("v") != ignore_label))
    return pairs.groupBy("u", "v", "edge_type").agg(F.min("z").alias("z"), F.count("*").alias("length"))


def rag_nodes(voxels: DataFrame, seg: str = "seg") -> DataFrame:
    """(node, z): regions and their slice."""
    return voxels.groupBy(F.col(seg).alias("node")).agg(F.min("z").alias("z"))


def with_edge_ids(edges: DataFrame) -> DataFrame:
    """Ids from 0 in the order edge type, u, v, so that all in-slice edges come first."""
    return dense_ids(edges, ["edge_type", "u", "v"], "edge_id")


def graph_size(voxels: DataFrame, edges: DataFrame, seg: str = "seg") -> DataFrame:
    """(n_nodes, n_edges, n_xy, n_z); nodes are numbered from 0."""
    kinds = edges.agg(F.count("*").alias("n_edges"), F.count_if(F.col("edge_type") == "xy").alias("n_xy"), F.count_if(F.col("edge_type") == "z").alias("n_z"))
    return voxels.agg((F.max(seg) + 1).alias("n_nodes")).crossJoin(kinds)
