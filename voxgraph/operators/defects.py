"""Defective slices and regions: finding them, bridging the graph over them, repairing the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.functions.ids import runs
from voxgraph.operators.blocking import in_blocks
from voxgraph.operators.features import edge_statistics
from voxgraph.operators.rag import Z_BOTH, Z_LOWER
from voxgraph.plans.lineage import cut


def segments_per_slice(voxels: DataFrame, seg: str = "seg") -> DataFrame:
    return voxels.groupBy("z").agg(F.count_distinct(F.col(seg)).alias("n_segs"))


def segments_per_patch(voxels: DataFrame, patch: int, seg: str = "seg") -> DataFrame:
    """Numbers of segments in square tiles of slices."""
    return voxels.groupBy("z", F.expr(f"y div {patch}").alias("py"), F.expr(f"x div {patch}").alias("px")).agg(F.count_distinct(F.col(seg)).alias("n_segs"))


def statistics(counts: DataFrame, value: str = "n_segs") -> DataFrame:
    return counts.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("lo"), F.max(value).alias("hi"))


def histogram(counts: DataFrame, bins: int = 16, value: str = "n_segs") -> DataFrame:
    """(bin, n, left): equal bins over the range, the last one closed; a range of one value is widened by a half on both sides."""
    s = counts.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    s = s.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    every = s.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("left"))
    at = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins))).cast("int")
    n = counts.crossJoin(F.broadcast(s)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    return every.join(n, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "left")


def defect_slices(counts: DataFrame, bins: int = 16, threshold: int = 2) -> DataFrame:
    """Slices with fewer segments than the left edge of the threshold's bin; threshold 0 finds none."""
    if threshold == 0:
        return counts.where(F.lit(False)).select("z")
    edge = histogram(counts, bins).where(F.col("bin") == threshold).select(F.col("left").alias("_edge"))
    return counts.crossJoin(F.broadcast(edge)).where("n_segs < _edge").select("z")


def defect_patches(voxels: DataFrame, shape: tuple[int, int], patch: int, overlap: int, threshold: float = 0.15, seg: str = "seg") -> DataFrame:
    """(z, patch_id, n_segs) of tiles with a halo that have fewer segments than the threshold's share of the mean."""
    v = in_blocks(voxels.withColumn("_s", F.col("z")).withColumn("z", F.lit(0)).withColumn("_n", F.col(seg)), (1, *shape), (1, patch, patch), (0, overlap, overlap))
    n = v.groupBy(F.col("_s").alias("z"), F.col("block_id").alias("patch_id")).agg(F.count_distinct(F.col("_n")).alias("n_segs"))
    return n.crossJoin(F.broadcast(n.agg(F.avg("n_segs").alias("_mean")))).where(F.col("n_segs") < threshold * F.col("_mean")).select("z", "patch_id", "n_segs")


def defect_mask(voxels: DataFrame, slices: DataFrame) -> DataFrame:
    """Voxels with is_defect."""
    return voxels.join(slices.select("z", F.lit(True).alias("_d")), "z", "left").withColumn("is_defect", F.coalesce("_d", F.lit(False))).drop("_d")


def defect_nodes(masked: DataFrame, slice_threshold: float = 0.5, seg: str = "seg") -> DataFrame:
    """(node, z): regions that touch the mask; all regions of a slice of which more than the threshold do."""
    touched = masked.groupBy("z", F.col(seg).alias("node")).agg(F.max(F.col("is_defect").cast("int")).alias("bad"))
    share = touched.groupBy("z").agg(F.avg("bad").alias("share"))
    return touched.join(share, "z").where((F.col("bad") == 1) | (F.col("share") > slice_threshold)).select("node", "z")


def defect_nodes_from_probability(nodes: DataFrame, prob: str = "prob", node_threshold: float = 0.5, slice_threshold: float = 0.5) -> DataFrame:
    """The same from each region's probability to be defective."""
    flagged = nodes.withColumn("bad", (F.col(prob) > node_threshold).cast("int"))
    share = flagged.groupBy("z").agg(F.avg("bad").alias("share"))
    return flagged.join(share, "z").where((F.col("bad") == 1) | (F.col("share") > slice_threshold)).select("node", "z")


def skip_edges(voxels: DataFrame, slices: DataFrame, seg: str = "seg") -> DataFrame:
    """(u, v, skip_start, skip_range, length): regions above and below each run of defective slices that share columns of voxels.

    Only the good slices beside a run are read, and joined on their columns.
    """
    gaps = runs(slices.select("z").distinct(), "z").groupBy("run").agg(F.max("z").alias("last")).select((F.col("run") - 1).cast("int").alias("lo"), (F.col("last") + 1).cast("int").alias("hi"))
    below = voxels.select(F.col("z").alias("lo"), "y", "x", F.col(seg).alias("a")).join(gaps, "lo")
    above = voxels.select(F.col("z").alias("hi"), "y", "x", F.col(seg).alias("b")).join(gaps.select("hi"), "hi", "left_semi")
    pairs = below.join(above, ["hi", "y", "x"])
    return pairs.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.col("lo").alias("skip_start"), (F.col("hi") - F.col("lo")).alias("skip_range")).agg(F.count("*").alias("length"))


def skip_border_values(voxels: DataFrame, slices: DataFrame, values: Sequence[str] = ("value",), seg: str = "seg", z_direction: int = Z_BOTH) -> DataFrame:
    """(u, v, edge_type, values) along skip edges, for edge_statistics: the values below the run, above it or both, by direction."""
    gaps = runs(slices.select("z").distinct(), "z").groupBy("run").agg(F.max("z").alias("last")).select((F.col("run") - 1).cast("int").alias("lo"), (F.col("last") + 1).cast("int").alias("hi"))
    below = voxels.select(F.col("z").alias("lo"), "y", "x", F.col(seg).alias("a"), F.struct(*values).alias("below")).join(gaps, "lo")
    above = voxels.select(F.col("z").alias("hi"), "y", "x", F.col(seg).alias("b"), F.struct(*values).alias("above"))
    sides = ["below", "above"] if z_direction == Z_BOTH else ["below" if z_direction == Z_LOWER else "above"]
    pairs = below.join(above, ["hi", "y", "x"])
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.lit("skip").alias("edge_type"), F.explode(F.array(*sides)).alias("_v")).select("u", "v", "edge_type", "_v.*")


def skip_filter_features(responses: DataFrame, slices: DataFrame, channels: Sequence[str], seg: str = "seg", z_direction: int = Z_BOTH, ranked: bool = False) -> DataFrame:
    """Nine statistics of every filter channel along skip edges; columns meet once for all channels."""
    values = skip_border_values(responses, slices, channels, seg, z_direction)
    return edge_statistics(cut(values) if ranked else values, channels, prefixed=True, ranked=ranked)


def modified_adjacency(edges: DataFrame, bad_nodes: DataFrame, skips: DataFrame) -> DataFrame:
    """(u, v, edge_type, length, is_ignored, skip_start, skip_range): edges between slices that join a defective region to a good one go, such in-slice edges are to be ignored, skip edges come."""
    bad = bad_nodes.select(F.col("node"), F.lit(1).alias("_b")).distinct()
    e = edges
    for side in ("u", "v"):
        e = e.join(bad.select(F.col("node").alias(side), F.col("_b").alias(f"_b{side}")), side, "left")
    mixed = F.col("_bu").isNull() != F.col("_bv").isNull()
    none = F.lit(None).cast("int")
    kept = e.where(~(mixed & (F.col("edge_type") == "z"))).select("u", "v", "edge_type", "length", (mixed & (F.col("edge_type") == "xy")).alias("is_ignored"), none.alias("skip_start"), none.alias("skip_range"))
    return kept.unionByName(skips.select("u", "v", F.lit("skip").alias("edge_type"), "length", F.lit(False).alias("is_ignored"), "skip_start", "skip_range"))


def bridged(voxels: DataFrame, edges: DataFrame, slices: DataFrame, bad_nodes: DataFrame | None = None, seg: str = "seg", ignore_label: int = -1) -> DataFrame:
    """The modified adjacency of a volume with defective slices, whose regions are defective (and ``bad_nodes`` besides).

    A run of slices at an end of the volume has no skip edges.  Regions are flat, so that a pair of them has one skip edge at most.
    """
    of_slices = voxels.join(slices.select("z").distinct(), "z", "left_semi").select(F.col(seg).alias("node"))
    bad = of_slices if bad_nodes is None else of_slices.unionByName(bad_nodes.select("node"))
    skips = skip_edges(voxels, slices, seg).where((F.col("u") != F.col("v")) & (F.col("u") != ignore_label) & (F.col("v") != ignore_label))
    return modified_adjacency(edges, bad, skips)


def is_sorted(df: DataFrame, order: str, value: str) -> DataFrame:
    """One row: whether the values never fall in the given order."""
    placed = cut(df.select(F.col(order).alias("at"), F.col(value).alias("x")).repartitionByRange("at").withColumn("part", F.spark_partition_id()))
    inside = placed.select((F.col("x") < F.lag("x").over(Window.partitionBy("part").orderBy("at"))).alias("falls"))
    # Ranges meet at their ends, one row each.
    ends = placed.groupBy("part").agg(F.min_by("x", "at").alias("first"), F.max_by("x", "at").alias("last"))
    between = ends.select((F.col("first") < F.lag("last").over(Window.orderBy("part"))).alias("falls"))
    return inside.unionByName(between).agg((~F.coalesce(F.bool_or("falls"), F.lit(False))).alias("is_sorted"))


def has_lower_defect(slices: DataFrame) -> DataFrame:
    """(z, has_lower): whether the slice before is defective too."""
    return runs(slices.select("z").distinct(), "z").select("z", (F.col("pos") > 1).alias("has_lower"))


def replacement_slices(slices: DataFrame, n_slices: int) -> DataFrame:
    """(z, source): the good slice that stands in for each defective one; runs of more than four slices are an error.

    Slices in the first half of a run take the one before it, those in the second
    half the one after it; a middle slice takes the side before.  Where a side does
    not exist the other one is taken.
    """
    r = runs(slices.select("z").distinct(), "z").withColumn("last", F.col("run") + F.col("run_len") - 1)
    before, after = F.col("run") - 1, F.col("last") + 1
    first_half = F.col("pos") <= F.ceil(F.col("run_len") / 2)
    source = F.when(first_half, F.when(F.col("run") > 0, before).otherwise(after)).otherwise(F.when(F.col("last") < n_slices - 1, after).otherwise(before))
    return r.select("z", F.when(F.col("run_len") > 4, F.raise_error(F.lit("more than four defective slices in a row"))).otherwise(source).cast("int").alias("source"))


def replace_slices(voxels: DataFrame, sources: DataFrame, label: str = "seg") -> DataFrame:
    """Voxels of defective slices take the labels of their source slice; each good slice is read once."""
    wanted = sources.select(F.col("source").alias("z"), F.col("z").alias("_to"))
    copies = voxels.join(wanted, "z").select(F.col("_to").alias("z"), "y", "x", F.col(label).alias("_label"))
    rest = voxels.join(sources.select("z"), "z", "left_anti")
    fixed = voxels.join(sources.select("z"), "z", "left_semi").join(copies, ["z", "y", "x"]).withColumn(label, F.col("_label")).drop("_label")
    return rest.unionByName(fixed.select(*voxels.columns))
