"""Regular blocks with halos, and what lies in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.plans.lineage import large
from voxgraph.sources.volume import AXES


def blocks(spark: SparkSession, shape: Sequence[int], block: Sequence[int], overlap: Sequence[int] = (0, 0, 0)) -> DataFrame:
    """(block_id, z0, z1, ..., oz0, oz1, ...): half-open inner boxes and boxes with a halo on both sides, clipped to the volume.  Blocks are numbered in z, y, x order."""
    out = spark.range(1).select()
    for axis, n, b, o in zip(AXES, shape, block, overlap, strict=True):
        count = -(-n // b)
        lo = F.col(f"n{axis}") * b
        one = spark.range(count).select(F.col("id").cast("int").alias(f"n{axis}")).withColumns(
            {f"{axis}0": lo.cast("int"), f"{axis}1": F.least(lo + b, F.lit(n)).cast("int"), f"o{axis}0": F.greatest(lo - o, F.lit(0)).cast("int"), f"o{axis}1": F.least(lo + b + o, F.lit(n)).cast("int"), f"c{axis}": F.lit(count)}
        )
        out = out.crossJoin(one)
    number = (F.col("nz") * F.col("cy") + F.col("ny")) * F.col("cx") + F.col("nx")
    return out.withColumn("block_id", number.cast("int")).select("block_id", *(f"{p}{a}{e}" for p in ("", "o") for a in AXES for e in (0, 1)))


def halo_tiles(spark: SparkSession, shape: Sequence[int], size: Sequence[int], overlap: Sequence[int]) -> DataFrame:
    """(tile_id, z0, z1, ...): boxes that reach back into the one before (but the first) and forward by the overlap, clipped."""
    return blocks(spark, shape, size, overlap).select(F.col("block_id").alias("tile_id"), *(F.col(f"o{a}{e}").alias(f"{a}{e}") for a in AXES for e in (0, 1)))


def in_blocks(voxels: DataFrame, shape: Sequence[int], block: Sequence[int], overlap: Sequence[int]) -> DataFrame:
    """Voxels with the id of every block whose box with halo holds them.

    Candidate blocks follow from the coordinates by arithmetic, so there is no join:
    each voxel is repeated for its own blocks only.
    """
    out = voxels
    counts = [-(-n // b) for n, b in zip(shape, block, strict=True)]
    for axis, n, b, o in zip(AXES, counts, block, overlap, strict=True):
        first = F.greatest(F.lit(0), F.floor((F.col(axis) - o) / b)).cast("int")
        last = F.least(F.lit(n - 1), F.floor((F.col(axis) + o) / b)).cast("int")
        out = out.withColumn(f"_n{axis}", F.explode(F.sequence(first, last)))
    number = (F.col("_nz") * counts[1] + F.col("_ny")) * counts[2] + F.col("_nx")
    return out.withColumn("block_id", number.cast("int")).drop("_nz", "_ny", "_nx")


def nodes_to_blocks(voxels: DataFrame, shape: Sequence[int], block: Sequence[int], overlap: Sequence[int], seg: str = "seg", skip_slices: DataFrame | None = None) -> DataFrame:
    """(block_id, node): regions that touch a block's box with halo, defective slices left out."""
    v = voxels if skip_slices is None else voxels.join(skip_slices.select("z"), "z", "left_anti")
    return in_blocks(v.select("z", "y", "x", F.col(seg).alias("node")), shape, block, overlap).select("block_id", "node").distinct()


def _binned(boxes: DataFrame, first: str, last: str, sizes: DataFrame) -> DataFrame:
    """Boxes with the bins (bz, by, bx) that their intervals touch; bins are as large as the largest box, so that they are few for each."""
    out = boxes.crossJoin(F.broadcast(sizes))  # one row
    for axis in AXES:
        lo, hi = F.col(first.format(axis)), F.col(last.format(axis))
        out = out.withColumn(f"b{axis}", F.explode(F.sequence(F.floor(lo / F.col(f"s{axis}")), F.floor((hi - 1) / F.col(f"s{axis}")))))
    return out.drop(*(f"s{a}" for a in AXES))


def _extent(boxes: DataFrame, first: str, last: str) -> DataFrame:
    return boxes.agg(*(F.max(F.col(last.format(a)) - F.col(first.format(a))).alias(f"s{a}") for a in AXES))


_BINS = [f"b{a}" for a in AXES]


def block_graph(boxes: DataFrame, nearest_only: bool = False) -> DataFrame:
    """(a, b): blocks whose boxes with halo overlap, a < b; only those that are shifted along one axis if nearest.

    Boxes that overlap share a bin of space, so that blocks meet their neighbours only.  A single block has no neighbour.
    """
    binned = _binned(boxes, "o{}0", "o{}1", _extent(boxes, "o{}0", "o{}1"))
    a = binned.select(*_BINS, *(F.col(c).alias(f"a_{c}") for c in boxes.columns))
    b = binned.select(*_BINS, *(F.col(c).alias(f"b_{c}") for c in boxes.columns))
    cond = F.col("a_block_id") < F.col("b_block_id")
    for axis in AXES:
        cond = cond & (F.col(f"a_o{axis}0") < F.col(f"b_o{axis}1")) & (F.col(f"b_o{axis}0") < F.col(f"a_o{axis}1"))
    if nearest_only:
        cond = cond & (sum((F.col(f"a_{x}0") != F.col(f"b_{x}0")).cast("int") for x in AXES) == 1)
    return a.join(large(b), _BINS).where(cond).select(F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b")).distinct()


def blocks_inside(small: DataFrame, large: DataFrame) -> DataFrame:
    """(large_id, block_id): blocks of a fine level that lie in the inner boxes of a coarse one."""
    cond = F.lit(True)
    for a in AXES:
        cond = cond & (F.col(f"{a}0") >= F.col(f"l_{a}0")) & (F.col(f"{a}1") <= F.col(f"l_{a}1"))
    big = large.select(F.col("block_id").alias("large_id"), *(F.col(f"{a}{e}").alias(f"l_{a}{e}") for a in AXES for e in (0, 1)))
    sizes = _extent(big, "l_{}0", "l_{}1")
    corner = small.crossJoin(F.broadcast(sizes)).withColumns({f"b{a}": F.floor(F.col(f"{a}0") / F.col(f"s{a}")) for a in AXES})
    return corner.join(_binned(big, "l_{}0", "l_{}1", sizes), _BINS).where(cond).select("large_id", "block_id")


def _ends(edges: DataFrame, block_nodes: DataFrame) -> DataFrame:
    """Each edge in each block that has one of its ends, with the number of ends there."""
    u = edges.join(large(block_nodes.withColumnRenamed("node", "u")), "u").withColumn("inside", F.col("u"))
    v = edges.join(large(block_nodes.withColumnRenamed("node", "v")), "v").withColumn("inside", F.col("v"))
    return u.unionByName(v).groupBy("block_id", *edges.columns).agg(F.count("*").alias("ends"), F.max("inside").alias("inside"))


def inner_edges(edges: DataFrame, block_nodes: DataFrame, least: int = 1) -> DataFrame:
    """Edges with both ends in a block; blocks with fewer than ``least`` are left out."""
    inner = _ends(edges, block_nodes).where("ends = 2").drop("ends", "inside")
    if least <= 1:
        return inner
    enough = inner.groupBy("block_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("block_id")
    return inner.join(enough, "block_id", "left_semi")


def outer_edges(edges: DataFrame, block_nodes: DataFrame) -> DataFrame:
    """Edges with exactly one end in a block."""
    return _ends(edges, block_nodes).where("ends = 1").drop("ends", "inside")


def edges_between_blocks(edges: DataFrame, block_nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, edge columns): edges that leave block a and end in its neighbour b, or the reverse, each once for a pair."""
    leaving = _ends(edges, block_nodes).where("ends = 1").withColumn("node", F.col("u") + F.col("v") - F.col("inside"))
    found = leaving.join(large(block_nodes.withColumnRenamed("block_id", "other")), "node").where("other <> block_id")
    found = found.withColumns({"a": F.least("block_id", "other"), "b": F.greatest("block_id", "other")})
    return found.join(large(pairs), ["a", "b"]).select("a", "b", *edges.columns).distinct()


def subproblem_nodes(block_nodes: DataFrame, node_map: DataFrame) -> DataFrame:
    """Nodes of blocks in the numbering of a reduced problem."""
    return block_nodes.join(large(node_map), "node").select("block_id", F.col("component").alias("node")).distinct()
