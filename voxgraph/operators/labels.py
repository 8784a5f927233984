"""Voxel and label algebra: maps, masks, offsets, relabelling, components of equal labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.functions.ids import dense_ids, prefix_offsets
from voxgraph.operators.graph import connected_components

MAX_LABEL = (1 << 32) - 1


def boundary_map(voxels: DataFrame, invert: bool = False, value: str = "prob", mask: str | None = "mask") -> DataFrame:
    """The map that is flooded: optionally inverted, and 1 outside the mask."""
    p = 1 - F.col(value) if invert else F.col(value)
    return voxels.withColumn(value, F.when(~F.col(mask), F.lit(1.0)).otherwise(p) if mask else p)


def above(voxels: DataFrame, threshold: float = 0.2, value: str = "prob") -> DataFrame:
    """Voxels at or over the threshold."""
    return voxels.where(F.col(value) >= threshold)


def masked_labels(voxels: DataFrame, label: str = "seg", mask: str = "mask") -> DataFrame:
    """Labels, 0 outside the mask."""
    return voxels.withColumn(label, F.when(~F.col(mask), F.lit(0).cast("long")).otherwise(F.col(label)))


def slice_labels(voxels: DataFrame, label: str = "seg") -> DataFrame:
    """Least and greatest label and number of labels of each slice."""
    return voxels.groupBy("z").agg(F.min(label).alias("min_label"), F.max(label).alias("max_label"), F.count_distinct(F.col(label)).alias("n_labels"))


def label_offsets(voxels: DataFrame, label: str = "seg", masked: bool = False) -> DataFrame:
    """(z, offset): what to add to each slice's own labels (from 0; masked: from 1, 0 is background) so that slices never share one."""
    sizes = voxels.groupBy("z").agg((F.max(label) + (0 if masked else 1)).alias("size"))
    return prefix_offsets(sizes, "z", "size").select("z", "offset")


def add_offsets(voxels: DataFrame, offsets: DataFrame, label: str = "seg", mask: str | None = None) -> DataFrame:
    """Labels moved by their slice's offset, inside the mask only if one is given; too large labels are an error."""
    moved = F.col(label) + F.col("offset")
    if mask:
        moved = F.when(F.col(mask), moved).otherwise(F.col(label))
    checked = F.when(moved >= MAX_LABEL, F.raise_error(F.lit("a label exceeds 32 bits"))).otherwise(moved)
    return voxels.join(offsets, "z").withColumn(label, checked.cast("long")).select(*voxels.columns)


def consecutive(labels: DataFrame, label: str, name: str, start: int = 1, keep_zeros: bool = True) -> DataFrame:
    """(label, name): consecutive new labels in label order for the distinct labels; 0 stays 0 if kept."""
    known = labels.select(label).where(F.col(label).isNotNull()).distinct()
    if not keep_zeros:
        return dense_ids(known, [label], name, start)
    out = dense_ids(known.where(F.col(label) != 0), [label], name, start)
    return out.unionByName(known.where(F.col(label) == 0).select(label, F.lit(0).cast("long").alias(name)))


def relabel(voxels: DataFrame, label: str, start: int = 1, keep_zeros: bool = True) -> DataFrame:
    """Voxels with consecutive labels."""
    return voxels.join(consecutive(voxels, label, "_new", start, keep_zeros), label, "left").withColumn(label, F.col("_new")).select(*voxels.columns)


#: Rows of a slice that one key of the exchange holds.
BAND = 64


def neighbours_in_slice(voxels: DataFrame, *values: str, band: int = BAND) -> DataFrame:
    """(z, y, x, values, values of the right or lower neighbour as n_*, dy, dx).

    One exchange, by bands of rows of a slice, serves both windows: the first row of a band is sent to the band before it as well, so
    that a slice is as many keys as it has bands.  Neighbours that are missing give no row.
    """
    at = F.expr(f"y div {band}")
    own, guest = F.struct(at.alias("band"), F.lit(True).alias("own")), F.struct((at - 1).alias("band"), F.lit(False).alias("own"))
    both = F.when((F.col("y") % band == 0) & (F.col("y") > 0), F.array(own, guest)).otherwise(F.array(own))
    v = voxels.select("z", "y", "x", *values, F.explode(both).alias("_at")).select("z", "y", "x", *values, F.col("_at.band").alias("_band"), F.col("_at.own").alias("_own")).repartition("z", "_band")
    out = []
    for axis, other, dy, dx in (("x", "y", 0, 1), ("y", "x", 1, 0)):
        w = Window.partitionBy("z", "_band", other).orderBy(axis)
        step = v.withColumns({f"n_{c}": F.lead(c).over(w) for c in (axis, *values)})
        # A guest has no neighbour below it in its band; those to its right are found in its own.
        step = step.where((F.col(f"n_{axis}") == F.col(axis) + 1) & F.col("_own")).drop(f"n_{axis}", "_band", "_own")
        out.append(step.withColumns({"dy": F.lit(dy), "dx": F.lit(dx)}))
    return out[0].unionByName(out[1])


def slice_components(voxels: DataFrame, label: str = "seg", background: int | None = None) -> DataFrame:
    """(z, y, x, component): components of equal labels by 4-neighbourhood within slices, named by their first voxel's number in its slice.

    Voxels of the background have component null.
    """
    v = voxels.select("z", "y", "x", F.col(label).alias("label"))
    width = F.broadcast(v.agg((F.max("x") + 1).cast("long").alias("w"), (F.max("y") + 1).cast("long").alias("h")))
    v = v.crossJoin(width).withColumn("id", (F.col("z") * F.col("h") + F.col("y")) * F.col("w") + F.col("x"))
    inner = v if background is None else v.where(F.col("label") != background)
    pairs = neighbours_in_slice(inner, "label", "id").where("label = n_label")
    comp = connected_components(pairs, "id", "n_id")
    own = F.coalesce("component", "id") if background is None else F.when(F.col("label") != background, F.coalesce("component", "id"))
    return v.join(comp, F.col("node") == F.col("id"), "left").select("z", "y", "x", (own - F.col("z") * F.col("h") * F.col("w")).alias("component"))


def labelled_segmentation(voxels: DataFrame, label: str = "seg") -> DataFrame:
    """Components of each slice, relabelled from 0 in each slice and moved by offsets, so that labels are unique and rise with z."""
    comp = slice_components(voxels, label)
    within = comp.select("z", "component").distinct().withColumn("own", F.dense_rank().over(Window.partitionBy("z").orderBy("component")).cast("long") - 1)
    placed = comp.join(within, ["z", "component"]).select("z", "y", "x", F.col("own").alias(label))
    return add_offsets(placed, label_offsets(placed, label), label)
