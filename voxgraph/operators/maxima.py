"""Local maxima of volumes, with plateaus."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.operators.graph import connected_components
from voxgraph.plans.lineage import settled as cut
from voxgraph.sources.volume import AXES

#: The 26 neighbours of a voxel.
AROUND = tuple(d for d in itertools.product((-1, 0, 1), repeat=3) if any(d))


def local_maxima(voxels: DataFrame, value: str = "prob", three_d: bool = True) -> DataFrame:
    """(z, y, x, value, plateau): voxels of plateaus that no neighbour of any member exceeds; within slices only, if not ``three_d``.

    A plateau is a component of equal values over all neighbours (26, or 8 in a slice), named by its least voxel.  Voxels at the border
    count; what is nowhere above the least value of the volume (or slice) is no maximum.  Missing and null voxels are no neighbours.

    The greatest value around each voxel comes from a window along each axis.  Only voxels that nothing around them exceeds are joined
    with their neighbours: one of equal value that is exceeded itself spoils the whole plateau.
    """
    v = cut(voxels.select(*(F.col(a).cast("int").alias(a) for a in AXES), F.col(value).cast("double").alias("value")).where("value is not null"))
    far = v.agg(*((F.coalesce(F.max(a), F.lit(0)) + 1).cast("long").alias(f"n{a}") for a in AXES))
    most = v.withColumn("most", F.col("value"))
    for axis in AXES if three_d else AXES[1:]:
        others = [a for a in AXES if a != axis]
        most = most.withColumn("most", F.max("most").over(Window.partitionBy(*others).orderBy(axis).rangeBetween(-1, 1)))
    least = v.agg(F.min("value").alias("least")) if three_d else v.groupBy("z").agg(F.min("value").alias("least"))
    number = (F.col("z") * F.col("ny") + F.col("y")) * F.col("nx") + F.col("x")
    all_ = cut(most.crossJoin(F.broadcast(far)).select(*AXES, "value", number.alias("id"), (F.col("most") <= F.col("value")).alias("top")))
    tops = all_.where("top")
    steps = F.array(*(F.struct(*(F.lit(d).alias(f"d{a}") for a, d in zip(AXES, step, strict=True))) for step in AROUND if three_d or not step[0]))
    near = tops.select("id", "value", *AXES, F.explode(steps).alias("_d")).select("id", F.col("value").alias("_v"), *((F.col(a) + F.col(f"_d.d{a}")).alias(a) for a in AXES))
    met = cut(near.join(all_.select(*AXES, "value", "top", F.col("id").alias("n_id")), list(AXES)).where("value >= _v").select("id", "n_id", "top", (F.col("value") > F.col("_v")).alias("over")))
    parts = connected_components(met.where("top and not over").select("id", "n_id"), "id", "n_id", write=cut).select(F.col("node").alias("id"), "component")
    named = tops.join(parts, "id", "left").withColumn("plateau", F.coalesce("component", "id"))
    named = named.crossJoin(F.broadcast(least)) if three_d else named.join(least, "z")
    named = cut(named.where("value > least").select(*AXES, "value", "id", "plateau"))
    # Windows miss a neighbour across a corner where voxels are missing; the join does not.
    spoilt = named.join(met.where("over or not top").select("id").distinct(), "id").select("plateau").distinct()
    return named.join(spoilt, "plateau", "left_anti").select(*AXES, "value", "plateau")
