"""Statistics of regions and of the borders between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxgraph.functions.quantiles import ranked_quantiles
from voxgraph.operators.rag import Z_BOTH, Z_LOWER, adjacent_voxels
from voxgraph.plans.lineage import cut

QUANTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
EDGE_QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
STATISTICS = ("count", "kurtosis", "max", "min", *(f"q{i}" for i in range(7)), "radius0", "radius1", "skewness", "sum", "variance")
CENTRES = ("wc_y", "wc_x", "c_y", "c_x")


def finite(c: Column) -> Column:
    """NaN and null are 0, infinities the largest float."""
    big = F.lit(3.4028234663852886e38)
    return F.greatest(-big, F.least(big, F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))))


def region_statistics(voxels: DataFrame, value: str = "raw", seg: str = "seg", ranked: bool = False) -> DataFrame:
    """One row for each region: 16 statistics of its values and shape, then weighted and plain centres.

    ``ranked`` is as for the statistics of edges.

    Variance is that of the population, kurtosis is excess kurtosis; radii are the
    roots of the eigenvalues of the coordinates' covariance, the larger first.
    """
    v = F.col(value)
    a = voxels.groupBy(F.col(seg).alias("node")).agg(
        F.count("*").alias("count"), F.kurtosis(v).alias("kurtosis"), F.max(v).alias("max"), F.min(v).alias("min"), *([] if ranked else [F.percentile(v, F.array(*map(F.lit, QUANTILES))).alias("q")]),
        F.skewness(v).alias("skewness"), F.sum(v).alias("sum"), F.var_pop(v).alias("variance"),
        F.sum(F.col("y") * v).alias("wy"), F.sum(F.col("x") * v).alias("wx"), F.avg("y").alias("c_y"), F.avg("x").alias("c_x"),
        F.var_pop("y").alias("vy"), F.var_pop("x").alias("vx"), F.covar_pop("y", "x").alias("cov"),
    )
    if ranked:
        found = ranked_quantiles(voxels.select(F.col(seg).alias("node"), F.col(value).alias("q")), ["node"], ["q"], QUANTILES)
        a = a.join(found, "node", "left")
    mid, gap = (F.col("vy") + F.col("vx")) / 2, F.sqrt(F.pow((F.col("vy") - F.col("vx")) / 2, 2) + F.pow(F.col("cov"), 2))
    out = {"radius0": F.sqrt(mid + gap), "radius1": F.sqrt(F.greatest(mid - gap, F.lit(0.0))), "wc_y": F.try_divide("wy", "sum"), "wc_x": F.try_divide("wx", "sum")}
    out |= {f"q{i}": F.col("q")[i] for i in range(7)}
    return a.select("node", *(finite(out.get(c, F.col(c)).cast("double")).alias(c) for c in (*STATISTICS, *CENTRES)))


def region_edge_features(edges: DataFrame, nodes: DataFrame, kinds: Sequence[str] = ("xy", "z", "skip")) -> DataFrame:
    """Per edge: least, greatest, absolute difference and sum of both regions' statistics, and squared differences of the centres (68 columns)."""
    e = edges.where(F.col("edge_type").isin(*kinds))
    for side in ("u", "v"):
        e = e.join(nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in (*STATISTICS, *CENTRES))), side)
    both = [(c, F.col(f"u_{c}"), F.col(f"v_{c}")) for c in STATISTICS]
    cols = [F.least(a, b).alias(f"min_{c}") for c, a, b in both] + [F.greatest(a, b).alias(f"max_{c}") for c, a, b in both]
    cols += [F.abs(a - b).alias(f"diff_{c}") for c, a, b in both] + [(a + b).alias(f"sum_{c}") for c, a, b in both]
    cols += [F.pow(F.col(f"u_{c}") - F.col(f"v_{c}"), 2).alias(f"sq_{c}") for c in CENTRES]
    return e.select(*edges.columns, *cols)


def border_values(voxels: DataFrame, values: Sequence[str] = ("prob",), seg: str = "seg", z_direction: int = Z_BOTH, kinds: tuple[str, ...] = ("xy", "z")) -> DataFrame:
    """(u, v, edge_type, values): both sides' values of every neighbouring voxel pair; between slices the lower, the upper or both, by direction."""
    pairs = adjacent_voxels(voxels, seg, *values, kinds=kinds)
    here, there = F.struct(*values), F.struct(*(F.col(f"n_{c}").alias(c) for c in values))
    both = F.array(here, there)
    z_values = both if z_direction == Z_BOTH else F.array(here if z_direction == Z_LOWER else there)
    return pairs.select("u", "v", "edge_type", F.explode(F.when(F.col("edge_type") == "z", z_values).otherwise(both)).alias("_v")).select("u", "v", "edge_type", "_v.*")


def edge_statistics(values: DataFrame, columns: Sequence[str] = ("value",), prefixed: bool = False, ranked: bool = False) -> DataFrame:
    """Nine statistics of the values of each edge, for all columns in one grouping.

    Quantiles hold the distinct values of an edge in memory, unless they are ``ranked``: that takes two more shuffles and any number of values.
    """
    keys = ["u", "v", "edge_type"]
    aggs, out = [], []
    for c in columns:
        p = f"{c}_" if prefixed else ""
        aggs += [F.avg(c).alias(f"{p}mean"), F.var_pop(c).alias(f"{p}variance"), F.min(c).alias(f"{p}min"), F.max(c).alias(f"{p}max")]
        if not ranked:
            aggs.append(F.percentile(c, F.array(*map(F.lit, EDGE_QUANTILES))).alias(f"{p}q"))
        out += [f"{p}mean", f"{p}variance", f"{p}min", *(F.col(f"{p}q")[i].alias(f"{p}q{int(100 * q)}") for i, q in enumerate(EDGE_QUANTILES)), f"{p}max"]
    made = values.groupBy(*keys).agg(*aggs)
    if ranked:
        found = ranked_quantiles(values, keys, columns, EDGE_QUANTILES)
        made = made.join(found.select(*keys, *(F.col(c).alias(f"{c}_q" if prefixed else "q") for c in columns)), keys, "left")
    return made.select(*keys, *out)


def edge_features(voxels: DataFrame, value: str = "prob", seg: str = "seg", keep_only_xy: bool = False, keep_only_z: bool = False, z_direction: int = Z_BOTH, ranked: bool = False) -> DataFrame:
    """The nine statistics for in-slice and between-slice edges, or one kind; the other kind's pairs are never made."""
    if keep_only_xy and keep_only_z:
        raise ValueError("only one kind of edge can be kept")
    kinds = ("xy",) if keep_only_xy else ("z",) if keep_only_z else ("xy", "z")
    values = border_values(voxels, (value,), seg, z_direction, kinds)
    return edge_statistics(cut(values) if ranked else values, (value,), ranked=ranked)


def filter_features(responses: DataFrame, channels: Sequence[str], seg: str = "seg", z_direction: int = Z_BOTH, ranked: bool = False) -> DataFrame:
    """Nine statistics of every filter channel; neighbours are paired once for all channels."""
    values = border_values(responses, channels, seg, z_direction)
    return edge_statistics(cut(values) if ranked else values, channels, prefixed=True, ranked=ranked)


def joined_features(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Feature tables of the same edges side by side, later ones' columns numbered."""
    out = first
    keys = ["u", "v", "edge_type"]
    for i, other in enumerate(others, 1):
        out = out.join(other.select(*keys, *(F.col(c).alias(f"{c}_{i}") for c in other.columns if c not in keys)), keys)
    return out
