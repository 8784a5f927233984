"""One registered query for each operator, on the volume derived from ``orders``, and the SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.functions import ids, metrics, tables
from voxgraph.operators import blocking, blockwise, contraction, costs, defects, features, graph, kernels, labels, learning, maxima, rag, solvers, tiles
from voxgraph.plans import workflows
from voxgraph.plans.lineage import cut, large, scratch
from voxgraph.sources import chunks, volume

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

BLOCK, HALO = (4, 10, 10), (1, 2, 2)

# --- SQL of the inputs that the queries share -------------------------------------------------

_VOX = """
f AS (SELECT min(o_orderkey) k0, count(*) n, min(o_totalprice) lo, max(o_totalprice) hi FROM orders),
o AS (SELECT o_orderkey - k0 AS i, o_totalprice, o_custkey, o_orderstatus, lo, hi FROM orders, f WHERE o_orderkey - k0 < 625 * (n // 625)),
vox AS (SELECT (i // 625)::INT AS z, ((i % 625) // 25)::INT AS y, (i % 25)::INT AS x, o_totalprice AS raw, (o_totalprice - lo) / (hi - lo) AS prob,
  (25 * (i // 625) + 5 * (((i % 625) // 25) // 5) + least(4, ((i % 25) + (o_custkey % 2)) // 5))::BIGINT AS seg,
  (1 + 3 * least(2, ((i % 625) // 25) // 10) + least(2, (i % 25) // 10))::BIGINT AS gt, o_orderstatus <> 'F' AS mask FROM o)"""
_ADJ = """,
adj AS (
  SELECT 'xy' AS edge_type, a.z, least(a.seg, b.seg) AS u, greatest(a.seg, b.seg) AS v, a.prob, b.prob AS n_prob FROM vox a JOIN vox b ON b.z = a.z AND b.y = a.y AND b.x = a.x + 1 WHERE a.seg <> b.seg
  UNION ALL SELECT 'xy', a.z, least(a.seg, b.seg), greatest(a.seg, b.seg), a.prob, b.prob FROM vox a JOIN vox b ON b.z = a.z AND b.y = a.y + 1 AND b.x = a.x WHERE a.seg <> b.seg
  UNION ALL SELECT 'z', a.z, least(a.seg, b.seg), greatest(a.seg, b.seg), a.prob, b.prob FROM vox a JOIN vox b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x WHERE a.seg <> b.seg),
rag AS (SELECT u, v, edge_type, min(z) AS z, count(*) AS length FROM adj GROUP BY u, v, edge_type)"""
_BOTH = """,
bv AS (SELECT u, v, edge_type, prob AS value FROM adj UNION ALL SELECT u, v, edge_type, n_prob FROM adj)"""
_PROB = _BOTH + """,
pr AS (SELECT u, v, edge_type, round(avg(value), 6) AS prob FROM bv GROUP BY u, v, edge_type),
cost AS (SELECT u, v, edge_type, length, prob, ln((1 - (0.998 * prob + 0.001)) / (0.998 * prob + 0.001)) AS c FROM rag JOIN pr USING (u, v, edge_type))"""
_GT = """,
ngt AS (SELECT node, gt FROM (SELECT seg AS node, gt, row_number() OVER (PARTITION BY seg ORDER BY count(*) DESC, gt) AS r FROM vox GROUP BY seg, gt) WHERE r = 1),
egt AS (SELECT u, v, edge_type, length, a.gt AS u_gt, b.gt AS v_gt, (a.gt <> b.gt)::INT AS is_cut FROM rag JOIN ngt a ON a.node = u JOIN ngt b ON b.node = v)"""
_BLOCKS = """,
nz AS (SELECT max(z) + 1 AS nz FROM vox),
bl AS (SELECT ((bz.range * 3 + b_y.range) * 3 + bx.range)::INT AS block_id,
  (bz.range * 4)::INT AS z0, least(bz.range * 4 + 4, nz)::INT AS z1, (b_y.range * 10)::INT AS y0, least(b_y.range * 10 + 10, 25)::INT AS y1, (bx.range * 10)::INT AS x0, least(bx.range * 10 + 10, 25)::INT AS x1,
  greatest(bz.range * 4 - 1, 0)::INT AS oz0, least(bz.range * 4 + 5, nz)::INT AS oz1, greatest(b_y.range * 10 - 2, 0)::INT AS oy0, least(b_y.range * 10 + 12, 25)::INT AS oy1, greatest(bx.range * 10 - 2, 0)::INT AS ox0, least(bx.range * 10 + 12, 25)::INT AS ox1
  FROM nz, range((SELECT (nz + 3) // 4 FROM nz)) bz, range(3) b_y, range(3) bx),
bvox AS (SELECT block_id, vox.* FROM vox JOIN bl ON z >= oz0 AND z < oz1 AND y >= oy0 AND y < oy1 AND x >= ox0 AND x < ox1),
bn AS (SELECT DISTINCT block_id, seg AS node FROM bvox)"""
_ENDS = """,
ends AS (SELECT block_id, u, v, edge_type, length, count(*) AS n, max(inside) AS inside FROM (
  SELECT block_id, u, v, edge_type, length, u AS inside FROM rag JOIN bn ON node = u UNION ALL SELECT block_id, u, v, edge_type, length, v FROM rag JOIN bn ON node = v) GROUP BY block_id, u, v, edge_type, length)"""
_REACH = """,
link AS (SELECT u AS a, v AS b FROM egt WHERE edge_type = 'xy' AND is_cut = 0 UNION SELECT v, u FROM egt WHERE edge_type = 'xy' AND is_cut = 0),
reach(node, reached) AS (SELECT node, node FROM ngt UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.reached),
cc AS (SELECT node, min(reached) AS component FROM reach GROUP BY node)"""
_SIGNED = ", sg AS (SELECT u, v, edge_type, length, CASE WHEN is_cut = 1 THEN -length ELSE length + 0.5 END::DOUBLE AS cost FROM egt)"


def _closure(name: str, links: str, nodes: str = "SELECT DISTINCT seg AS node FROM vox") -> str:
    """CTE (node, component): what is reached over links (a, b), named by the least node."""
    return f""",
{name}_l AS (SELECT a, b FROM ({links}) UNION SELECT b, a FROM ({links})),
{name}_r(node, got) AS (SELECT node, node FROM ({nodes}) UNION SELECT r.node, l.b FROM {name}_r r JOIN {name}_l l ON l.a = r.got),
{name} AS (SELECT node, min(got) AS component FROM {name}_r GROUP BY node)"""


# Where costs follow the truth, the best partition joins all that attract: over all edges, over those within blocks, and over reduced edges that a way of stitching looks at.
_BEST = _closure("best", "SELECT u AS a, v AS b FROM egt WHERE is_cut = 0")
_CUT_OR = ", c AS (SELECT u, v, edge_type, max(CASE WHEN n = 1 THEN 1 ELSE is_cut END) AS is_cut FROM ends JOIN egt USING (u, v, edge_type) GROUP BY ALL)"
_BLOCKED = _CUT_OR + _closure("ns", "SELECT u AS a, v AS b FROM c WHERE is_cut = 0")
_REDUCED = """,
re AS (SELECT least(a.component, b.component) AS u, greatest(a.component, b.component) AS v, sum(cost) AS cost FROM sg JOIN ns a ON a.node = u JOIN ns b ON b.node = v WHERE a.component <> b.component GROUP BY 1, 2),
rbn AS (SELECT DISTINCT block_id, component AS node FROM bn JOIN ns USING (node)),
rends AS (SELECT block_id, u, v, cost, count(*) AS n, max(inside) AS inside FROM (
  SELECT block_id, u, v, cost, u AS inside FROM re JOIN rbn ON node = u UNION ALL SELECT block_id, u, v, cost, v FROM re JOIN rbn ON node = v) GROUP BY block_id, u, v, cost)"""
_ATTRACTED = _closure("sa", "SELECT u AS a, v AS b FROM rends WHERE n = 1 AND cost > 0", "SELECT DISTINCT component AS node FROM ns")
_SLICES = ", segs AS (SELECT z, count(DISTINCT seg // CASE WHEN z % 7 = 3 THEN 5 ELSE 1 END) AS n_segs FROM vox GROUP BY z)"
_DEFECT = ", ds(z) AS (SELECT z FROM (SELECT DISTINCT z FROM vox) WHERE z % 7 IN (3, 4) AND z + 2 <= (SELECT max(z) FROM vox))"


def _sql(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{''.join(parts[:-1])}\n{parts[-1]}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        name = fn.__name__.lstrip("_")
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add


def _r(c: str | F.Column, digits: int = 6) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits) + F.lit(0.0)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(_r(c).alias(c) if c in columns else F.col(c) for c in df.columns))


# --- shared inputs -----------------------------------------------------------------------------


def voxels(spark: SparkSession, d: str) -> DataFrame:
    return volume.derived_volume(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return rag.rag_edges(voxels(spark, d))


def _probabilities(spark: SparkSession, d: str) -> DataFrame:
    return features.edge_features(voxels(spark, d)).select("u", "v", "edge_type", F.round("mean", 6).alias("prob"))


def _problem(spark: SparkSession, d: str, scheme: str = "none") -> DataFrame:
    return costs.multicut_problem(edges(spark, d), _probabilities(spark, d), scheme=scheme)


def _truth(spark: SparkSession, d: str) -> DataFrame:
    return costs.edge_truth(edges(spark, d), costs.node_truth(voxels(spark, d)))


def _signed(spark: SparkSession, d: str) -> DataFrame:
    """A problem with a clear solution: edges within a truth region attract, others repel."""
    t = _truth(spark, d).join(large(edges(spark, d).select("u", "v", "edge_type", "length")), ["u", "v", "edge_type"])
    return t.select("u", "v", "edge_type", "length", F.when(F.col("is_cut") == 1, -F.col("length").cast("double")).otherwise(F.col("length").cast("double") + 0.5).alias("cost"))


def _shape(v: DataFrame) -> tuple[int, int, int]:
    return (v.agg(F.max("z")).first()[0] + 1, 25, 25)


def _block_nodes(spark: SparkSession, d: str) -> DataFrame:
    v = voxels(spark, d)
    return blocking.nodes_to_blocks(v, _shape(v), BLOCK, HALO)


def _hierarchy(spark: SparkSession, d: str, levels: int = 1) -> blockwise.Hierarchy:
    v = voxels(spark, d)
    return blockwise.Hierarchy(v, _signed(spark, d), _shape(v), BLOCK, HALO, levels, "kl")


def _slice_merge(spark: SparkSession, d: str) -> DataFrame:
    t = _truth(spark, d).withColumn("is_cut", F.when(F.col("edge_type") == "xy", F.col("is_cut")).otherwise(1))
    return graph.merged(t, rag.rag_nodes(voxels(spark, d)))


def _bad_slices(spark: SparkSession, d: str) -> DataFrame:
    z = voxels(spark, d).select("z").distinct()
    return z.crossJoin(F.broadcast(z.agg(F.max("z").alias("m")))).where("z % 7 in (3, 4) and z + 2 <= m").select("z")


# --- volumes and labels ------------------------------------------------------------------------


@query(_sql(_VOX, "SELECT z, y, x, raw, seg, gt FROM vox WHERE z >= 0 AND z < 2 AND y >= 3 AND y < 17 AND x >= 5 AND x < 20"))
def roi_scan(spark, d):
    return voxels(spark, d).where(volume.in_box((0, 3, 5), (2, 17, 20))).select("z", "y", "x", "raw", "seg", "gt")


@query(_sql(_VOX, "SELECT z, y, x, CASE WHEN z < 2 AND y BETWEEN 3 AND 9 AND x < 5 THEN gt ELSE seg END AS seg FROM vox"))
def roi_write(spark, d):
    v = voxels(spark, d)
    new = v.where(volume.in_box((0, 3, 0), (2, 10, 5))).select("z", "y", "x", F.col("gt").alias("seg"))
    return volume.overlay(v.select("z", "y", "x", "seg"), new, "seg")


@query(_sql(_VOX, "SELECT z, y, x, CASE WHEN y BETWEEN 4 AND 11 AND x >= 9 THEN gt ELSE seg END AS seg FROM vox WHERE z < 3 AND y >= 2 AND y < 20 AND x >= 3"))
def chunk_box(spark, d):
    """A volume stored in chunks, a box of which is written again, and another read."""
    v = voxels(spark, d)
    store = chunks.ChunkStore(spark, scratch(spark, "chunks"))
    store.create("seg", _shape(v), BLOCK, seg="bigint")
    store.write(v.select("z", "y", "x", "seg"), "seg")
    store.write_box(v.where("y between 4 and 11 and x >= 9").select("z", "y", "x", F.col("gt").alias("seg")), "seg", "seg")
    return store.read((0, 2, 3), (3, 20, 25), "seg").select("z", "y", "x", "seg")


@query(_sql(_VOX, "SELECT seg AS node, count(*) AS n, min(z * 625 + y * 25 + x)::BIGINT AS first_voxel FROM vox WHERE seg >= 20 AND seg < 47 GROUP BY seg"))
def ragged_rows(spark, d):
    """The voxels of each region as a ragged table, and a range of its rows."""
    v = voxels(spark, d)
    store = chunks.ChunkStore(spark, scratch(spark, "ragged"), axes=("row",))
    most = v.agg(F.max("seg") + 1).first()[0]
    store.create("voxels", (most,), (10,), voxels="array<bigint>")
    rows = v.groupBy(F.col("seg").alias("row")).agg(F.array_sort(F.collect_list((F.col("z") * 625 + F.col("y") * 25 + F.col("x")).cast("long"))).alias("voxels"))
    store.write(rows, "voxels")
    return store.read((20,), (47,), "voxels").select(F.col("row").alias("node"), F.size("voxels").cast("long").alias("n"), F.element_at("voxels", 1).alias("first_voxel"))


@query(_sql(_VOX, "SELECT (z + 3)::INT AS z, (y + 10)::INT AS y, (x + 20)::INT AS x, seg FROM vox"))
def offset_frame(spark, d):
    return volume.shift(voxels(spark, d).select("z", "y", "x", "seg"), (3, 10, 20))


@query(_sql(_VOX, "SELECT z, y, x, round(CASE WHEN NOT mask THEN 1.0 ELSE 1 - prob END, 6) + 0.0 AS prob FROM vox"))
def boundary_map(spark, d):
    return _rounded(labels.boundary_map(voxels(spark, d), invert=True).select("z", "y", "x", "prob"), "prob")


@query(_sql(_VOX, "SELECT z, y, x FROM vox WHERE prob >= 0.2"))
def boundary_threshold(spark, d):
    return labels.above(voxels(spark, d)).select("z", "y", "x")


@query(_sql(_VOX, "SELECT z, y, x, CASE WHEN NOT mask THEN 0 ELSE seg END AS seg FROM vox"))
def masked_labels(spark, d):
    return labels.masked_labels(voxels(spark, d)).select("z", "y", "x", "seg")


@query(_sql(_VOX, "SELECT z, min(seg) AS min_label, max(seg) AS max_label, count(DISTINCT seg) AS n_labels FROM vox GROUP BY z"))
def slice_labels(spark, d):
    return labels.slice_labels(voxels(spark, d))


_OFF = "SELECT z, coalesce(sum(s) OVER (ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_by FROM (SELECT z, max(gt) + %d AS s FROM vox GROUP BY z)"


@query(_sql(_VOX, _OFF % 1))
def label_offsets(spark, d):
    return labels.label_offsets(voxels(spark, d), "gt").select("z", F.col("offset").alias("offset_by"))


@query(_sql(_VOX, _OFF % 0))
def label_offsets_masked(spark, d):
    return labels.label_offsets(voxels(spark, d), "gt", masked=True).select("z", F.col("offset").alias("offset_by"))


@query(_sql(_VOX, f", off AS ({_OFF % 1}) SELECT z, y, x, gt + offset_by AS gt FROM vox JOIN off USING (z)"))
def add_offsets(spark, d):
    v = voxels(spark, d)
    return labels.add_offsets(v, labels.label_offsets(v, "gt"), "gt").select("z", "y", "x", "gt")


@query(_sql(_VOX, f", off AS ({_OFF % 0}) SELECT z, y, x, CASE WHEN mask THEN gt + offset_by ELSE gt END AS gt FROM vox JOIN off USING (z)"))
def add_offsets_masked(spark, d):
    v = voxels(spark, d)
    return labels.add_offsets(v, labels.label_offsets(v, "gt", masked=True), "gt", "mask").select("z", "y", "x", "gt")


@query(_sql(_VOX, ", m AS (SELECT DISTINCT CASE WHEN NOT mask THEN 0 ELSE seg * 7 + 3 END AS seg FROM vox), r AS (SELECT seg, dense_rank() OVER (ORDER BY seg) AS n FROM m WHERE seg <> 0) SELECT seg, coalesce(n, 0)::BIGINT AS label FROM m LEFT JOIN r USING (seg)"))
def relabel_consecutive(spark, d):
    v = labels.masked_labels(voxels(spark, d).withColumn("seg", F.col("seg") * 7 + 3))
    return labels.consecutive(v, "seg", "label").select("seg", F.col("label").cast("long").alias("label"))


_PIECES = ", p AS (SELECT z, y, x, z * 625 + y * 25 + x AS id, seg FROM vox)" + _closure(
    "piece", "SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.z = b.z AND a.seg = b.seg AND b.id > a.id AND abs(a.y - b.y) + abs(a.x - b.x) = 1", "SELECT id AS node FROM p"
)


@query(_sql(_VOX, _PIECES, "SELECT z, y, x, (component - z * 625)::BIGINT AS component FROM piece JOIN p ON id = node", recursive=True))
def slice_components(spark, d):
    return labels.slice_components(voxels(spark, d))


@query(_sql(_VOX, _PIECES, """, ranked AS (SELECT z, y, x, dense_rank() OVER (PARTITION BY z ORDER BY component) - 1 AS own FROM piece JOIN p ON id = node),
off AS (SELECT z, coalesce(sum(n) OVER (ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n FROM (SELECT z, max(own) + 1 AS n FROM ranked GROUP BY z))
SELECT z, y, x, own + n AS seg FROM ranked JOIN off USING (z)""", recursive=True))  # fmt: skip
def labelled_segmentation(spark, d):
    return labels.labelled_segmentation(voxels(spark, d))


# --- region adjacency graph ----------------------------------------------------------------------


@query(_sql(_VOX, _ADJ, "SELECT * FROM rag"))
def rag_edges(spark, d):
    return edges(spark, d)


@query(_sql(_VOX, "SELECT seg AS node, min(z) AS z FROM vox GROUP BY seg"))
def rag_nodes(spark, d):
    return rag.rag_nodes(voxels(spark, d))


@query(_sql(_VOX, _ADJ, "SELECT row_number() OVER (ORDER BY edge_type, u, v) - 1 AS edge_id, u, v, edge_type, length FROM rag"))
def rag_edge_ids(spark, d):
    return rag.with_edge_ids(edges(spark, d)).select(F.col("edge_id").cast("long").alias("edge_id"), "u", "v", "edge_type", "length")


@query(_sql(_VOX, _ADJ, "SELECT (SELECT max(seg) + 1 FROM vox) AS n_nodes, count(*) AS n_edges, count(*) FILTER (edge_type = 'xy') AS n_xy, count(*) FILTER (edge_type = 'z') AS n_z FROM rag"))
def rag_size(spark, d):
    v = voxels(spark, d)
    return rag.graph_size(v, rag.rag_edges(v))


@query(_sql(_VOX, _ADJ, "SELECT u, v, edge_type, length FROM rag WHERE u <> 7 AND v <> 7"))
def rag_ignore_label(spark, d):
    return rag.rag_edges(voxels(spark, d), ignore_label=7).select("u", "v", "edge_type", "length")


# --- features --------------------------------------------------------------------------------------

_STATS = """, m AS (SELECT seg, avg(raw) AS mu, avg(y) AS my, avg(x) AS mx FROM vox GROUP BY seg),
c AS (SELECT seg AS node, count(*)::DOUBLE AS count, sum((raw - mu) ** 2) AS m2, sum((raw - mu) ** 3) AS m3, sum((raw - mu) ** 4) AS m4, max(raw) AS max, min(raw) AS min, sum(raw) AS sum,
  quantile_cont(raw, [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) AS q, sum(raw * y) / sum(raw) AS wc_y, sum(raw * x) / sum(raw) AS wc_x, avg(y) AS c_y, avg(x) AS c_x,
  sum((y - my) ** 2) / count(*) AS vy, sum((x - mx) ** 2) / count(*) AS vx, sum((y - my) * (x - mx)) / count(*) AS cov FROM vox JOIN m USING (seg) GROUP BY seg),
st AS (SELECT node, count, CASE WHEN m2 > 0 THEN count * m4 / m2 ** 2 - 3 ELSE 0 END AS kurtosis, max, min, q[1] AS q0, q[2] AS q1, q[3] AS q2, q[4] AS q3, q[5] AS q4, q[6] AS q5, q[7] AS q6,
  sqrt((vy + vx) / 2 + sqrt(((vy - vx) / 2) ** 2 + cov ** 2)) AS radius0, sqrt(greatest((vy + vx) / 2 - sqrt(((vy - vx) / 2) ** 2 + cov ** 2), 0)) AS radius1,
  CASE WHEN m2 > 0 THEN sqrt(count) * m3 / m2 ** 1.5 ELSE 0 END AS skewness, sum, m2 / count AS variance, wc_y, wc_x, c_y, c_x FROM c)"""
_NAMES = (*features.STATISTICS, *features.CENTRES)


def _relative(names: list[str]) -> str:
    return ", ".join(f"round({n}, 4) + 0.0 AS {a}" for n, a in ((x.split(" AS ")[0], x.split(" AS ")[-1]) for x in names))


@query(_sql(_VOX, _STATS, f"SELECT node, {_relative(list(_NAMES))} FROM st"))
def region_node_features(spark, d):
    out = features.region_statistics(voxels(spark, d))
    return out.select("node", *(_r(c, 4).alias(c) for c in _NAMES))


_EDGE_COLS = (
    [f"least(a.{c}, b.{c}) AS min_{c}" for c in features.STATISTICS] + [f"greatest(a.{c}, b.{c}) AS max_{c}" for c in features.STATISTICS]
    + [f"abs(a.{c} - b.{c}) AS diff_{c}" for c in features.STATISTICS] + [f"(a.{c} + b.{c}) AS sum_{c}" for c in features.STATISTICS] + [f"((a.{c} - b.{c}) ** 2) AS sq_{c}" for c in features.CENTRES]
)


@query(_sql(_VOX, _ADJ, _STATS, f"SELECT u, v, edge_type, {_relative(_EDGE_COLS)} FROM rag JOIN st a ON a.node = u JOIN st b ON b.node = v"))
def region_edge_features(spark, d):
    v = voxels(spark, d)
    out = features.region_edge_features(rag.rag_edges(v).select("u", "v", "edge_type"), features.region_statistics(v))
    return out.select("u", "v", "edge_type", *(_r(c, 4).alias(c) for c in out.columns[3:]))


_NINE = "round(avg(value), 6) + 0.0 AS mean, round(var_pop(value), 6) + 0.0 AS variance, min(value) AS min, " + ", ".join(f"round(quantile_cont(value, {q}), 6) + 0.0 AS q{int(100 * q)}" for q in features.EDGE_QUANTILES) + ", max(value) AS max"


def _nine(df: DataFrame) -> DataFrame:
    return _rounded(df, "mean", "variance", "q10", "q25", "q50", "q75", "q90")


@query(_sql(_VOX, _ADJ, _BOTH, f"SELECT u, v, edge_type, {_NINE} FROM bv GROUP BY u, v, edge_type"))
def edge_features_simple(spark, d):
    return _nine(features.edge_features(voxels(spark, d)))


@query(_sql(_VOX, _ADJ, _BOTH, f"SELECT u, v, edge_type, {_NINE} FROM bv GROUP BY u, v, edge_type"))
def edge_features_ranked(spark, d):
    """Quantiles by ranks over ranges, for borders of any size."""
    return _nine(features.edge_features(voxels(spark, d), ranked=True))


@query(_sql(_VOX, _STATS, f"SELECT node, {_relative(list(_NAMES))} FROM st"))
def region_node_features_ranked(spark, d):
    out = features.region_statistics(voxels(spark, d), ranked=True)
    return out.select("node", *(_r(c, 4).alias(c) for c in _NAMES))


@query(_sql(_VOX, _ADJ, _BOTH, f"SELECT u, v, edge_type, {_NINE} FROM bv WHERE edge_type = 'xy' GROUP BY u, v, edge_type"))
def edge_features_only_xy(spark, d):
    return _nine(features.edge_features(voxels(spark, d), keep_only_xy=True))


def _directed(side: str) -> str:
    return _sql(_VOX, _ADJ, f", bv AS (SELECT u, v, edge_type, {side} AS value FROM adj WHERE edge_type = 'z') SELECT u, v, edge_type, {_NINE} FROM bv GROUP BY u, v, edge_type")


@query(_directed("prob"))
def edge_features_z_lower(spark, d):
    return _nine(features.edge_features(voxels(spark, d), keep_only_z=True, z_direction=rag.Z_LOWER))


@query(_directed("n_prob"))
def edge_features_z_upper(spark, d):
    return _nine(features.edge_features(voxels(spark, d), keep_only_z=True, z_direction=rag.Z_UPPER))


def _kernel_rows(size: int = 25) -> str:
    """(scale, derivative, output, input, weight) of the filters along an axis, with values mirrored at both ends."""
    out: dict[tuple[int, int, int, int], float] = {}
    for s, sigma in enumerate(kernels.FILTER_SIGMAS):
        for order in range(3):
            k = kernels._kernel(sigma, order)
            r = len(k) // 2
            period = 2 * size - 2 if size > r else 2 * size
            for i in range(size):
                for j, w in enumerate(k[::-1].tolist()):
                    t = (i + j - r) % period
                    t = t if t < size else (period - t if size > r else period - 1 - t)
                    out[s, order, i, t] = out.get((s, order, i, t), 0.0) + w
    return ", ".join(f"({s}, {o}, {i}, {t}, {w!r})" for (s, o, i, t), w in out.items())


_CHANNELS = tuple(f"{k}_{str(s).replace('.', '_')}" for s in kernels.FILTER_SIGMAS for k in ("gauss", "log", "hess0", "hess1"))
_FILTERS = f""",
k(s, o, i, t, w) AS (VALUES {_kernel_rows()}),
down AS (SELECT z, s, o, i AS y, x, sum(w * prob) AS v FROM vox JOIN k ON t = y GROUP BY z, s, o, i, x),
flat AS (SELECT z, d.s, d.o AS oy, k.o AS ox, y, i AS x, sum(w * v) AS v FROM down d JOIN k ON k.s = d.s AND t = x AND (d.o, k.o) IN ((0, 0), (2, 0), (0, 2), (1, 1)) GROUP BY z, d.s, d.o, k.o, y, i),
parts AS (SELECT z, y, x, s, max(v) FILTER (oy = 0 AND ox = 0) AS g, max(v) FILTER (oy = 2) AS yy, max(v) FILTER (ox = 2) AS xx, max(v) FILTER (oy = 1) AS xy FROM flat GROUP BY z, y, x, s),
one AS (SELECT z, y, x, s, g AS gauss, yy + xx AS log, (yy + xx) / 2 + sqrt(((yy - xx) / 2) ** 2 + xy ** 2) AS hess0, (yy + xx) / 2 - sqrt(((yy - xx) / 2) ** 2 + xy ** 2) AS hess1 FROM parts),
filters AS (SELECT z, y, x, {", ".join(f"max({c.split('_')[0]}) FILTER (s = {i // 4}) AS {c}" for i, c in enumerate(_CHANNELS))} FROM one GROUP BY z, y, x)"""
_EACH = ", ".join(
    f"round(avg({c}), 6) + 0.0 AS {c}_mean, round(var_pop({c}), 6) + 0.0 AS {c}_variance, round(min({c}), 6) + 0.0 AS {c}_min, " + ", ".join(f"round(quantile_cont({c}, {q}), 6) + 0.0 AS {c}_q{int(100 * q)}" for q in features.EDGE_QUANTILES) + f", round(max({c}), 6) + 0.0 AS {c}_max"
    for c in _CHANNELS
)
_SIDES = """, step(edge_type, dz, dy, dx) AS (VALUES ('xy', 0, 0, 1), ('xy', 0, 1, 0), ('z', 1, 0, 0)),
met AS (SELECT a.*, edge_type, a.z + dz AS nz, a.y + dy AS ny, a.x + dx AS nx FROM vox a, step),
sides AS (
  SELECT least(a.seg, b.seg) AS u, greatest(a.seg, b.seg) AS v, edge_type, unnest([a.z, b.z]) AS z, unnest([a.y, b.y]) AS y, unnest([a.x, b.x]) AS x
  FROM met a JOIN vox b ON b.z = a.nz AND b.y = a.ny AND b.x = a.nx WHERE a.seg <> b.seg)"""


@query(_sql(_VOX, _FILTERS, _SIDES, f"SELECT u, v, edge_type, {_EACH} FROM sides JOIN filters USING (z, y, x) GROUP BY u, v, edge_type"))
def edge_features_filters(spark, d):
    v = voxels(spark, d)
    responses = kernels.filtered(v)
    out = features.filter_features(v.select("z", "y", "x", "seg").join(responses, ["z", "y", "x"]), responses.columns[3:])
    return _rounded(out, *out.columns[3:])


@query(_sql(_VOX, _ADJ, _BOTH, ", a AS (SELECT u, v, edge_type, avg(value) AS m FROM bv GROUP BY ALL), b AS (SELECT u, v, edge_type, max(value) AS m FROM bv GROUP BY ALL) SELECT u, v, edge_type, round(a.m, 6) + 0.0 AS mean, b.m AS max_1 FROM a JOIN b USING (u, v, edge_type)"))
def joined_features(spark, d):
    e = features.edge_features(voxels(spark, d))
    return _rounded(features.joined_features(e.select("u", "v", "edge_type", "mean"), e.select("u", "v", "edge_type", "max")), "mean")


# --- truth, costs -------------------------------------------------------------------------------------


@query(_sql(_VOX, _ADJ, _GT, "SELECT * FROM ngt"))
def node_truth(spark, d):
    return costs.node_truth(voxels(spark, d))


@query(_sql(_VOX, _ADJ, _GT, "SELECT u, v, edge_type, u_gt, v_gt, is_cut, u_gt <> 5 AND v_gt <> 5 AS is_labelled FROM egt"))
def edge_truth(spark, d):
    v = voxels(spark, d)
    return costs.edge_truth(rag.rag_edges(v), costs.node_truth(v), ignore_label=5)


_MAXES = ", mx AS (SELECT max(length) FILTER (edge_type = 'z') AS mz, max(length) FILTER (edge_type = 'xy') AS mxy, max(length) AS ma FROM cost)"


def _costs(expr: str) -> str:
    return _sql(_VOX, _ADJ, _PROB, _MAXES, f"SELECT u, v, edge_type, length, prob, round({expr}, 6) + 0.0 AS cost FROM cost, mx")


@query(_costs("c"))
def edge_costs(spark, d):
    return _rounded(_problem(spark, d, "none"), "cost")


@query(_costs("CASE WHEN edge_type = 'z' THEN c * 16 * length / mz ELSE c END"))
def edge_costs_z(spark, d):
    return _rounded(_problem(spark, d, "z"), "cost")


@query(_costs("CASE WHEN edge_type = 'z' THEN c * 16 * length / mz ELSE c * 16 * length / mxy END"))
def edge_costs_xyz(spark, d):
    return _rounded(_problem(spark, d, "xyz"), "cost")


@query(_costs("c * 16 * length / ma"))
def edge_costs_all(spark, d):
    return _rounded(_problem(spark, d, "all"), "cost")


@query(_sql(_VOX, _ADJ, _PROB, "SELECT edge_type, round(avg(c), 6) + 0.0 AS mean, round(stddev_pop(c), 6) + 0.0 AS std, round(min(c), 6) + 0.0 AS min, round(max(c), 6) + 0.0 AS max FROM cost GROUP BY edge_type"))
def cost_statistics(spark, d):
    return _rounded(costs.cost_statistics(_problem(spark, d)), "mean", "std", "min", "max")


@query(_sql(_VOX, _ADJ, _PROB, "SELECT u, v, edge_type, round(CASE WHEN u % 25 = 0 THEN 2 * (SELECT min(c) FROM cost) ELSE c END, 6) + 0.0 AS cost FROM cost"))
def ignore_costs(spark, d):
    p = _problem(spark, d).withColumn("is_ignored", F.col("u") % 25 == 0)
    return _rounded(costs.ignore_costs(p).select("u", "v", "edge_type", "cost"), "cost")


@query("SELECT o_orderkey AS u, CASE WHEN o_custkey % 7 = 0 THEN 0.5 ELSE round(o_totalprice, 2) END AS prob FROM orders")
def probability_repair(spark, d):
    bad = F.when(F.col("o_custkey") % 14 == 0, float("nan")).when(F.col("o_custkey") % 7 == 0, float("inf")).otherwise(F.round("o_totalprice", 2))
    return costs.clipped(spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("u"), bad.alias("prob")))


@query(_sql(_VOX, _ADJ, _PROB, "SELECT u, v, edge_type FROM cost WHERE c > ln((1 - 0.48) / 0.48)"))
def attractive_edges(spark, d):
    return _problem(spark, d).where(F.col("cost") > costs.bias(0.48)).select("u", "v", "edge_type")


@query(_sql(_VOX, _ADJ, "SELECT u, v, edge_type, length, max(length) OVER (PARTITION BY edge_type) AS max_length FROM rag"))
def edge_length_maxima(spark, d):
    return costs.max_by_kind(edges(spark, d).drop("z"))


# --- graph ----------------------------------------------------------------------------------------------


@query(_sql(_VOX, _ADJ, _GT, _REACH, "SELECT node, component FROM cc", recursive=True))
def connected_components(spark, d):
    return _slice_merge(spark, d)


@query(_sql(_VOX, _ADJ, _GT, _REACH, "SELECT least(a.component, b.component) AS u, greatest(a.component, b.component) AS v, sum(length)::DOUBLE AS cost FROM rag JOIN cc a ON a.node = u JOIN cc b ON b.node = v WHERE a.component <> b.component GROUP BY 1, 2", recursive=True))
def contract_graph(spark, d):
    return graph.contract(edges(spark, d).select("u", "v", F.col("length").cast("double").alias("cost")), _slice_merge(spark, d))


@query(_sql(_VOX, _ADJ, _GT, _REACH, "SELECT node, component // 25 AS component FROM cc", recursive=True))
def node_map_compose(spark, d):
    m = cut(_slice_merge(spark, d))
    return graph.compose(m, m.select(F.col("component").alias("node"), F.expr("component div 25").alias("component")).distinct())


@query(_sql(_VOX, _ADJ, _GT, _REACH, "SELECT component, count(*) AS n, array_to_string(list_sort(list(node)), ',') AS nodes FROM cc GROUP BY component", recursive=True))
def component_members(spark, d):
    return graph.members(_slice_merge(spark, d)).select("component", F.size("nodes").cast("long").alias("n"), F.array_join(F.col("nodes").cast("array<string>"), ",").alias("nodes"))


@query(_sql(_VOX, _ADJ, _GT, _REACH, "SELECT u, v, edge_type, (a.component <> b.component)::INT AS is_cut FROM rag JOIN cc a ON a.node = u JOIN cc b ON b.node = v", recursive=True))
def cut_edges(spark, d):
    return graph.cut_edges(edges(spark, d).select("u", "v", "edge_type"), _slice_merge(spark, d))


@query(_sql(_VOX, _ADJ, _PROB, _GT, _REACH, "SELECT round(sum(c), 4) + 0.0 AS energy FROM cost JOIN cc a ON a.node = u JOIN cc b ON b.node = v WHERE a.component <> b.component", recursive=True))
def energy(spark, d):
    return graph.energy(_problem(spark, d), _slice_merge(spark, d)).select(_r("energy", 4).alias("energy"))


# --- blocks -----------------------------------------------------------------------------------------------


@query(_sql(_VOX, _BLOCKS, "SELECT * FROM bl"))
def blocks(spark, d):
    return blocking.blocks(spark, _shape(voxels(spark, d)), BLOCK, HALO)


@query(_sql(_VOX, _BLOCKS, "SELECT block_id AS tile_id, oz0 AS z0, oz1 AS z1, oy0 AS y0, oy1 AS y1, ox0 AS x0, ox1 AS x1 FROM bl"))
def halo_tiles(spark, d):
    return blocking.halo_tiles(spark, _shape(voxels(spark, d)), BLOCK, HALO)


@query(_sql(_VOX, _BLOCKS, "SELECT * FROM bn"))
def nodes_to_blocks(spark, d):
    return _block_nodes(spark, d)


@query(_sql(_VOX, _BLOCKS, _DEFECT, "SELECT DISTINCT block_id, seg AS node FROM bvox WHERE z NOT IN (SELECT z FROM ds)"))
def nodes_to_blocks_without_defects(spark, d):
    v = voxels(spark, d)
    return blocking.nodes_to_blocks(v, _shape(v), BLOCK, HALO, skip_slices=_bad_slices(spark, d))


_MEET = "p.block_id < q.block_id AND p.oz0 < q.oz1 AND q.oz0 < p.oz1 AND p.oy0 < q.oy1 AND q.oy0 < p.oy1 AND p.ox0 < q.ox1 AND q.ox0 < p.ox1"


@query(_sql(_VOX, _BLOCKS, f"SELECT p.block_id AS a, q.block_id AS b FROM bl p JOIN bl q ON {_MEET}"))
def block_graph(spark, d):
    return blocking.block_graph(blocks(spark, d))


@query(_sql(_VOX, _BLOCKS, f"SELECT p.block_id AS a, q.block_id AS b FROM bl p JOIN bl q ON {_MEET} AND (p.z0 <> q.z0)::INT + (p.y0 <> q.y0)::INT + (p.x0 <> q.x0)::INT = 1"))
def block_graph_nearest(spark, d):
    return blocking.block_graph(blocks(spark, d), nearest_only=True)


@query(_sql(_VOX, _BLOCKS, """, lg AS (SELECT ((a.range * 2 + b.range) * 2 + c.range)::INT AS large_id, a.range * 8 AS z0, least(a.range * 8 + 8, nz) AS z1, b.range * 20 AS y0, least(b.range * 20 + 20, 25) AS y1, c.range * 20 AS x0, least(c.range * 20 + 20, 25) AS x1
  FROM nz, range((SELECT (nz + 7) // 8 FROM nz)) a, range(2) b, range(2) c)
SELECT large_id, block_id FROM lg JOIN bl ON bl.z0 >= lg.z0 AND bl.z1 <= lg.z1 AND bl.y0 >= lg.y0 AND bl.y1 <= lg.y1 AND bl.x0 >= lg.x0 AND bl.x1 <= lg.x1"""))
def blocks_inside(spark, d):
    """Blocks within every block of twice the size."""
    shape = _shape(voxels(spark, d))
    large = blocking.blocks(spark, shape, [2 * b for b in BLOCK], HALO)
    return blocking.blocks_inside(blocking.blocks(spark, shape, BLOCK, HALO), large)


@query(_sql(_VOX, _ADJ, _BLOCKS, _ENDS, "SELECT block_id, u, v, edge_type, length FROM ends WHERE n = 2"))
def block_inner_edges(spark, d):
    return blocking.inner_edges(edges(spark, d).drop("z"), _block_nodes(spark, d))


@query(_sql(_VOX, _ADJ, _BLOCKS, _ENDS, ", k AS (SELECT block_id FROM ends WHERE n = 2 GROUP BY block_id HAVING count(*) >= 60) SELECT block_id, u, v, edge_type, length FROM ends JOIN k USING (block_id) WHERE n = 2"))
def block_edges_of_large_blocks(spark, d):
    return blocking.inner_edges(edges(spark, d).drop("z"), _block_nodes(spark, d), least=60)


@query(_sql(_VOX, _ADJ, _BLOCKS, _ENDS, "SELECT block_id, u, v, edge_type, length FROM ends WHERE n = 1"))
def block_outer_edges(spark, d):
    return blocking.outer_edges(edges(spark, d).drop("z"), _block_nodes(spark, d))


@query(_sql(_VOX, _ADJ, _BLOCKS, _ENDS, f", g AS (SELECT p.block_id AS a, q.block_id AS b FROM bl p JOIN bl q ON {_MEET}) SELECT DISTINCT a, b, u, v, edge_type, length FROM ends e JOIN bn ON bn.node = u + v - inside AND bn.block_id <> e.block_id JOIN g ON a = least(e.block_id, bn.block_id) AND b = greatest(e.block_id, bn.block_id) WHERE n = 1"))
def edges_between_blocks(spark, d):
    return blocking.edges_between_blocks(edges(spark, d).drop("z"), _block_nodes(spark, d), block_graph(spark, d))


@query(_sql(_VOX, _ADJ, _GT, _BLOCKS, _REACH, "SELECT DISTINCT block_id, component AS node FROM bn JOIN cc USING (node)", recursive=True))
def subproblem_nodes(spark, d):
    return blocking.subproblem_nodes(_block_nodes(spark, d), _slice_merge(spark, d))


@query(_sql(_VOX, _ADJ, _GT, _BLOCKS, _ENDS, _CUT_OR, " SELECT u, v, edge_type, coalesce(is_cut, 1)::INT AS is_cut FROM rag LEFT JOIN c USING (u, v, edge_type)"))
def cut_or(spark, d):
    e, bn = edges(spark, d).select("u", "v", "edge_type"), _block_nodes(spark, d)
    truth = _truth(spark, d).select("u", "v", "is_cut")
    cuts = blocking.inner_edges(e, bn).join(truth, ["u", "v"]).select("u", "v", "is_cut").unionByName(blocking.outer_edges(e, bn).select("u", "v", F.lit(1).alias("is_cut")))
    return blockwise.merge_cuts(e, cuts)


# --- solvers and stitching ---------------------------------------------------------------------------------


def _solved(spark: SparkSession, d: str, name: str, **how) -> DataFrame:
    """(node, component) by one solver, of the whole problem."""
    return contraction.solve_whole(_signed(spark, d), name, **how)


_SOLVED = _sql(_VOX, _ADJ, _GT, _BEST, "SELECT node, component FROM best", recursive=True)


@query(_SOLVED)
def solve_greedy(spark, d):
    return _solved(spark, d, "greedy")


@query(_SOLVED)
def solve_kl(spark, d):
    return _solved(spark, d, "kl")


@query(_SOLVED)
def solve_fusion_kl(spark, d):
    return _solved(spark, d, "fm-kl")


@query(_SOLVED)
def solve_fusion_ilp(spark, d):
    return _solved(spark, d, "fm-ilp")


@query(_SOLVED)
def solve_exact(spark, d):
    return _solved(spark, d, "ilp")


@query(_SOLVED)
def solve_contracted(spark, d):
    """Parts of more than 200 edges are contracted round by round before they are solved."""
    return _solved(spark, d, "kl", task_edges=200)


@query(_SOLVED)
def solve_parallel_fusion(spark, d):
    return contraction.parallel_fusion(_signed(spark, d), "kl", solvers.Limits(stop=4), n_parallel=4)


_BOUND = "coalesce(sum(CASE WHEN a.component <> b.component THEN c END), 0)"


@query(_sql(_VOX, _ADJ, _GT, _SIGNED, _BEST, f", e AS (SELECT u, v, sum(cost) AS c FROM sg GROUP BY u, v) SELECT {_BOUND} AS energy, {_BOUND} AS bound, 0.0::DOUBLE AS gap, true AS proven FROM e JOIN best a ON a.node = u JOIN best b ON b.node = v", recursive=True))
def multicut_bound(spark, d):
    """What the exact solver finds for the whole problem, and the bound that proves it."""
    return contraction.bounds(_signed(spark, d)).select(_r("energy", 3).alias("energy"), _r("bound", 3).alias("bound"), _r("gap", 3).alias("gap"), "proven")


@query(_sql(_VOX, _ADJ, _GT, _BLOCKS, _ENDS, _SIGNED, " SELECT block_id, sum(least(cost, 0)) AS energy, sum(least(cost, 0)) AS bound, 0.0::DOUBLE AS gap, true AS proven FROM ends JOIN sg USING (u, v, edge_type) WHERE n = 2 GROUP BY block_id"))
def block_bounds(spark, d):
    """The proof of every block's problem."""
    out = blockwise.block_bounds(_signed(spark, d), _block_nodes(spark, d))
    return out.select("block_id", *(_r(c, 3).alias(c) for c in ("energy", "bound", "gap")), "proven")


@query(
    _sql(
        _VOX, _ADJ, _GT, _BLOCKS, _ENDS, _SIGNED,
        """, chosen AS (SELECT block_id FROM bl ORDER BY ((block_id + 1)::BIGINT * 48271) % 2147483647 LIMIT 5),
e AS (SELECT block_id, sum(CASE WHEN cost < 0 THEN cost ELSE 0 END) AS e FROM ends JOIN chosen USING (block_id) JOIN sg USING (u, v, edge_type) WHERE n = 2 GROUP BY block_id)
SELECT unnest(['fm-greedy', 'fm-ilp', 'fm-kl', 'greedy', 'ilp', 'kl']) AS solver, count(*) AS blocks, avg(e) AS energy FROM e""",
    )
)
def solver_comparison(spark, d):
    names = ["greedy", "kl", "ilp", "fm-greedy", "fm-kl", "fm-ilp"]
    return blockwise.compare_solvers(_signed(spark, d), _block_nodes(spark, d), names).drop("seconds")


@query(_sql(_VOX, _ADJ, _GT, _BEST, "SELECT node, component FROM best", recursive=True))
def blockwise_multicut(spark, d):
    return blockwise.multicut(_hierarchy(spark, d), "kl")


@query(_sql(_VOX, _ADJ, _GT, _BEST, "SELECT node, component FROM best", recursive=True))
def blockwise_multicut_two_levels(spark, d):
    return blockwise.multicut(_hierarchy(spark, d, 2), "kl")


_HELD = (_VOX, _ADJ, _GT, _BLOCKS, _ENDS, _SIGNED, _BLOCKED)


@query(_sql(*_HELD, "SELECT node, component FROM ns", recursive=True))
def no_stitching(spark, d):
    return blockwise.no_stitching(_hierarchy(spark, d))


@query(_sql(*_HELD, _REDUCED, _ATTRACTED, "SELECT ns.node, sa.component FROM ns JOIN sa ON sa.node = ns.component", recursive=True))
def stitch_attractive(spark, d):
    return blockwise.stitch_attractive(_hierarchy(spark, d))


_PAIRS = f""", g AS (SELECT p.block_id AS a, q.block_id AS b FROM bl p JOIN bl q ON {_MEET}),
btw AS (SELECT DISTINCT a, b, u, v FROM rends e JOIN rbn ON rbn.node = u + v - inside AND rbn.block_id <> e.block_id JOIN g ON a = least(e.block_id, rbn.block_id) AND b = greatest(e.block_id, rbn.block_id) WHERE n = 1),
pn AS (SELECT a, b, p.node FROM g JOIN rbn p ON p.block_id = a JOIN rbn q ON q.block_id = b AND q.node = p.node UNION SELECT a, b, u FROM btw UNION SELECT a, b, v FROM btw),
held AS (SELECT DISTINCT u, v, cost FROM re JOIN pn p ON p.node = u JOIN pn q ON q.node = v AND q.a = p.a AND q.b = p.b)""" + _closure("sm", "SELECT u AS a, v AS b FROM held WHERE cost > 0", "SELECT DISTINCT component AS node FROM ns")


@query(_sql(*_HELD, _REDUCED, _PAIRS, "SELECT ns.node, sm.component FROM ns JOIN sm ON sm.node = ns.component", recursive=True))
def stitch_multicut(spark, d):
    return blockwise.stitch_multicut(_hierarchy(spark, d))


def _block_voxels(spark: SparkSession, d: str) -> DataFrame:
    v = voxels(spark, d)
    return blocking.in_blocks(v.select("z", "y", "x", "seg"), _shape(v), BLOCK, HALO).select("block_id", "z", "y", "x", (F.col("seg") % 25 + F.col("block_id") % 3).alias("label"))


_BLAB = ", lab AS (SELECT block_id, z, y, x, seg % 25 + block_id % 3 AS label FROM bvox)"
_BOFF = ", boff AS (SELECT block_id, coalesce(sum(s) OVER (ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_by FROM (SELECT block_id, max(label) + 1 AS s FROM lab GROUP BY block_id))"
_OVER = """, n AS (SELECT p.block_id AS a, p.label AS la, q.block_id AS b, q.label AS lb, count(*) AS n FROM lab p JOIN lab q ON p.z = q.z AND p.y = q.y AND p.x = q.x AND p.block_id < q.block_id GROUP BY ALL),
ov AS (SELECT *, (n / sum(n) OVER (PARTITION BY a, b, la) + n / sum(n) OVER (PARTITION BY a, b, lb)) / 2 AS share FROM n),
partners AS (SELECT a, la, b, lb, share FROM (SELECT *, row_number() OVER (PARTITION BY a, b, la ORDER BY share DESC, lb) AS k FROM ov) WHERE k = 1 AND share > 0.5)"""
_OVERLAPPED = _BOFF + _OVER + _closure(
    "so", "SELECT la + x.offset_by AS a, lb + y.offset_by AS b FROM partners JOIN boff x ON x.block_id = a JOIN boff y ON y.block_id = b", "SELECT DISTINCT label + offset_by AS node FROM lab JOIN boff USING (block_id)"
)


@query(_sql(_VOX, _BLOCKS, _BLAB, _BOFF, "SELECT * FROM boff"))
def block_offsets(spark, d):
    return blockwise.block_label_offsets(_block_voxels(spark, d)).select("block_id", F.col("offset").cast("long").alias("offset_by"))


@query(_sql(_VOX, _BLOCKS, _BLAB, _OVER, "SELECT a, la, b, lb, n, round(share, 6) + 0.0 AS share FROM ov"))
def overlap_pairs(spark, d):
    return _rounded(blockwise.overlaps(_block_voxels(spark, d)), "share")


@query(_sql(_VOX, _BLOCKS, _BLAB, _OVER, "SELECT a, la, b, lb, round(share, 6) + 0.0 AS share FROM partners"))
def overlap_partners(spark, d):
    return _rounded(blockwise.best_partners(blockwise.overlaps(_block_voxels(spark, d))), "share")


@query(_sql(_VOX, _BLOCKS, _BLAB, _OVERLAPPED, "SELECT DISTINCT block_id, label, component FROM lab JOIN boff USING (block_id) JOIN so ON so.node = label + offset_by", recursive=True))
def stitch_overlap(spark, d):
    return blockwise.stitch_overlap(_block_voxels(spark, d))


@query(_sql(*_HELD, "SELECT block_id, z, y, x, component AS label FROM bvox JOIN ns ON ns.node = seg", recursive=True))
def subblock_segmentations(spark, d):
    return blockwise.block_segmentation(_hierarchy(spark, d))


# --- projection, workflows, metrics --------------------------------------------------------------------------


@query(_sql(_VOX, _ADJ, _GT, _REACH, ", k AS (SELECT component, dense_rank() OVER (ORDER BY component) AS label FROM (SELECT DISTINCT component FROM cc)) SELECT z, y, x, CASE WHEN seg = 3 THEN 0 ELSE label END::BIGINT AS label FROM vox JOIN cc ON cc.node = seg JOIN k USING (component)", recursive=True))
def project_nodes(spark, d):
    out = workflows.project(voxels(spark, d), _slice_merge(spark, d), ignore_label=3)
    return out.select("z", "y", "x", F.col("label").cast("long").alias("label"))


def _labelled(parts: tuple[str, ...], label: str, source: str) -> str:
    """Voxels with the rank of their component."""
    return _sql(*parts, f", k AS (SELECT component, dense_rank() OVER (ORDER BY component) AS label FROM (SELECT DISTINCT {label} AS component FROM {source})) SELECT z, y, x, label::BIGINT AS label FROM {source} JOIN k ON k.component = {label}", recursive=True)


def _of_nodes(partition: str) -> str:
    return f", lv AS (SELECT z, y, x, component AS c FROM vox JOIN ({partition}) ON node = seg)"


@query(_labelled((_VOX, _ADJ, _GT, _BEST, _of_nodes("SELECT * FROM best")), "c", "lv"))
def multicut_segmentation(spark, d):
    v = voxels(spark, d)
    return workflows.multicut_segmentation(v, _signed(spark, d), name="kl")


def _stitched(way: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        v = voxels(spark, d)
        return workflows.blockwise_segmentation(v, _signed(spark, d), _shape(v), BLOCK, HALO, stitching=way, sub_solver="kl", solver="kl")

    run.__name__ = f"segmentation_{way}"
    return run


_BLOCK_LABELS = ", lab AS (SELECT block_id, z, y, x, component AS label FROM bvox JOIN ns ON ns.node = seg)"
_WAYS = {
    "multicut": (_VOX, _ADJ, _GT, _BEST, _of_nodes("SELECT * FROM best")),
    "attractive": (*_HELD, _REDUCED, _ATTRACTED, _of_nodes("SELECT ns.node, sa.component FROM ns JOIN sa ON sa.node = ns.component")),
    "pairs": (*_HELD, _REDUCED, _PAIRS, _of_nodes("SELECT ns.node, sm.component FROM ns JOIN sm ON sm.node = ns.component")),
    "overlap": (*_HELD, _BLOCK_LABELS, _OVERLAPPED, ", lv AS (SELECT z, y, x, min(component) AS c FROM lab JOIN boff USING (block_id) JOIN so ON so.node = label + offset_by GROUP BY z, y, x)"),
    "none": (*_HELD, _of_nodes("SELECT * FROM ns")),
}
for _way, _parts in _WAYS.items():
    query(_labelled(_parts, "c", "lv"))(_stitched(_way))

_CONT = ", t AS (SELECT seg AS s, gt AS g, count(*) AS n FROM vox WHERE gt <> 0 GROUP BY ALL)"
_TOTALS = ", s AS (SELECT s, sum(n) AS n FROM t GROUP BY s), g AS (SELECT g, sum(n) AS n FROM t GROUP BY g), k AS (SELECT (SELECT sum(n * log2(n)) FROM t) AS ht, (SELECT sum(n * log2(n)) FROM s) AS hs, (SELECT sum(n * log2(n)) FROM g) AS hg, (SELECT sum(n) FROM t) AS n, (SELECT sum(n::DOUBLE * n) FROM t) AS qt, (SELECT sum(n::DOUBLE * n) FROM s) AS qs, (SELECT sum(n::DOUBLE * n) FROM g) AS qg)"


@query(_sql(_VOX, _CONT, "SELECT * FROM t"))
def contingency(spark, d):
    return metrics.contingency(voxels(spark, d))


_SCORES = "SELECT round((hg - ht) / n, 6) + 0.0 AS vi_split, round((hs - ht) / n, 6) + 0.0 AS vi_merge, round(1 - 2 * (qt / qs) * (qt / qg) / (qt / qs + qt / qg), 6) + 0.0 AS adapted_rand FROM k"


@query(_sql(_VOX, _CONT, _TOTALS, _SCORES))
def vi_rand(spark, d):
    return _rounded(metrics.scores(voxels(spark, d)), "vi_split", "vi_merge", "adapted_rand")


@query(_sql(_VOX, _ADJ, _GT, _BEST, ", t AS (SELECT component AS s, gt AS g, count(*) AS n FROM vox JOIN best ON node = seg WHERE gt <> 0 GROUP BY ALL)", _TOTALS, _SCORES, recursive=True))
def workflow_scores(spark, d):
    """The whole block-wise workflow, scored against the truth."""
    v = voxels(spark, d)
    made = workflows.blockwise_segmentation(v, _signed(spark, d), _shape(v), BLOCK, HALO, stitching="multicut", sub_solver="fm-ilp", solver="fm-kl")
    return _rounded(metrics.scores(made.join(v.select("z", "y", "x", "gt"), ["z", "y", "x"]), "label"), "vi_split", "vi_merge", "adapted_rand")


# --- defects ---------------------------------------------------------------------------------------------------


def _uneven(spark: SparkSession, d: str) -> DataFrame:
    """The volume with fewer segments in some slices."""
    return voxels(spark, d).withColumn("seg", F.when(F.col("z") % 7 == 3, F.expr("seg div 5")).otherwise(F.col("seg")))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return defects.segments_per_slice(_uneven(spark, d))


_HIST = ", r AS (SELECT CASE WHEN min(n_segs) = max(n_segs) THEN min(n_segs) - 0.5 ELSE min(n_segs) END::DOUBLE AS lo, CASE WHEN min(n_segs) = max(n_segs) THEN max(n_segs) + 0.5 ELSE max(n_segs) END::DOUBLE AS hi FROM segs), h AS (SELECT least(15, floor((n_segs - lo) / ((hi - lo) / 16)))::INT AS bin, count(*) AS n FROM segs, r GROUP BY 1), hist AS (SELECT range::INT AS bin, coalesce(n, 0) AS n, lo + range * (hi - lo) / 16 AS left_edge FROM r, range(16) LEFT JOIN h ON bin = range)"


@query(_sql(_VOX, _SLICES, "SELECT * FROM segs"))
def slice_segments(spark, d):
    return _counts(spark, d)


@query(_sql(_VOX, "SELECT z, (y // 5)::INT AS py, (x // 5)::INT AS px, count(DISTINCT seg) AS n_segs FROM vox GROUP BY ALL"))
def patch_segments(spark, d):
    return defects.segments_per_patch(voxels(spark, d), 5).select("z", F.col("py").cast("int").alias("py"), F.col("px").cast("int").alias("px"), "n_segs")


@query(_sql(_VOX, _SLICES, "SELECT round(avg(n_segs), 6) AS mean, round(stddev_pop(n_segs), 6) AS std, min(n_segs) AS lo, max(n_segs) AS hi FROM segs"))
def slice_statistics(spark, d):
    return _rounded(defects.statistics(_counts(spark, d)), "mean", "std")


@query(_sql(_VOX, _SLICES, _HIST, "SELECT bin, n, round(left_edge, 6) + 0.0 AS left_edge FROM hist"))
def slice_histogram(spark, d):
    return defects.histogram(_counts(spark, d)).select("bin", "n", _r("left").alias("left_edge"))


@query(_sql(_VOX, _SLICES, _HIST, "SELECT z FROM segs, hist WHERE bin = 2 AND n_segs < left_edge"))
def defect_slices(spark, d):
    return defects.defect_slices(_counts(spark, d))


@query(_sql(_VOX, ", p AS (SELECT z, b.range * 3 + c.range AS patch_id, count(DISTINCT seg) AS n_segs FROM vox, range(3) b, range(3) c WHERE y >= b.range * 10 - 2 AND y < b.range * 10 + 12 AND x >= c.range * 10 - 2 AND x < c.range * 10 + 12 GROUP BY ALL) SELECT z, patch_id::INT AS patch_id, n_segs FROM p WHERE n_segs < 0.9 * (SELECT avg(n_segs) FROM p)"))
def defect_patches(spark, d):
    return defects.defect_patches(voxels(spark, d), (25, 25), 10, 2, 0.9)


_BADN = ", md AS (SELECT z, seg AS node, max((NOT mask AND x < 4)::INT) AS bad FROM vox GROUP BY z, seg), sh AS (SELECT z, avg(bad) AS share FROM md GROUP BY z), dn AS (SELECT node, z FROM md JOIN sh USING (z) WHERE bad = 1 OR share > 0.5)"


def _bad_nodes(spark: SparkSession, d: str) -> DataFrame:
    return defects.defect_nodes(voxels(spark, d).withColumn("is_defect", ~F.col("mask") & (F.col("x") < 4)))


@query(_sql(_VOX, _BADN, "SELECT * FROM dn"))
def defect_nodes(spark, d):
    return _bad_nodes(spark, d)


@query(_sql(_VOX, ", p AS (SELECT seg AS node, z, avg(prob) AS prob FROM vox GROUP BY seg, z), sh AS (SELECT z, avg((prob > 0.55)::INT) AS share FROM p GROUP BY z) SELECT node, z FROM p JOIN sh USING (z) WHERE prob > 0.55 OR share > 0.5"))
def defect_nodes_probability(spark, d):
    p = voxels(spark, d).groupBy(F.col("seg").alias("node"), "z").agg(F.avg("prob").alias("prob"))
    return defects.defect_nodes_from_probability(p, node_threshold=0.55)


_SKIP = ", gap AS (SELECT min(z) - 1 AS lo, max(z) + 1 AS hi FROM (SELECT z, z - row_number() OVER (ORDER BY z) AS g FROM ds) GROUP BY g), sk AS (SELECT least(a.seg, b.seg) AS u, greatest(a.seg, b.seg) AS v, lo AS skip_start, hi - lo AS skip_range, count(*) AS length FROM gap JOIN vox a ON a.z = lo JOIN vox b ON b.z = hi AND b.y = a.y AND b.x = a.x GROUP BY ALL)"


@query(_sql(_VOX, _DEFECT, _SKIP, "SELECT u, v, skip_start::INT AS skip_start, skip_range::INT AS skip_range, length FROM sk"))
def skip_edges(spark, d):
    return defects.skip_edges(voxels(spark, d), _bad_slices(spark, d))


@query(_sql(_VOX, _DEFECT, _SKIP, f", bv AS (SELECT least(a.seg, b.seg) AS u, greatest(a.seg, b.seg) AS v, 'skip' AS edge_type, unnest([a.prob, b.prob]) AS value FROM gap JOIN vox a ON a.z = lo JOIN vox b ON b.z = hi AND b.y = a.y AND b.x = a.x) SELECT u, v, edge_type, {_NINE} FROM bv GROUP BY u, v, edge_type"))
def skip_edge_features(spark, d):
    v = voxels(spark, d).withColumn("value", F.col("prob"))
    return _nine(features.edge_statistics(defects.skip_border_values(v, _bad_slices(spark, d))))


def _skip_filters_sql(sides: str) -> str:
    pairs = f", sides AS (SELECT least(a.seg, b.seg) AS u, greatest(a.seg, b.seg) AS v, 'skip' AS edge_type, unnest({sides}) AS z, a.y, a.x FROM gap JOIN vox a ON a.z = lo JOIN vox b ON b.z = hi AND b.y = a.y AND b.x = a.x)"
    return _sql(_VOX, _DEFECT, _SKIP, _FILTERS, pairs, f"SELECT u, v, edge_type, {_EACH} FROM sides JOIN filters USING (z, y, x) GROUP BY u, v, edge_type")


def _skip_filters(spark: SparkSession, d: str, z_direction: int) -> DataFrame:
    v = voxels(spark, d)
    responses = kernels.filtered(v)
    out = defects.skip_filter_features(v.select("z", "y", "x", "seg").join(responses, ["z", "y", "x"]), _bad_slices(spark, d), responses.columns[3:], z_direction=z_direction)
    return _rounded(out, *out.columns[3:])


@query(_skip_filters_sql("[lo, hi]"))
def skip_edge_features_filters(spark, d):
    return _skip_filters(spark, d, rag.Z_BOTH)


@query(_skip_filters_sql("[lo]"))
def skip_edge_features_filters_lower(spark, d):
    return _skip_filters(spark, d, rag.Z_LOWER)


@query(_skip_filters_sql("[hi]"))
def skip_edge_features_filters_upper(spark, d):
    return _skip_filters(spark, d, rag.Z_UPPER)


@query(
    _sql(
        _VOX, _ADJ, _DEFECT, _SKIP,
        """, b AS (SELECT DISTINCT seg AS node FROM vox JOIN ds USING (z)), e AS (SELECT u, v, edge_type, length, (u IN (SELECT node FROM b)) <> (v IN (SELECT node FROM b)) AS mixed FROM rag)
SELECT u, v, edge_type, length, mixed AND edge_type = 'xy' AS is_ignored, NULL::INT AS skip_start, NULL::INT AS skip_range FROM e WHERE NOT (mixed AND edge_type = 'z')
UNION ALL SELECT u, v, 'skip', length, false, skip_start::INT, skip_range::INT FROM sk""",
    )
)
def modified_adjacency(spark, d):
    v, bad = voxels(spark, d), _bad_slices(spark, d)
    nodes = v.join(bad, "z", "left_semi").select(F.col("seg").alias("node")).distinct()
    return defects.modified_adjacency(rag.rag_edges(v), nodes, defects.skip_edges(v, bad))


# The problem over defects: regions of defective slices and others that touch a mask, skip edges, in-slice edges that are ignored.
_BRIDGED = """, b AS (SELECT DISTINCT seg AS node FROM vox JOIN ds USING (z) UNION SELECT node FROM dn), e AS (SELECT u, v, edge_type, length, (u IN (SELECT node FROM b)) <> (v IN (SELECT node FROM b)) AS mixed FROM rag),
br AS (SELECT u, v, edge_type, length, mixed AND edge_type = 'xy' AS is_ignored FROM e WHERE NOT (mixed AND edge_type = 'z') UNION ALL SELECT u, v, 'skip', length, false FROM sk)"""
_BRIDGED_COSTS = """,
bv AS (SELECT u, v, edge_type, unnest([prob, n_prob]) AS value FROM adj UNION ALL SELECT least(a.seg, b.seg), greatest(a.seg, b.seg), 'skip', unnest([a.prob, b.prob]) FROM gap JOIN vox a ON a.z = lo JOIN vox b ON b.z = hi AND b.y = a.y AND b.x = a.x),
pr AS (SELECT u, v, edge_type, round(avg(value), 6) AS prob FROM bv GROUP BY u, v, edge_type),
raw AS (SELECT *, ln((1 - (0.998 * prob + 0.001)) / (0.998 * prob + 0.001)) AS c FROM br JOIN pr USING (u, v, edge_type)),
w AS (SELECT * EXCLUDE (c), CASE WHEN edge_type = 'xy' THEN c ELSE c * 16.0 * length / (SELECT max(length) FROM raw WHERE edge_type <> 'xy') END AS c FROM raw)"""


def _bridged(spark: SparkSession, d: str) -> DataFrame:
    return defects.bridged(voxels(spark, d), edges(spark, d), _bad_slices(spark, d), _bad_nodes(spark, d))


@query(_sql(_VOX, _ADJ, _GT, _DEFECT, _SKIP, _BADN, _BRIDGED, " SELECT u, v, edge_type, a.gt AS u_gt, b.gt AS v_gt, (a.gt <> b.gt)::INT AS is_cut, a.gt <> 5 AND b.gt <> 5 AS is_labelled FROM br JOIN ngt a ON a.node = u JOIN ngt b ON b.node = v"))
def bridged_truth(spark, d):
    """Truth of the edges of the problem over defects, with one label to ignore."""
    return costs.edge_truth(_bridged(spark, d), costs.node_truth(voxels(spark, d)), ignore_label=5)


@query(_sql(_VOX, _ADJ, _DEFECT, _SKIP, _BADN, _BRIDGED, _BRIDGED_COSTS, " SELECT u, v, edge_type, length, prob, round(CASE WHEN is_ignored THEN 2 * (SELECT min(c) FROM w) ELSE c END, 6) + 0.0 AS cost FROM w"))
def bridged_costs(spark, d):
    """Costs of the problem over defects: skip edges are weighted as edges between slices, ignored ones repel most."""
    skip = features.edge_statistics(defects.skip_border_values(voxels(spark, d), _bad_slices(spark, d), ("prob",)), ("prob",))
    p = _probabilities(spark, d).unionByName(skip.select("u", "v", "edge_type", F.round("mean", 6).alias("prob")))
    return _rounded(costs.multicut_problem(_bridged(spark, d), p, scheme="z"), "cost")


@query(
    _sql(
        _VOX, _ADJ, _GT, _DEFECT, _SKIP, ", dn AS (SELECT 0::BIGINT AS node WHERE false)", _BRIDGED,
        _closure("best", "SELECT u AS a, v AS b FROM br JOIN ngt g ON g.node = u JOIN ngt h ON h.node = v WHERE g.gt = h.gt AND NOT is_ignored"),
        """, k AS (SELECT component, dense_rank() OVER (ORDER BY component) AS label FROM (SELECT DISTINCT component FROM best)),
src AS (SELECT z, CASE WHEN z % 7 = 3 THEN z - 1 ELSE z + 1 END AS source FROM ds)""",
        "SELECT v.z, v.y, v.x, label::BIGINT AS label FROM vox v LEFT JOIN src USING (z) JOIN vox w ON w.z = coalesce(source, v.z) AND w.y = v.y AND w.x = v.x JOIN best ON node = w.seg JOIN k USING (component)",
        recursive=True,
    )
)
def bridged_segmentation(spark, d):
    """The whole problem over defective slices, projected, with their voxels replaced."""
    v, bad = voxels(spark, d), _bad_slices(spark, d)
    e = cut(defects.bridged(v, edges(spark, d), bad))
    t = costs.edge_truth(e, costs.node_truth(v)).select("u", "v", "edge_type", "is_cut")
    length = F.col("length").cast("double")
    problem = costs.ignore_costs(e.join(t, ["u", "v", "edge_type"]).withColumn("cost", F.when(F.col("is_cut") == 1, -length).otherwise(length + 0.5)))
    return workflows.multicut_segmentation(v, problem.select("u", "v", "edge_type", "length", "cost"), name="kl", defects=bad, n_slices=_shape(v)[0])


@query(_sql(_VOX, _DEFECT, "SELECT z, coalesce(z - lag(z) OVER (ORDER BY z) = 1, false) AS has_lower FROM ds"))
def has_lower_defect(spark, d):
    return defects.has_lower_defect(_bad_slices(spark, d))


@query(_sql(_VOX, _DEFECT, "SELECT z, CASE WHEN z % 7 = 3 THEN z - 1 ELSE z + 1 END::INT AS source FROM ds"))
def replacement_slices(spark, d):
    return defects.replacement_slices(_bad_slices(spark, d), _shape(voxels(spark, d))[0])


@query(_sql(_VOX, _DEFECT, ", src AS (SELECT z, CASE WHEN z % 7 = 3 THEN z - 1 ELSE z + 1 END AS source FROM ds) SELECT v.z, v.y, v.x, coalesce(w.seg, v.seg) AS seg FROM vox v LEFT JOIN src USING (z) LEFT JOIN vox w ON w.z = source AND w.y = v.y AND w.x = v.x"))
def replace_slices(spark, d):
    v = voxels(spark, d).select("z", "y", "x", "seg")
    return defects.replace_slices(v, defects.replacement_slices(_bad_slices(spark, d), _shape(v)[0]))


@query(_sql(_VOX, _DEFECT, "SELECT z, min(z) OVER (PARTITION BY g)::INT AS run, count(*) OVER (PARTITION BY g) AS run_len FROM (SELECT z, z - row_number() OVER (ORDER BY z) AS g FROM ds)"))
def slice_runs(spark, d):
    return ids.runs(_bad_slices(spark, d), "z").select("z", "run", "run_len")


@query(_sql(_VOX, "SELECT coalesce(bool_and(ok), true) AS is_sorted FROM (SELECT m >= lag(m) OVER (ORDER BY z) AS ok FROM (SELECT z, max(seg) AS m FROM vox GROUP BY z))"))
def is_sorted(spark, d):
    return defects.is_sorted(voxels(spark, d).groupBy("z").agg(F.max("seg").alias("m")), "z", "m")


# --- row tools ---------------------------------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, l_linenumber, min(l_orderkey) AS first_index FROM lineitem GROUP BY ALL")
def unique_rows(spark, d):
    return tables.unique_rows(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_returnflag", "l_linestatus", "l_linenumber"], "l_orderkey")


@query("SELECT x.x_index, o_orderkey AS y_index FROM orders JOIN (SELECT c_custkey, max(c_nationkey) AS x_index FROM customer GROUP BY c_custkey) x ON c_custkey = o_custkey")
def matching_rows(spark, d):
    x = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("i"))
    y = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("i"))
    return tables.matching_rows(x, y, ["k"], "i")


@query(_sql(_VOX, _ADJ, "SELECT u, v, edge_type FROM rag WHERE u % 5 < 2 AND v % 5 < 2"))
def rows_within(spark, d):
    nodes = rag.rag_nodes(voxels(spark, d)).where("node % 5 < 2")
    return tables.rows_within(edges(spark, d).select("u", "v", "edge_type"), ["u", "v"], nodes, "node")


@query("SELECT c_custkey, r_regionkey AS c_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def replace_values(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_nationkey")
    return tables.replaced(c, "c_nationkey", spark.read.parquet(f"{d}/nation.parquet"), "n_nationkey", "n_regionkey")


@query("SELECT r_regionkey, n_nationkey FROM region, nation")
def cartesian(spark, d):
    return tables.cartesian(spark.read.parquet(f"{d}/region.parquet").select("r_regionkey"), spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey"))


@query(_sql(_VOX, _ADJ, ", m AS (SELECT seg FROM vox GROUP BY seg HAVING avg(prob) > 0.5) SELECT u, v, edge_type FROM rag WHERE u IN (FROM m) AND v IN (FROM m)"))
def node_pairs(spark, d):
    """Pairs among the regions that are mostly boundary: all edges are read."""
    nodes = voxels(spark, d).groupBy(F.col("seg").alias("node")).agg(F.avg("prob").alias("p")).where("p > 0.5").select("node")
    return tables.node_pairs(nodes, edges(spark, d).select("u", "v", "edge_type"))


@query(_sql(_VOX, _ADJ, ", a AS (SELECT u, v, row_number() OVER (ORDER BY edge_type, u, v) - 1 AS a_id FROM rag) SELECT a_id, a_id * 2 + 1 AS b_id FROM a"))
def edge_permutation(spark, d):
    a = rag.with_edge_ids(edges(spark, d)).select(F.col("edge_id").cast("long").alias("edge_id"), "u", "v")
    return tables.edge_permutation(a, a.select((F.col("edge_id") * 2 + 1).alias("edge_id"), F.col("v").alias("u"), F.col("u").alias("v")))


@query(_sql(_VOX, "SELECT seg FROM vox UNION SELECT gt + 1000000 FROM vox EXCEPT SELECT 25 * range::BIGINT FROM range(1000)"))
def label_sets(spark, d):
    v = voxels(spark, d)
    every = v.select("seg").union(v.select((F.col("gt") + 1_000_000).alias("seg"))).distinct()
    return every.join(spark.range(1000).select((25 * F.col("id")).alias("seg")), "seg", "left_anti")


# --- learning, kernels ----------------------------------------------------------------------------------------------


@query()
def rf_train_predict(spark, d):
    v = voxels(spark, d)
    f = features.edge_features(v)
    model = learning.EdgeClassifier.learn([(f, _truth(spark, d))], n_trees=10, max_depth=5)
    return model.predict(f)


@query()
def rf_joined(spark, d):
    v = voxels(spark, d)
    f = features.edge_features(v)
    return learning.EdgeClassifier.learn([(f, _truth(spark, d)), (f, _truth(spark, d))], separate=False, n_trees=5, max_depth=5).predict(f)


@query()
def rf_defects(spark, d):
    v = voxels(spark, d)
    n = features.region_statistics(v)
    truth = n.select("node").join(_bad_nodes(spark, d).select("node", F.lit(1).alias("b")), "node", "left").select("node", F.coalesce("b", F.lit(0)).alias("is_defect"))
    return learning.probability(learning.learn_defects(n, truth, n_trees=5), n, ("node",))


@query(_sql(_VOX, """, e AS (SELECT z, y, x FROM vox WHERE prob >= 0.9),
m AS (SELECT v.z, v.y, v.x, any_value(v.prob) AS prob, min((v.y - e.y) ** 2 + (v.x - e.x) ** 2) AS m FROM vox v LEFT JOIN e ON e.z = v.z GROUP BY v.z, v.y, v.x)
SELECT z, y, x, round(CASE WHEN prob >= 0.9 THEN -prob WHEN m IS NULL THEN 50 ELSE sqrt(m) END, 6) + 0.0 AS distance FROM m"""))  # fmt: skip
def distance_transform(spark, d):
    return _rounded(kernels.per_slice(voxels(spark, d), lambda p, _: {"distance": kernels.signed_distance(p, 0.9)}, "prob", "distance double"), "distance")


_MAXIMA = ", lv AS (SELECT z, y, x, z * 625 + y * 25 + x AS id, floor(prob * 60)::DOUBLE AS value FROM vox), " + """
nb AS (SELECT a.id, a.value, b.id AS n_id, b.value AS n_value FROM lv a, range(27) s, lv b WHERE s.range <> 13 AND b.z = a.z + s.range // 9 - 1 AND b.y = a.y + (s.range // 3) % 3 - 1 AND b.x = a.x + s.range % 3 - 1)""" + _closure(
    "pl", "SELECT id AS a, n_id AS b FROM nb WHERE value = n_value", "SELECT id AS node FROM lv"
)


@query(_sql(_VOX, _MAXIMA, ", spoilt AS (SELECT DISTINCT component FROM pl JOIN nb ON id = node WHERE n_value > value) SELECT z, y, x, value, component::BIGINT AS plateau FROM lv JOIN pl ON node = id WHERE component NOT IN (FROM spoilt) AND value > (SELECT min(value) FROM lv)", recursive=True))
def local_maxima(spark, d):
    """Maxima of the volume, with plateaus across slices."""
    return maxima.local_maxima(voxels(spark, d).withColumn("prob", F.floor(F.col("prob") * 60).cast("double")))


@query()
def watershed_seeds(spark, d):
    return tiles.seeds(voxels(spark, d), 0.9, 1.0)


@query()
def wsdt(spark, d):
    return tiles.wsdt_segmentation(voxels(spark, d), threshold=0.9, sigma=1.0, min_size=5)


@query()
def wsdt_masked(spark, d):
    return tiles.wsdt_segmentation(voxels(spark, d), threshold=0.9, sigma=1.0, min_size=5, mask="mask")


@query(_sql(_VOX, "SELECT z, count(*) AS n_voxels, 0::BIGINT AS n_unlabelled, 0::BIGINT AS n_small, 0::BIGINT AS n_split FROM vox GROUP BY z"))
def wsdt_invariants(spark, d):
    """Every voxel has a segment, none is too small, each is in one piece; tiles of 10 voxels."""
    made = tiles.wsdt_segmentation(voxels(spark, d), threshold=0.9, sigma=1.0, min_size=5, tile=10)
    return tiles.invariants(made.withColumn("seg", F.col("seg") + 1), 5, "seg")  # its labels start at 0


@query(_sql(_VOX, "SELECT z, count(*) AS n_voxels, count(*) FILTER (NOT mask) AS n_unlabelled, 0::BIGINT AS n_small, 0::BIGINT AS n_split FROM vox GROUP BY z"))
def wsdt_masked_invariants(spark, d):
    """Voxels without a segment are those outside the mask."""
    return tiles.invariants(tiles.wsdt_segmentation(voxels(spark, d), threshold=0.9, sigma=1.0, min_size=5, mask="mask"), 1, "seg")


@query(_sql(_VOX, _FILTERS, "SELECT z, y, x, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _CHANNELS) + " FROM filters"))
def image_filters(spark, d):
    return _rounded(kernels.filtered(voxels(spark, d)), *_CHANNELS)


@query("SELECT 'exact' AS solver, -5.5::DOUBLE AS energy UNION ALL SELECT 'trivial', 0.0::DOUBLE")
def golden_multicut(spark, d):
    """A problem of four nodes whose optimum is known, and the partition of one set."""
    uv, c = np.array([[0, 1], [1, 2], [0, 2], [2, 3], [0, 3]]), np.array([2, -1, -0.5, 3, -4])
    p = solvers.Problem(4, uv, c)
    best = p.energy(solvers.exact(p, solvers.Limits()))
    return spark.createDataFrame([("exact", best), ("trivial", p.energy(np.zeros(4, int)))], "solver string, energy double")
