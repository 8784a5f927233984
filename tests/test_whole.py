"""Queries without SQL run over all slices."""

from pyspark.sql import functions as F

from voxgraph import queries

SF = "/root/testdata/sf0.001"


def test_solvers_and_overlaps_cover_all_slices(spark, monkeypatch):
    nodes = {r.seg for r in queries.voxels(spark, SF).select("seg").distinct().collect()}
    assert len(nodes) > 25
    for name in ("solve_greedy", "solve_kl", "solve_fusion_kl"):
        assert {r.node for r in queries.QUERIES[name](spark, SF).collect()} == nodes
    monkeypatch.setattr(queries, "voxels", lambda s, d: s.range(16 * 625).select((F.col("id") / 625).cast("int").alias("z"), (F.col("id") % 625 / 25).cast("int").alias("y"), (F.col("id") % 25).cast("int").alias("x"), (F.col("id") % 7).alias("seg")))
    assert {r.block_id // 9 for r in queries.QUERIES["stitch_overlap"](spark, SF).select("block_id").distinct().collect()} == {0, 1, 2, 3}
