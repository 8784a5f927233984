"""Values worked out by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgraph.config import Params, read_inputs, select_features
from voxgraph.functions import ids, metrics, tables
from voxgraph.operators import blocking, blockwise, costs, defects, features, graph, labels, rag, solvers
from voxgraph.plans import workflows
from voxgraph.sources import volume

SEG = np.array([[[0, 0, 1, 1], [0, 0, 1, 1], [0, 0, 2, 2], [0, 0, 2, 2]], [[3, 3, 3, 4], [3, 3, 3, 4], [3, 3, 3, 4], [5, 5, 5, 5]]])


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(z, y, x, float(16 * z + 4 * y + x), int(SEG[z, y, x]), 1 if x < 2 else 2) for z in range(2) for y in range(4) for x in range(4)]
    return spark.createDataFrame(rows, "z int, y int, x int, raw double, seg long, gt long").cache()


def pairs(df, *cols):
    return {tuple(r)[:-1]: r[-1] for r in df.select(*cols).collect()}


def test_adjacency(tiny):
    got = pairs(rag.rag_edges(tiny), "edge_type", "u", "v", "length")
    xy = {(0, 1): 2, (0, 2): 2, (1, 2): 2, (3, 4): 3, (3, 5): 3, (4, 5): 1}
    z = {(0, 3): 6, (0, 5): 2, (1, 3): 2, (1, 4): 2, (2, 3): 1, (2, 4): 1, (2, 5): 2}
    assert got == {("xy", *k): n for k, n in xy.items()} | {("z", *k): n for k, n in z.items()}
    e = rag.with_edge_ids(rag.rag_edges(tiny)).orderBy("edge_id").collect()
    assert [r.edge_id for r in e] == list(range(13)) and [r.edge_type for r in e] == ["xy"] * 6 + ["z"] * 7


def test_labels_and_truth(tiny):
    assert {tuple(r) for r in labels.slice_labels(tiny).collect()} == {(0, 0, 2, 3), (1, 3, 5, 3)}
    assert pairs(costs.node_truth(tiny), "node", "gt") == {(0,): 1, (1,): 2, (2,): 2, (3,): 1, (4,): 2, (5,): 1}


def test_region_statistics(tiny):
    got = {r.node: r for r in features.region_statistics(tiny).collect()}
    for node, n, lo, hi, total, var, cy, cx, wy, wx in [
        (0, 8, 0, 13, 52, 20.25, 1.5, 0.5, 2.269231, 0.538462), (1, 4, 2, 7, 18, 4.25, 0.5, 2.5, 0.722222, 2.555556), (2, 4, 10, 15, 50, 4.25, 2.5, 2.5, 2.58, 2.52),
        (3, 9, 16, 26, 189, 11.333333, 1, 1, 1.126984, 1.031746), (4, 3, 19, 27, 69, 10.666667, 1, 3, 1.115942, 3), (5, 4, 28, 31, 118, 1.25, 3, 1.5, 3, 1.542373),
    ]:
        r = got[node]
        assert np.allclose([r["count"], r.min, r.max, r["sum"], r.variance, r.c_y, r.c_x, r.wc_y, r.wc_x], [n, lo, hi, total, var, cy, cx, wy, wx], atol=1e-6)


def test_scores(tiny):
    r = metrics.scores(tiny).first()
    assert np.allclose(tuple(r), (1.843139, 0.383271, 0.557423), atol=1e-6)
    same = metrics.scores(tiny.withColumn("seg", F.col("gt"))).first()
    assert np.allclose(tuple(same), (0, 0, 0), atol=1e-12)


def test_statistics(spark):
    v = spark.createDataFrame([(0, 0, i, float(x), 0) for i, x in enumerate([1, 2, 3, 10])] + [(0, 1, i, 5.0, 1) for i in range(3)], "z int, y int, x int, raw double, seg long")
    got = {r.node: r for r in features.region_statistics(v).collect()}
    r = got[0]
    assert np.allclose([r.variance, r.skewness, r.kurtosis, *(r[f"q{i}"] for i in range(7))], [12.5, 1.0182338, -0.7696, 1, 1.3, 1.75, 2.5, 4.75, 7.9, 10], atol=1e-4)
    assert (got[1].skewness, got[1].kurtosis) == (0, 0)


def test_costs(spark):
    p = spark.createDataFrame([(0.0,), (0.2,), (0.5,), (1.0,), (float("nan"),)], "p double").select(costs.cost_of(F.col("p"))).collect()
    assert np.allclose([r[0] for r in p], [6.906754778648554, 1.3825485707493879, 0, -6.906754778648553, 0])


def test_weighting_without_one_kind(spark):
    e = spark.createDataFrame([(0, 1, "xy", 4, 1.0)], "u long, v long, edge_type string, length long, cost double")
    assert costs.weighted(e, "z").first().cost == 1.0 and costs.weighted(e, "other").first().cost == 1.0


def test_exact_and_contraction(spark):
    uv, c = np.array([[0, 1], [1, 2], [0, 2], [2, 3], [0, 3]]), np.array([2, -1, -0.5, 3, -4])
    p = solvers.Problem(4, uv, c)
    got = solvers.exact(p, solvers.Limits())
    assert got.tolist() == [0, 0, 1, 1] and p.energy(got) == -5.5
    e = spark.createDataFrame([(0, 1, 2.0), (1, 2, -1.0), (0, 2, -0.5), (2, 3, 3.0)], "u long, v long, cost double")
    m = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 2)], "node long, component long")
    assert {tuple(r) for r in graph.contract(e, m).collect()} == {(0, 1, -1.5), (1, 2, 3.0)}


def test_offsets(spark):
    v = spark.createDataFrame([(z, 0, x, x) for z, top in enumerate((4, 2, 7)) for x in range(top + 1)], "z int, y int, x int, seg long")
    assert [r.offset for r in labels.label_offsets(v).orderBy("z").collect()] == [0, 5, 8]
    assert [r.offset for r in labels.label_offsets(v, masked=True).orderBy("z").collect()] == [0, 4, 6]


@pytest.mark.parametrize("bad, want", [([0], [1]), ([4], [3]), ([4, 5], [3, 6]), ([8, 9], [7, 7]), ([4, 5, 6], [3, 3, 7]), ([0, 1, 2], [3, 3, 3]), ([3, 4, 5, 6], [2, 2, 7, 7])])
def test_replacement_slices(spark, bad, want):
    z = spark.createDataFrame([(b,) for b in bad], "z int")
    assert [r.source for r in defects.replacement_slices(z, 10).orderBy("z").collect()] == want


def test_long_run_is_an_error(spark):
    with pytest.raises(Exception, match="more than four"):
        defects.replacement_slices(spark.range(5).select(F.col("id").cast("int").alias("z")), 10).collect()


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (900, 900), (None, 3)], "u long, v long")
    got = pairs(graph.connected_components(e), "node", "component")
    assert got == {(i,): 0 for i in range(201)} | {(500,): 500, (501,): 500, (900,): 900}
    assert graph.connected_components(e.where("false")).count() == 0
    again = graph.connected_components(graph.connected_components(e), "node", "component")
    assert pairs(again, "node", "component") == got


def test_dense_ids_and_runs(spark):
    d = ids.dense_ids(spark.range(1000).select((F.col("id") * 3).alias("k")).repartition(7), ["k"], "n", 5)
    assert d.where("n <> k div 3 + 5").count() == 0
    r = ids.runs(spark.createDataFrame([(z,) for z in (1, 2, 5, 7, 8, 9)], "z int"), "z").orderBy("z").collect()
    assert [(x.run, x.run_len, x.pos) for x in r] == [(1, 2, 1), (1, 2, 2), (5, 1, 1), (7, 3, 1), (7, 3, 2), (7, 3, 3)]


def test_single_block_has_no_neighbour(spark):
    b = blocking.blocks(spark, (2, 4, 4), (50, 512, 512), (5, 20, 20))
    assert b.count() == 1 and blocking.block_graph(b).count() == 0


@pytest.mark.parametrize("stitching", ["multicut", "attractive", "pairs", "none", "overlap"])
def test_blockwise_segmentation(spark, tiny, stitching):
    e = rag.rag_edges(tiny)
    t = costs.edge_truth(e, costs.node_truth(tiny)).select("u", "v", "edge_type", F.when(F.col("is_cut") == 1, -1.0).otherwise(1.0).alias("cost"))
    got = workflows.blockwise_segmentation(tiny, t, (2, 4, 4), (1, 2, 4), (1, 1, 1), stitching=stitching, solver="kl").collect()
    assert len(got) == 32 and min(r.label for r in got) == 1
    if stitching == "multicut":
        assert len({r.label for r in got}) == 2


def test_uncovered_edges_stay_cut(spark):
    e = spark.createDataFrame([(0, 1), (1, 2)], "u long, v long")
    cuts = spark.createDataFrame([(0, 1, 0), (0, 1, 1)], "u long, v long, is_cut int")
    assert pairs(blockwise.merge_cuts(e, cuts), "u", "v", "is_cut") == {(0, 1): 1, (1, 2): 1}


def test_volume_store(spark, tiny, tmp_path):
    s = volume.VolumeStore(spark, str(tmp_path / "store"))
    assert "seg" not in s and s.keys() == []
    s.write(tiny, "seg")
    assert "seg" in s and s.shape("seg") == (2, 4, 4) and s.dtype("raw", "seg") == "double"
    assert s.read((0, 1, 1), (1, 3, 4), "seg").count() == 6
    s.write_box(spark.createDataFrame([(1, 0, 0, 99)], "z int, y int, x int, seg long"), "seg", "seg")
    assert s.open("seg").where("seg = 99").count() == 1 and s.open("seg").count() == 32
    plan = s.read((1, 0, 0), (2, 4, 4), "seg")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(z" in plan


def test_stored_attributes(spark, tiny, tmp_path):
    s = volume.VolumeStore(spark, str(tmp_path / "store"))
    with pytest.raises(KeyError):
        s.set_offsets((1, 2, 3), (0, 0, 1), "seg")
    s.write(tiny, "seg")
    assert not s.has_offsets("seg") and s.offsets("seg") == ((0, 0, 0), (0, 0, 0)) and s.frame_shape("seg") == (2, 4, 4)
    s.set_offsets((1, 2, 3), (0, 0, 1), "seg")
    s.write(tiny, "seg")
    assert s.has_offsets("seg") and s.frame_shape("seg") == (3, 6, 8) and s.keys() == ["seg"]
    got = s.read_framed((2, 2, 3), (3, 4, 5), "seg")
    want = {(r.z + 1, r.y + 2, r.x + 3, r.seg) for r in tiny.where("z = 1 and y < 2 and x < 2").collect()}
    assert {(r.z, r.y, r.x, r.seg) for r in got.collect()} == want and len(want) == 4
    edges = rag.rag_edges(tiny)
    s.write_rag(edges, s._file("seg"))
    assert s.label_path() == s._file("seg") and s.read_column("rag", "u", "v").count() == edges.count()
    ragged = spark.createDataFrame([(1, [2, 3]), (2, []), (3, [7])], "node long, members array<long>")
    s.write(ragged, "ragged")
    assert {r.node: r.members for r in s.open("ragged").collect()} == {1: [2, 3], 2: [], 3: [7]}


def test_tables(spark):
    x = spark.createDataFrame([(0, 1, 1), (1, 1, 1), (2, 2, 3)], "i long, a int, b int")
    assert {tuple(r) for r in tables.unique_rows(x, ["a", "b"], "i").collect()} == {(1, 1, 0), (2, 3, 2)}
    y = spark.createDataFrame([(0, 2, 3), (1, 1, 1), (2, 9, 9)], "i long, a int, b int")
    assert {tuple(r) for r in tables.matching_rows(x, y, ["a", "b"], "i").collect()} == {(2, 0), (1, 1)}
    with pytest.raises(Exception, match="no entry"):
        tables.replaced(x, "a", spark.createDataFrame([(1, 5)], "k int, v int"), "k", "v").collect()


def test_inputs(tmp_path):
    got = read_inputs({"seg": "s", "data": ["a", "b"], "cache": str(tmp_path / "c"), "keys": {"data": ["x", "y"], "seg": "k"}})
    assert got.data_keys == ("x", "y") and got.seg_key == "k" and (tmp_path / "c").is_dir()
    with pytest.raises(ValueError):
        read_inputs({"data": []})
    with pytest.raises(ValueError):
        read_inputs({"seg": "s", "data": ["a"], "keys": {"data": ["x", "y"]}})
    assert select_features(Params(features=("raw", "nothing", "prob")), 2) == [("raw", 0, "xy,z"), ("prob", 1, "xy,z")]
    with pytest.raises(ValueError):
        select_features(Params(features=("affinitiesZ",)), 2)
