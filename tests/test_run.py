"""A whole run from its inputs and parameters."""

import pytest
from pyspark.sql import functions as F

from voxgraph import queries
from voxgraph.config import Params, read_inputs
from voxgraph.functions import metrics
from voxgraph.operators import learning, rag
from voxgraph.plans import workflows
from voxgraph.sources.volume import VolumeStore

SF = "/root/testdata/sf0.001"


def test_run_from_inputs(spark, tmp_path):
    v = queries.voxels(spark, SF).cache()
    for name in ("raw", "prob", "seg", "gt"):
        VolumeStore(spark, str(tmp_path / name)).write(v.select("z", "y", "x", name))
    source = {"data": [str(tmp_path / "raw"), str(tmp_path / "prob")], "seg": str(tmp_path / "seg"), "gt": str(tmp_path / "gt"), "cache": str(tmp_path / "cache")}
    params = Params(use_simple_features=True, n_trees=5, max_depth=4, block_shape=(2, 10, 10), block_overlap=(1, 2, 2), fusion_stop=3)
    made = workflows.segment(spark, read_inputs(source), params)
    assert made.count() == v.count() and made.columns == ["z", "y", "x", "label"]
    scores = metrics.scores(made.join(v.select("z", "y", "x", "gt"), ["z", "y", "x"]), "label").first()
    assert scores.adapted_rand < metrics.scores(v).first().adapted_rand  # nearer to the truth than the regions it began with
    # The classifier that the run left in its cache gives the same probabilities.
    again = read_inputs({**{k: source[k] for k in ("data", "seg")}, "rf": source["cache"]})
    voxels = workflows.read_volumes(spark, again)
    first = {tuple(r)[:3]: r.prob for r in workflows.edge_probabilities(spark, workflows.read_volumes(spark, read_inputs(source)), read_inputs(source), params).collect()}
    assert {tuple(r)[:3]: r.prob for r in workflows.edge_probabilities(spark, voxels, again, params).collect()} == first
    assert learning.EdgeClassifier.is_cached(spark, source["cache"], ["xy", "z"]) and not learning.EdgeClassifier.is_cached(spark, source["cache"], ["xy", "joined"])
    assert not learning.has_defect_forest(spark, source["cache"])
    nodes = spark.createDataFrame([(i, float(i % 5), i % 5 == 4) for i in range(60)], "node long, size double, is_defect boolean")
    model = learning.learn_defects(nodes.drop("is_defect"), nodes, n_trees=3)
    learning.save_defects(model, source["cache"])
    assert learning.has_defect_forest(spark, source["cache"])
    assert learning.probability(learning.load_defects(source["cache"]), nodes, ("node",)).where("prob > 0.5").count() == 12
    with pytest.raises(ValueError):
        workflows.edge_probabilities(spark, voxels, read_inputs({k: source[k] for k in ("data", "seg")}), params)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """A volume of six slices with a mask, and no segmentation of its own."""
    path = tmp_path_factory.mktemp("run")
    v = queries.voxels(spark, SF).where("z < 2").withColumn("inside", ~((F.col("x") > 20) & (F.col("y") < 6))).cache()
    for name in ("raw", "prob", "seg", "gt"):
        VolumeStore(spark, str(path / name)).write(v.select("z", "y", "x", name))
    VolumeStore(spark, str(path / "mask")).write(v.select("z", "y", "x", F.col("inside").cast("int").alias("mask")))
    return {"data": [str(path / "raw"), str(path / "prob")], "seg": str(path / "seg"), "gt": str(path / "gt")}, str(path), v


PARAMS = Params(use_simple_features=True, n_trees=5, max_depth=4, block_shape=(1, 12, 12), block_overlap=(1, 2, 2), fusion_stop=2, fusion_stop_global=2)


def result(df):
    return sorted(map(tuple, df.select("z", "y", "x", "label").collect()))


def test_runs_are_repeatable(spark, inputs):
    source, _, _ = inputs
    first = result(workflows.segment(spark, read_inputs(source), PARAMS))
    spark.conf.set("spark.sql.shuffle.partitions", "7")  # other tasks, other order of rows
    try:
        assert result(workflows.segment(spark, read_inputs(source), PARAMS)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert result(workflows.segment(spark, read_inputs(source), PARAMS)) == first


def test_mask_and_watershed(spark, inputs):
    """Labels are 0 outside the mask and nowhere else, with a segmentation that the run makes; edges and features end at the mask."""
    source, path, v = inputs
    own = {**source, "seg": f"{path}/made", "mask": f"{path}/mask"}
    params = PARAMS.with_values(wsdt_threshold=0.9, wsdt_sigma_seeds=1.0, wsdt_min_segment=5)
    made = workflows.segment(spark, read_inputs(own), params, stitching=None)
    outside = {tuple(r) for r in v.where("not inside").select("z", "y", "x").collect()}
    got = result(made)
    assert len(got) == v.count() and {r[:3] for r in got if r[3] == 0} == outside
    seg = VolumeStore(spark, f"{path}/made").open()
    assert seg.where("seg = 0").count() == len(outside)
    other = {**own, "seg": f"{path}/made2"}
    workflows.oversegment(spark, read_inputs(other), params.with_values(wsdt_min_segment=60))
    assert VolumeStore(spark, f"{path}/made2").open().select("seg").distinct().count() < seg.select("seg").distinct().count()
    masked = workflows.read_volumes(spark, read_inputs({**source, "mask": f"{path}/mask"}))
    whole = workflows.read_volumes(spark, read_inputs(source))
    lengths = [rag.rag_edges(workflows.inside(x)).agg(F.sum("length")).first()[0] for x in (masked, whole)]
    assert lengths[0] < lengths[1]


def test_parameters_reach_the_solvers(spark, inputs):
    params = PARAMS.with_values(fusion_sigma=3.0, fusion_seed_fraction=0.2, fusion_seed_fraction_global=0.3, fusion_iterations=7, fusion_stop=4, fusion_stop_global=5, global_time_limit=9.0, visit_nth=2)
    sub, whole = workflows.limits_of(params)
    assert (sub.sigma, sub.seed_fraction, sub.iterations, sub.stop, sub.seconds, sub.visit_nth) == (3.0, 0.2, 7, 4, 9.0, 2)
    assert (whole.sigma, whole.seed_fraction, whole.iterations, whole.stop) == (3.0, 0.3, 7, 5)
    source, path, v = inputs
    moved = PARAMS.with_values(offset_front=(1, 2, 3), offset_back=(0, 1, 1), fusion_parallel=2, ignore_seg_label=3)
    made = workflows.segment(spark, read_inputs(source), moved, stitching=None).cache()
    assert made.agg(F.min("z"), F.min("y"), F.min("x")).first() == (1, 2, 3)
    assert made.where("label = 0").count() == v.where("seg = 3").count() > 0
    workflows.store_result(made, f"{path}/out", moved)
    assert VolumeStore(spark, f"{path}/out").frame_shape() == (3, 28, 29)
