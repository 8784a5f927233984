"""The problem over defective slices: graph, features, truth and forest of skip edges, and a run in defect mode."""

import pytest
from pyspark.sql import functions as F

from voxgraph import queries
from voxgraph.config import Params, read_inputs
from voxgraph.operators import costs, defects, rag
from voxgraph.plans import workflows
from voxgraph.sources.volume import VolumeStore

SF = "/root/testdata/sf0.01"
PARAMS = Params(features=("prob", "reg"), use_simple_features=True, n_trees=8, max_depth=5, block_shape=(8, 12, 12), block_overlap=(1, 2, 2), fusion_stop=2, fusion_stop_global=2, have_defects=True)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Eight slices, of which 3 and 4 are one region each."""
    path = tmp_path_factory.mktemp("bridged")
    v = queries.voxels(spark, SF).where("z < 8").withColumn("seg", F.when(F.col("z").isin(3, 4), F.col("z") * 25).otherwise(F.col("seg"))).cache()
    for name in ("raw", "prob", "seg", "gt"):
        VolumeStore(spark, str(path / name)).write(v.select("z", "y", "x", name))
    source = {"data": [str(path / "raw"), str(path / "prob")], "seg": str(path / "seg"), "gt": str(path / "gt"), "cache": str(path / "cache")}
    return source, v


def plain_bridged(v, bad, bad_nodes=()):
    """The modified adjacency of a small volume, voxel by voxel."""
    at = {(r.z, r.y, r.x): r.seg for r in v.collect()}
    nodes = {s for (z, _, _), s in at.items() if z in bad} | set(bad_nodes)
    out = {}
    for (z, y, x), s in at.items():
        for kind, o in (("xy", (z, y, x + 1)), ("xy", (z, y + 1, x)), ("z", (z + 1, y, x))):
            if o in at and at[o] != s:
                mixed = (s in nodes) != (at[o] in nodes)
                if not (mixed and kind == "z"):
                    key = (*sorted((s, at[o])), kind, mixed and kind == "xy", None, None)
                    out[key] = out.get(key, 0) + 1
        hi = z + 1
        while hi in bad:
            hi += 1
        if z not in bad and hi > z + 1 and (hi, y, x) in at:
            key = (*sorted((s, at[hi, y, x])), "skip", False, z, hi - z)
            out[key] = out.get(key, 0) + 1
    return {(*k, n) for k, n in out.items()}


def graph(made):
    return {(r.u, r.v, r.edge_type, r.is_ignored, r.skip_start, r.skip_range, r.length) for r in made.collect()}


@pytest.mark.parametrize("bad, nodes", [((3, 4), (26, 26, 180)), ((0, 2, 5, 7), ()), ((), (26,)), (tuple(range(8)), ())])
def test_graph_equals_plain_loops(spark, run, bad, nodes):
    """Runs inside, at both ends, none, and all slices."""
    v = run[1]
    slices = spark.createDataFrame([(z,) for z in bad + bad[:1]], "z int")
    some = spark.createDataFrame([(n,) for n in nodes], "node long") if nodes else None
    assert graph(defects.bridged(v, rag.rag_edges(v), slices, some)) == plain_bridged(v, set(bad), nodes)


def test_weights_and_ignored_edges(spark):
    edges = spark.createDataFrame([(0, 1, "xy", 4, False), (1, 2, "z", 5, False), (2, 3, "skip", 10, False), (3, 4, "xy", 2, True)], "u long, v long, edge_type string, length long, is_ignored boolean")
    p = spark.createDataFrame([(0, 1, "xy", 0.9), (1, 2, "z", 0.2), (2, 3, "skip", 0.2), (3, 4, "xy", 0.01)], "u long, v long, edge_type string, prob double")
    made = {r.u: r.cost for r in costs.multicut_problem(edges, p, scheme="z").collect()}
    assert made[2] == pytest.approx(2 * made[1]) and made[3] == pytest.approx(2 * made[0]) and made[0] < 0 < made[1]


def test_skip_edges_have_features_and_a_forest_of_their_own(spark, run):
    source, v = run
    inputs = read_inputs(source)
    every = workflows.read_volumes(spark, inputs)
    for params in (PARAMS, PARAMS.with_values(use_simple_features=False, features=("prob",))):
        problem = workflows.problem_of(every, params)
        assert problem.kinds == ("xy", "z", "skip") and sorted(r.z for r in problem.slices.collect()) == [3, 4]
        tables = workflows.features_of(every, params, 2, problem)
        skips = problem.edges.where("edge_type = 'skip'")
        made = tables["skip"]
        assert {(r.u, r.v) for r in made.collect()} == {(r.u, r.v) for r in skips.collect()} and made.count() == skips.count()
        assert [r.skip_range for r in made.select("skip_range").distinct().collect()] == [3]
        assert len(made.columns) == len(tables["z"].columns) + 1
    # Quantiles by ranks give the same tables; the ignored region has no edge in them.
    some = PARAMS.with_values(features=("prob",), ignore_seg_label=60)
    of_60 = workflows.problem_of(every, some)
    plain, ranked = (workflows.features_of(every, some.with_values(ranked_quantiles=r), 2, of_60) for r in (False, True))
    for kind, table in plain.items():
        want = {(r.u, r.v): r[3:] for r in table.collect()}
        got = {(r.u, r.v): r[3:] for r in ranked[kind].select(table.columns).collect()}
        assert set(got) == set(want) and 60 not in {n for e in want for n in e} and len(want) == of_60.edges.where(F.col("edge_type") == kind).count()
        assert all(x == pytest.approx(want[e], abs=1e-9) for e, x in got.items())
    joint = PARAMS.with_values(separate_edge_classification=False)
    problem = workflows.problem_of(every, joint)
    p = {(r.u, r.v, r.edge_type): r.prob for r in workflows.edge_probabilities(spark, every, inputs, joint, problem).collect()}
    assert len(p) == problem.edges.count() and all(0 <= x <= 1 for x in p.values())
    again = read_inputs({**{k: source[k] for k in ("data", "seg")}, "rf": source["cache"]})
    assert {(r.u, r.v, r.edge_type): r.prob for r in workflows.edge_probabilities(spark, every, again, joint, problem).collect()} == p


def test_run_in_defect_mode(spark, run):
    """Slices beside the gap share objects across it, defective slices show those of their neighbours; without defects the mode changes nothing."""
    source, v = run
    made = {(r.z, r.y, r.x): r.label for r in workflows.segment(spark, read_inputs(source), PARAMS, stitching=None).collect()}
    assert len(made) == v.count()
    for (z, y, x), label in made.items():
        if z in (3, 4):
            assert label == made[2 if z == 3 else 5, y, x]
    below, above = ({x for (z, *_), x in made.items() if z == s} for s in (2, 5))
    assert below & above
    sound = v.where("z in (0, 1)")
    assert workflows.problem_of(sound, PARAMS).slices is None and workflows.problem_of(sound, PARAMS).kinds == ("xy", "z")
