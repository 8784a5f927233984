"""Problems as tables: parts, contraction in rounds, bounds, proposals side by side."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgraph.operators import contraction as C
from voxgraph.operators import graph
from voxgraph.operators import solvers as S
from voxgraph.plans.lineage import cut, release


def edges_of(shape, seed, shift=0.0):
    n = np.arange(np.prod(shape)).reshape(shape)
    ends = [(np.moveaxis(n, a, 0)[:-1].ravel(), np.moveaxis(n, a, 0)[1:].ravel()) for a in range(len(shape))]
    uv = np.stack([np.concatenate([e[i] for e in ends]) for i in range(2)], 1)
    return S.Problem(n.size, uv, np.random.default_rng(seed).normal(size=len(uv)) + shift)


def table(spark, p, offset=100):
    return spark.createDataFrame([(int(u) + offset, int(v) + offset, float(c)) for (u, v), c in zip(p.uv, p.cost)], "u long, v long, cost double").repartition(4)


def labels(df, n, offset=100):
    got = {r.node - offset: r.component - offset for r in df.collect()}
    assert sorted(got) == list(range(n))
    assert all(got[c] == c and c <= i for i, c in got.items())  # named by the least
    return np.array([got[i] for i in range(n)])


@pytest.mark.parametrize(("shape", "shift"), [((16, 16), 0.0)])
def test_contraction_is_near_to_greedy(spark, shape, shift):
    p = edges_of(shape, 1, shift)
    made = p.energy(labels(C.solve_whole(table(spark, p), "greedy", task_edges=40), p.n))
    alone = p.energy(S.greedy(p, S.Limits()))
    assert made <= alone + 0.02 * abs(alone)


def test_parts_lose_nothing(spark):
    p = edges_of((12, 12), 2)
    whole = S.prove(p, S.Limits())
    assert whole.proven
    assert p.energy(labels(C.solve_whole(table(spark, p), "ilp"), p.n)) == pytest.approx(whole.energy)
    r = C.bounds(table(spark, p)).first()
    assert r.proven and r.energy == pytest.approx(whole.energy) and r.bound == pytest.approx(whole.energy, abs=1e-4) and r.parts > 1
    # Parts that are too large for a task: an honest gap.
    r = C.bounds(table(spark, p), task_edges=5).first()
    assert not r.proven and r.bound <= whole.energy <= r.energy and r.gap == pytest.approx(r.energy - r.bound)


def test_no_task_gets_the_whole_problem(spark):
    """Groups of the last step hold no more edges than a task takes, though all nodes attract each other."""
    p = edges_of((7, 7), 3, shift=4.0)
    fit, merges = C._fitting(C.simple(table(spark, p)), 30)
    assert fit.groupBy("part").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0] <= 30 and merges.count() > 10
    assert set(labels(C.solve_whole(table(spark, p), "greedy", task_edges=30), p.n)) == {0}


def test_equal_costs_in_a_chain(spark):
    chain = spark.range(100).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"), F.lit(1.0).alias("cost"))
    assert C.mutual(chain).count() > 15  # many of them pair up in one round
    assert {r.component for r in C.solve_whole(chain, "greedy", task_edges=10).collect()} == {0}


def test_whole_parts_need_no_task(spark):
    """Parts that nothing within repels are solved and proven beside the tasks, whatever their size; others still go to tasks."""
    chain = spark.range(100).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"), F.lit(1.0).alias("cost"))
    other = spark.createDataFrame([(50, 500, -3.0), (500, 501, 2.0), (500, 502, 1.0), (501, 502, -5.0)], "u long, v long, cost double")
    e = C.simple(chain.unionByName(other))
    fit, merges = C._fitting(e, 10)
    assert {(r.part, r.u, r.v) for r in fit.collect()} == {(500, 500, 501), (500, 500, 502), (500, 501, 502)}
    assert {tuple(r) for r in merges.collect()} == {(0, i) for i in range(101)}
    assert tuple(C.bounds(e, task_edges=10).first()) == (2, -7.0, -7.0, 0.0, True)
    got = {r.node: r.component for r in C.solve_whole(e, "ilp", task_edges=10).collect()}
    assert got == {i: 0 for i in range(101)} | {500: 500, 501: 500, 502: 502}


def test_odd_edges(spark):
    made = C.solve_whole(spark.createDataFrame([(1, 2, -1.0), (2, 1, 3.0), (4, 4, 9.0), (5, 6, -2.0)], "u long, v long, cost double"), "kl")
    assert {tuple(r) for r in made.collect()} == {(1, 1), (2, 1), (4, 4), (5, 5), (6, 6)}
    none = spark.createDataFrame([], "u long, v long, cost double")
    assert C.solve_whole(none).count() == 0 and C.parallel_fusion(none).count() == 0
    assert tuple(C.bounds(none).first()) == (0, 0.0, 0.0, 0.0, True)


def test_parallel_proposals(spark):
    """Exactly fused, proposals fused at once are never above the same ones fused one after another, nor any above Kernighan-Lin."""
    p = edges_of((12, 12), 5, 0.1)
    limits = S.Limits(iterations=2, stop=2, seed_fraction=0.1)
    t = table(spark, p)
    energy = {k: p.energy(labels(C.parallel_fusion(t, "ilp", limits, *k), p.n)) for k in ((2, 0), (2, 1))}
    assert energy[2, 0] <= energy[2, 1] + 1e-9
    assert max(energy.values()) <= p.energy(labels(C.solve_whole(t, "kl"), p.n)) + 1e-9
    again = C.parallel_fusion(t.repartition(7), "ilp", limits, 2, 0)
    assert p.energy(labels(again, p.n)) == pytest.approx(energy[2, 0])
    assert graph.energy(t, again).first().energy == pytest.approx(energy[2, 0])


@pytest.mark.parametrize("few", [0, 50_000])
def test_components_of_few_edges_join_without_shuffles(spark, monkeypatch, few):
    """Both ways give the same components; a round of few edges leaves few partitions."""
    monkeypatch.setattr(graph, "FEW", few)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    pairs = [(i, i + 1) for i in range(0, 300) if i % 50] + [(1000, j) for j in range(1001, 1100)] + [(2000, 2000), (5, 1005), (None, 7)]
    steps = []
    done = graph.connected_components(spark.createDataFrame(pairs, "u long, v long"), write=lambda df: steps.append(df) or cut(df))
    got = {r.node: r.component for r in done.collect()}
    want = {i: max(1, i // 50 * 50 + 1) if i % 50 else i - 49 for i in range(1, 301)} | {j: 1 for j in range(1000, 1100)} | {2000: 2000}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in steps]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
    joined = [x for x in plans if "Join" in x]
    assert len(joined) > 2 and all("SortMergeJoin" not in x for x in joined) == bool(few)
    assert not few or all(df.rdd.getNumPartitions() == 1 for df in steps[1:])


def test_release_deletes_shuffle_files_of_tables_that_are_gone(spark):
    def files():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert df.count() == 7
    before = files()
    del df
    release(spark)
    until = time.time() + 20
    while files() >= before and time.time() < until:
        time.sleep(0.2)
    assert files() < before
