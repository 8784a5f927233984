"""Many small problems in a task, and joins of tables that grow with the volume."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxgraph.operators import blocking, blockwise, solvers


def edges(n_groups=60, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n_groups):
        side = 3 + g % 3
        n = np.arange(side * side).reshape(side, side) + 10 * g  # nodes are in several groups
        uv = np.concatenate([np.stack([n[:, :-1].ravel(), n[:, 1:].ravel()], 1), np.stack([n[:-1].ravel(), n[1:].ravel()], 1)])
        cost = rng.normal(size=len(uv)) + (g % 4 - 1)
        cost[0] = 0.0
        rows += [(g % 7, g, int(u), int(v), float(c)) for (u, v), c in zip(uv, cost, strict=True)]
    return rows


@pytest.mark.parametrize("batch", [5, 10_000])
def test_groups_in_batches_equal_one_by_one(spark, batch):
    """Groups that go on in the next batch, that need a solver and that do not."""
    rows = edges()
    want, solved = {}, 0
    for g in {r[1] for r in rows}:
        u, v, c = (np.array(x) for x in list(zip(*[r for r in rows if r[1] == g], strict=True))[2:])
        nodes, label, _ = solvers.solve_edges(u, v, c, "kl")
        cut = label[np.searchsorted(nodes, u)] != label[np.searchsorted(nodes, v)]
        solved += bool(((c < 0) & ~cut).any())
        want |= {(g % 7, g, a, b): int(x) for a, b, x in zip(u.tolist(), v.tolist(), cut, strict=True)}
    assert 5 < solved < 55
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    df = spark.createDataFrame(rows, "a int, b int, u long, v long, cost double").repartition(6)
    got = {tuple(r)[:4]: r.is_cut for r in blockwise.solve_groups(df, ["a", "b"], "kl").collect()}
    spark.conf.set(key, before)
    assert got == want


def test_groups_that_nothing_within_repels_need_no_solver(monkeypatch):
    def none(*_):
        raise AssertionError("a solver was asked")

    monkeypatch.setattr(blockwise, "solve_edges", none)
    rows = pd.DataFrame([(0, 1, 2, 3.0), (0, 2, 3, -1.0), (0, 3, 4, 2.0), (1, 1, 2, -3.0), (1, 2, 3, 0.0)], columns=["k", "u", "v", "cost"])
    assert blockwise._cuts(rows, ["k"], "kl", solvers.Limits()).is_cut.tolist() == [0, 1, 0, 1, 1]


def test_tables_of_blocks_are_not_sent_whole(spark):
    """Sides of joins that grow with the volume are merged, however small their files are."""
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, -1.0)], "u long, v long, cost double")
    nodes = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "block_id int, node long")
    boxes = blocking.blocks(spark, (4, 4, 4), (2, 4, 4), (1, 0, 0))
    found = blocking.edges_between_blocks(e, nodes, blocking.block_graph(boxes))
    assert [tuple(r) for r in found.collect()] == [(0, 1, 2, 3, -1.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    cuts = e.select("u", "v", F.lit(0).alias("is_cut"))
    plan = blockwise.merge_cuts(e, cuts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
