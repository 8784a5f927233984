"""A slice is dealt by bands of its rows."""

import numpy as np
import pytest

from voxgraph.operators import labels, rag


@pytest.fixture(scope="module")
def slice_(spark):
    """One slice with missing voxels."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 4, (37, 11))
    there = rng.random(a.shape) < 0.9
    return spark.createDataFrame([(2, int(y), int(x), int(a[y, x])) for y, x in zip(*np.nonzero(there))], "z int, y int, x int, seg long").cache(), {(y, x): a[y, x] for y, x in zip(*np.nonzero(there))}


@pytest.mark.parametrize("band", [1, 5, 37, 64])
def test_pairs_of_bands(slice_, band):
    v, of = slice_
    got = sorted((r.y, r.x, r.seg, r.n_seg, r.dy, r.dx) for r in labels.neighbours_in_slice(v, "seg", band=band).collect())
    assert got == sorted((y, x, s, of[y + dy, x + dx], dy, dx) for (y, x), s in of.items() for dy, dx in ((0, 1), (1, 0)) if (y + dy, x + dx) in of)


def test_one_slice_is_many_tasks(spark, slice_):
    """With one slice only no task of the exchange holds more than a few bands of it, and there is one exchange for both windows."""
    v, _ = slice_
    placed = labels.neighbours_in_slice(v, "seg", band=2)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dealt = placed.where("dx = 1").rdd.glom().map(len).collect()
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(n > 0 for n in dealt) > 2 and max(dealt) < 0.6 * sum(dealt)
    assert plan.count("Exchange hashpartitioning(z") - plan.count("ReusedExchange") == 1
    assert rag.rag_edges(v).count() == 6
