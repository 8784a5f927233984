"""Quantiles by ranks against numpy, and without a group in memory."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgraph.functions.quantiles import ranked_quantiles
from voxgraph.operators import features

QS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


def test_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), "ab"[i % 2], float(x), float(round(x))) for i, (k, x) in enumerate(zip(rng.integers(0, 5, 3000) // 4, rng.normal(size=3000)))]
    rows += [(7, "a", None, 1.0), (8, "b", None, None), (9, "a", 2.5, 3.0)]
    df = spark.createDataFrame(rows, "k int, name string, x double, y double").repartition(5)
    got = {(r.k, r.name): r for r in ranked_quantiles(df, ["k", "name"], ["x", "y"], QS).collect()}
    for key in {r[:2] for r in rows} - {(8, "b")}:
        for i, c in ((2, "x"), (3, "y")):
            own = [r[i] for r in rows if r[:2] == key and r[i] is not None]
            assert (got[key][c] is None) if not own else got[key][c] == pytest.approx(list(np.quantile(own, QS)))
    assert (8, "b") not in got
    assert ranked_quantiles(df.limit(0), ["k"], ["x"], QS).count() == 0


def test_a_large_border_is_many_tasks(spark):
    """One border of two million values: no percentile, and no task ranks more than a share of them."""
    values = spark.range(2_000_000).select(F.lit(1).cast("long").alias("u"), F.lit(2).cast("long").alias("v"), F.lit("xy").alias("edge_type"), (F.xxhash64("id") / F.lit(2.0**63)).alias("value"))
    made = features.edge_statistics(values, ranked=True)
    assert "percentile" not in made._jdf.queryExecution().executedPlan().toString()
    r, want = made.first(), values.agg(F.percentile("value", F.array(*map(F.lit, features.EDGE_QUANTILES))).alias("q"), F.min("value").alias("lo")).first()
    assert [r.q10, r.q25, r.q50, r.q75, r.q90] == pytest.approx(list(want.q)) and r.min == want.lo
    counted = values.groupBy("u", "v", "edge_type", "value").count().repartitionByRange(8, "u", "v", "edge_type", "value")
    assert max(counted.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 600_000
