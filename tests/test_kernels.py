import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgraph.operators import kernels as K
from voxgraph.operators import tiles
from voxgraph.operators import learning
from voxgraph.streaming import slices


def test_distance_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(5):
        mask = rng.random((9, 13)) < 0.1
        mask[0, 0] = True
        at = np.argwhere(mask)
        want = np.array([[((at - [y, x]) ** 2).sum(axis=1).min() for x in range(13)] for y in range(9)])
        assert np.array_equal(K.distance_squared(mask), want)


def test_signed_distance():
    p = np.array([[0.0, 0.0, 0.9, 0.0]])
    assert K.signed_distance(p, 0.5).tolist() == [[2, 1, -0.9, 1]]
    assert K.signed_distance(p, 0.5, preserve_membrane=False).tolist() == [[2, 1, 0, 1]]


def test_filters():
    y, x = np.mgrid[:40, :40].astype(float)
    inner = (slice(15, 25), slice(15, 25))
    assert np.allclose(K.gaussian(np.full((20, 20), 3.0), 1.6), 3)
    assert np.allclose(K.laplacian(x * x + y * y, 1.6)[inner], 4, atol=0.1)
    big, small = K.hessian_eigenvalues(3 * x * x, 1.6)
    assert np.allclose(big[inner], 6, atol=0.15) and np.allclose(small[inner], 0, atol=0.1)
    assert len(K.filter_channels(np.zeros((8, 8)))) == 12


def test_watershed():
    h = np.array([[0, 1, 5, 1, 0]] * 3, float)
    s = np.zeros((3, 5), int)
    s[1, 0], s[1, 4] = 1, 2
    out = K.watershed(h, s)
    assert set(out[:, :2].ravel()) == {0} and set(out[:, 3:].ravel()) == {1}
    assert K.watershed(h, np.zeros((3, 5), int), first=4).tolist() == [[4] * 5] * 3
    one = np.zeros((3, 5), int)
    one[0, 0], one[1, 4] = 1, 2
    assert np.bincount(K.watershed(h, one, min_size=8).ravel()).tolist() == [15]


@pytest.fixture(scope="module")
def volume(spark):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(z, y, x, float(rng.random()), bool(x > 1)) for z in range(3) for y in range(12) for x in range(12)], "z int, y int, x int, prob double, mask boolean").cache()


def test_segmentation_never_shares_labels(volume):
    got = tiles.wsdt_segmentation(volume, threshold=0.8, sigma=1.0, min_size=4).groupBy("z").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi"), F.count("*").alias("n")).orderBy("z").collect()
    assert [r.n for r in got] == [144] * 3 and got[0].lo == 0
    assert all(b.lo == a.hi + 1 for a, b in zip(got[:-1], got[1:], strict=True))
    m = tiles.wsdt_segmentation(volume, threshold=0.8, sigma=1.0, min_size=4, mask="mask")
    assert m.where("x <= 1 and seg <> 0").count() == 0 and m.where("x > 1 and seg = 0").count() == 0
    got = m.where("seg > 0").groupBy("z").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).orderBy("z").collect()
    assert got[0].lo == 1 and all(b.lo == a.hi + 1 for a, b in zip(got[:-1], got[1:], strict=True))


def test_forest_round_trip(spark, tmp_path):
    rows = [(i, i + 1, "xy" if i % 2 else "z", float(i % 10), float(i % 3)) for i in range(200)]
    f = spark.createDataFrame(rows, "u long, v long, edge_type string, a double, b double")
    truth = f.select("u", "v", "edge_type", (F.col("a") > 4).cast("int").alias("is_cut"), F.lit(True).alias("is_labelled"))
    model = learning.EdgeClassifier.learn([(f, truth)], n_trees=5, max_depth=4)
    got = model.predict(f).join(truth, ["u", "v", "edge_type"])
    assert got.where((F.col("prob") > 0.5) != (F.col("is_cut") == 1)).count() == 0
    model.save(str(tmp_path))
    assert learning.EdgeClassifier.load(str(tmp_path), ["xy", "z"]).predict(f).count() == 200


def test_stream_of_slices(spark, tmp_path):
    v = spark.createDataFrame([(z, i % (5 if z != 2 else 1)) for z in range(4) for i in range(20)], "z int, seg long")
    for z in range(4):
        v.where(f"z = {z}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    counts = slices.segment_counts(slices.read_slices(spark, str(tmp_path / "in"), "z int, seg long"))
    q = slices.flag_defects(counts, 3).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.z, r.n_segs, r.is_defect) for r in spark.table("counts").collect()} == {(0, 5, False), (1, 5, False), (2, 1, True), (3, 5, False)}
