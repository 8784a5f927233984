"""Chunked volumes and ragged tables."""

import pytest
from pyspark.sql import functions as F

from voxgraph.sources import chunks
from voxgraph.sources.chunks import ChunkStore

ROWS = [(z, y, x, 100 * z + 10 * y + x) for z in range(4) for y in range(6) for x in range(8)]
SCHEMA = "z int, y int, x int, seg long"


@pytest.fixture
def store(spark, tmp_path):
    s = ChunkStore(spark, str(tmp_path / "volumes"))
    s.create("seg", (4, 6, 8), (2, 3, 4), seg="bigint")
    s.write(spark.createDataFrame(ROWS, SCHEMA), "seg")
    return s


def got(df):
    return sorted(map(tuple, df.select("z", "y", "x", "seg").collect()))


def folders(store, key, start, stop):
    """What a box's condition on chunks leaves to be opened."""
    rows = store.spark.read.parquet(f"{store.path}/{key}/data").where(store._within(start, stop, key))
    return {r.f.split("/data/")[1].rsplit("/", 1)[0] for r in rows.select(F.input_file_name().alias("f")).distinct().collect()}


def test_round_trip_and_attributes(spark, store):
    assert "seg" in store and "other" not in store and store.keys() == ["seg"]
    assert store.shape("seg") == (4, 6, 8) and store.chunks("seg") == (2, 3, 4) and store.dtype("seg", "seg") == "bigint"
    assert got(store.open("seg")) == ROWS and store.index("seg").count() == 8
    store.create("seg", (4, 6, 8), (2, 3, 4), seg="bigint")
    with pytest.raises(ValueError):
        store.create("seg", (4, 6, 8), (4, 4, 4), seg="bigint")
    with pytest.raises(KeyError):
        store.open("other")
    store.set_offsets((1, 0, 0), (0, 0, 2), "seg")
    assert store.frame_shape("seg") == (5, 6, 10)


def test_boxes_open_their_chunks_only(store):
    box = store.read((0, 3, 1), (2, 6, 3), "seg")
    assert got(box) == [r for r in ROWS if r[0] < 2 and r[1] >= 3 and 1 <= r[2] < 3]
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert all(f"({c}#" in plan.split("PartitionFilters")[1] for c in ("cz", "cy", "cx"))
    assert folders(store, "seg", (0, 3, 1), (2, 6, 3)) == {"v=0/cz=0/cy=1/cx=0"}


def test_boxes_are_written_alone(spark, store):
    new = spark.createDataFrame([(1, 2, 3, -1), (1, 3, 4, -2), (1, 3, 4, -2)], SCHEMA).distinct()
    store.write_box(new, "seg", "seg")
    want = sorted((z, y, x, {(1, 2, 3): -1, (1, 3, 4): -2}.get((z, y, x), s)) for z, y, x, s in ROWS)
    assert got(store.open("seg")) == want
    assert {(r.cz, r.cy, r.cx) for r in store.index("seg").where("v = 1").collect()} == {(0, 0, 0), (0, 1, 1)}
    store.vacuum("seg")
    assert got(store.open("seg")) == want
    store.write_box(new.limit(0), "seg", "seg")
    assert got(store.open("seg")) == want


def test_many_chunks_share_folders(spark, tmp_path, monkeypatch):
    """Boxes are read and written alone where chunks share folders; versions still count for each chunk."""
    monkeypatch.setattr(chunks, "FOLDERS", 3)
    s = ChunkStore(spark, str(tmp_path / "volumes"))
    s.create("seg", (4, 6, 8), (1, 2, 4), seg="bigint")
    s.create("seg", (4, 6, 8), (1, 2, 4), seg="bigint")
    s.write(spark.createDataFrame(ROWS, SCHEMA), "seg")
    assert got(s.open("seg")) == ROWS and s.index("seg").count() == 24 and s.open("seg").columns == ["z", "y", "x", "seg"]
    written = {r.f.split("/data/")[1].rsplit("/", 1)[0] for r in spark.read.parquet(f"{s.path}/seg/data").select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(written) <= 3
    new = spark.createDataFrame([(1, 2, 3, -1), (3, 5, 7, -2)], SCHEMA)
    s.write_box(new, "seg", "seg")
    want = sorted((z, y, x, {(1, 2, 3): -1, (3, 5, 7): -2}.get((z, y, x), v)) for z, y, x, v in ROWS)
    assert got(s.open("seg")) == want
    assert {(r.cz, r.cy, r.cx) for r in s.index("seg").where("v = 1").collect()} == {(1, 1, 0), (3, 2, 1)}
    box = s.read((3, 4, 1), (4, 6, 8), "seg")
    assert got(box) == [r for r in want if r[0] == 3 and r[1] >= 4 and r[2] >= 1]
    assert all(f"({c}#" in box._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1] for c in ("fz", "fy", "fx"))
    s.vacuum("seg")
    assert got(s.open("seg")) == want


def test_folders_are_few():
    assert chunks.shared((21600, 3, 3), 1024) == [256, 1, 1] and chunks.shared((2, 2, 2), 8) == [1, 1, 1] and chunks.shared((100,), 0) == [128]


def test_failed_writes_change_nothing(spark, store):
    bad = spark.createDataFrame([(0, 0, 0, 7)], SCHEMA).withColumn("seg", F.when(F.col("x") == 0, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("seg")))
    with pytest.raises(Exception, match="lost"):
        store.write(bad, "seg")
    assert got(store.open("seg")) == ROWS
    with pytest.raises(Exception, match="beyond the shape"):
        store.write(spark.createDataFrame([(9, 0, 0, 7)], SCHEMA), "seg")
    # Chunks of a version whose index was never finished are not seen, and the next write takes their place.
    spark.createDataFrame([(0, 0, 0, 5)], SCHEMA).selectExpr("*", "0 cz", "0 cy", "0 cx").write.mode("overwrite").partitionBy("cz", "cy", "cx").parquet(f"{store.path}/seg/data/v=1")
    assert got(store.open("seg")) == ROWS
    store.write_box(spark.createDataFrame([(3, 5, 7, 0)], SCHEMA), "seg", "seg")
    assert got(store.open("seg")) == sorted([r for r in ROWS if r[:3] != (3, 5, 7)] + [(3, 5, 7, 0)])


def test_ragged_rows(spark, tmp_path):
    """Rows of any length, some of them read and written alone; sub-arrays follow from functions on the rows."""
    s = ChunkStore(spark, str(tmp_path / "tables"), axes=("row",))
    s.create("nodes", (1000,), (100,), values="array<bigint>")
    rows = [(i, list(range(i % 7))) for i in range(1000)]
    s.write(spark.createDataFrame(rows, "row long, values array<long>"), "nodes")
    part = s.read((250,), (260,), "nodes")
    assert sorted((r.row, r["values"]) for r in part.collect()) == rows[250:260]
    assert folders(s, "nodes", (250,), (260,)) == {"v=0/crow=2"}
    s.write_box(spark.createDataFrame([(255, [9, 9]), (999, None)], "row long, values array<long>"), "values", "nodes")
    rows[255], rows[999] = (255, [9, 9]), (999, None)
    assert sorted((r.row, r["values"]) for r in s.open("nodes").collect()) == rows
    assert s.index("nodes").where("v = 1").count() == 2
