"""Volumes as Parquet tables: one row for each voxel, partitioned by slice where written here."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
Box = tuple[Sequence[int], Sequence[int]]


def in_box(start: Sequence[int], stop: Sequence[int]) -> Column:
    """Half-open box; on a table partitioned by z the first test prunes files."""
    cond = F.lit(True)
    for axis, a, b in zip(AXES, start, stop, strict=True):
        cond = cond & (F.col(axis) >= a) & (F.col(axis) < b)
    return cond


class VolumeStore:
    """A folder of volumes by key.  Missing volumes are created by the first write; existence means done."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, key: str) -> str:
        return f"{self.path}/{key}"

    def _hadoop(self, key: str = ""):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self._file(key) if key else self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def __contains__(self, key: str) -> bool:
        fs, p = self._hadoop(key)
        return fs.exists(p)

    def keys(self) -> list[str]:
        fs, p = self._hadoop()
        names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else ()
        return sorted(n for n in names if not n.startswith("_"))

    def attributes(self, key: str = "data") -> dict[str, str]:
        """What was stored about a table beside its rows; empty if nothing was."""
        name = f"_attributes/{key}"
        return {r["name"]: r["value"] for r in self.open(name).collect()} if name in self else {}

    def set_attributes(self, key: str = "data", **values: str) -> None:
        """Named values of a table, added to those that it has; they outlive rewrites of its rows."""
        rows = sorted((self.attributes(key) | values).items())
        self.spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(self._file(f"_attributes/{key}"))

    def set_offsets(self, front: Sequence[int], back: Sequence[int], key: str = "data") -> None:
        """The margins of a volume that is part of a larger frame, before and behind it on each axis."""
        if key not in self:
            raise KeyError(key)
        self.set_attributes(key, offset_front=json.dumps([int(o) for o in front]), offset_back=json.dumps([int(o) for o in back]))

    def has_offsets(self, key: str = "data") -> bool:
        return "offset_front" in self.attributes(key)

    def offsets(self, key: str = "data") -> Box:
        """(front, back); zeros where none were set."""
        own = self.attributes(key)
        return tuple(tuple(json.loads(own.get(name, "[0, 0, 0]"))) for name in ("offset_front", "offset_back"))

    def read_framed(self, start: Sequence[int], stop: Sequence[int], key: str = "data") -> DataFrame:
        """A box in coordinates of the frame; the box is moved to the volume, so that slices are still pruned."""
        front, _ = self.offsets(key)
        inner = self.read([a - o for a, o in zip(start, front, strict=True)], [b - o for b, o in zip(stop, front, strict=True)], key)
        return shift(inner, front)

    def frame_shape(self, key: str = "data") -> tuple[int, ...]:
        front, back = self.offsets(key)
        return tuple(a + n + b for a, n, b in zip(front, self.shape(key), back, strict=True))

    def write_rag(self, edges: DataFrame, label_path: str, key: str = "rag") -> None:
        """An adjacency graph, which remembers the labels that it is of."""
        self.write(edges, key)
        self.set_attributes(key, label_path=label_path)

    def label_path(self, key: str = "rag") -> str:
        return self.attributes(key)["label_path"]

    def open(self, key: str = "data") -> DataFrame:
        return self.spark.read.parquet(self._file(key))

    def read(self, start: Sequence[int], stop: Sequence[int], key: str = "data") -> DataFrame:
        return self.open(key).where(in_box(start, stop))

    def read_column(self, key: str, *columns: str) -> DataFrame:
        return self.open(key).select(*columns)

    def write(self, df: DataFrame, key: str = "data") -> None:
        """A whole volume, or all rows of the slices that ``df`` has: other slices stay."""
        if "z" in df.columns:
            df.repartition("z").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("z").parquet(self._file(key))
        else:
            df.write.mode("overwrite").parquet(self._file(key))

    def write_box(self, new: DataFrame, value: str, key: str = "data") -> None:
        """Values of the voxels in ``new`` replace those that are stored; only their slices are written again."""
        zs = new.select("z").distinct()
        old = self.open(key).join(zs, "z", "left_semi")
        self.write(overlay(old, new, value), f"{key}.next")  # a table cannot be read and overwritten at once
        self.write(self.open(f"{key}.next"), key)
        fs, p = self._hadoop(f"{key}.next")
        fs.delete(p, True)

    def shape(self, key: str = "data") -> tuple[int, ...]:
        row = self.open(key).agg(*(F.max(a) for a in AXES)).first()
        return tuple(0 if v is None else v + 1 for v in row)

    def dtype(self, value: str, key: str = "data") -> str:
        return dict(self.open(key).dtypes)[value]


def overlay(old: DataFrame, new: DataFrame, value: str) -> DataFrame:
    """``old`` with the values that ``new`` has for its voxels; voxels that only ``new`` has are ignored."""
    other = new.select(*AXES, F.col(value).alias("_new"), F.lit(True).alias("_is"))
    joined = old.join(other, list(AXES), "left")
    return joined.withColumn(value, F.when(F.col("_is"), F.col("_new")).otherwise(F.col(value))).select(*old.columns)


def shift(voxels: DataFrame, offset: Sequence[int]) -> DataFrame:
    """A volume moved into a larger frame."""
    return voxels.withColumns({a: (F.col(a) + int(o)).cast(dict(voxels.dtypes)[a]) for a, o in zip(AXES, offset, strict=True)})


def derived_volume(orders: DataFrame) -> DataFrame:
    """A dense volume of 25 x 25 slices from a table of orders with contiguous keys.

    z, y, x, raw, prob (raw scaled to 0..1), seg (25 regions a slice), gt (9 truth
    regions over all slices) and mask.  Only complete slices are kept.
    """
    facts = orders.agg(F.min("o_orderkey").alias("k0"), F.count("*").alias("n"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    v = orders.crossJoin(F.broadcast(facts)).withColumn("i", F.col("o_orderkey") - F.col("k0")).where("i < 625 * (n div 625)")
    v = v.select(
        F.expr("cast(i div 625 as int)").alias("z"),
        F.expr("cast((i % 625) div 25 as int)").alias("y"),
        F.expr("cast(i % 25 as int)").alias("x"),
        F.col("o_totalprice").alias("raw"),
        ((F.col("o_totalprice") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("prob"),
        F.expr("o_custkey % 2").alias("odd"),
        (F.col("o_orderstatus") != "F").alias("mask"),
    )
    return v.select(
        "z", "y", "x", "raw", "prob",
        F.expr("cast(25L * z + 5 * (y div 5) + least(4, (x + odd) div 5) as bigint)").alias("seg"),
        F.expr("cast(1 + 3 * least(2, y div 10) + least(2, x div 10) as bigint)").alias("gt"),
        "mask",
    )
