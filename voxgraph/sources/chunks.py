"""Tables in chunks along their axes: boxes read and written alone, changes that are seen all at once.

A table has one row for each place on its axes (z, y, x of a volume; the row of a
ragged table, whose values are arrays) and is stored in folders by version and
chunk, ``data/v=3/cz=0/cy=1/cx=2``.  Where chunks are very many, neighbouring ones
share a folder, ``data/v=3/fz=0/fy=0/fx=0``, in whose file they stand in order with
their ids as columns.  An index says which version of each chunk counts.  A write puts the chunks that it touches into a new version and then a
new index beside the old one; the index is complete, and seen, from the moment
its last file is there.  A write that fails leaves the table as it was, and the
next one takes its place.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.sources.volume import AXES, VolumeStore

#: Folders of a version at most: beyond that, chunks share them.
FOLDERS = 1024


def shared(counts: Sequence[int], most: int) -> list[int]:
    """How many chunks along each axis share a folder, so that there are no more than ``most`` of them: twice as many wherever most are left."""
    out = [1] * len(counts)
    while prod(left := [-(-n // g) for n, g in zip(counts, out, strict=True)]) > max(1, most):
        out[left.index(max(left))] *= 2
    return out


class ChunkStore(VolumeStore):
    """A folder of chunked tables by key.  Existence means that a first write is complete; shape, chunks and types are attributes, so that nothing is scanned for them."""

    def __init__(self, spark: SparkSession, path: str, axes: Sequence[str] = AXES):
        super().__init__(spark, path)
        self.axes = tuple(axes)
        self.ids = tuple(f"c{a}" for a in axes)
        self.shared_ids = tuple(f"f{a}" for a in axes)

    # --- what is stored about a table ---

    def create(self, key: str, shape: Sequence[int], chunks: Sequence[int], **types: str) -> None:
        """A table without rows; writes must lie within its shape.  A second call with the same values changes nothing, with others it is an error."""
        if not len(shape) == len(chunks) == len(self.axes) or min(*chunks, 1) < 1:
            raise ValueError("shape and chunks need a positive number for each axis")
        made = {"shape": json.dumps([int(n) for n in shape]), "chunks": json.dumps([int(n) for n in chunks]), "types": json.dumps(types)}
        old = {k: v for k, v in self.attributes(key).items() if k in made}
        if old and old != made:
            raise ValueError(f"{key} is there with another shape, other chunks or types")
        if not old:
            self.set_attributes(key, **made, shared=json.dumps(shared([-(-int(n) // int(c)) for n, c in zip(shape, chunks, strict=True)], FOLDERS)))

    def _own(self, key: str, name: str):
        return json.loads(self.attributes(key)[name])

    def shape(self, key: str = "data") -> tuple[int, ...]:
        return tuple(self._own(key, "shape"))

    def chunks(self, key: str = "data") -> tuple[int, ...]:
        return tuple(self._own(key, "chunks"))

    def dtype(self, value: str, key: str = "data") -> str:
        return self._own(key, "types")[value]

    def _folders(self, key: str) -> dict[str, tuple[str, int]]:
        """Columns of folders, with the ids that they follow from and how many of those share one; empty if each chunk has its own."""
        many = json.loads(self.attributes(key).get("shared", "[]"))
        return {f: (c, n) for f, c, n in zip(self.shared_ids, self.ids, many)} if max(many, default=1) > 1 else {}

    # --- versions ---

    def _versions(self, key: str) -> list[int]:
        """Numbers of complete indexes."""
        fs, p = self._hadoop(f"{key}/index")
        if not fs.exists(p):
            return []
        done = (s.getPath() for s in fs.listStatus(p) if s.isDirectory())
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(d.getName()) for d in done if d.getName().isdigit() and fs.exists(path(d, "_SUCCESS")))

    def __contains__(self, key: str) -> bool:
        return super().__contains__(key) if key.startswith("_attributes/") else bool(self._versions(key))

    def keys(self) -> list[str]:
        return [k for k in super().keys() if k in self]

    def index(self, key: str = "data") -> DataFrame:
        """(chunk ids, v): which version of each chunk counts."""
        versions = self._versions(key)
        if not versions:
            raise KeyError(key)
        return self.spark.read.parquet(self._file(f"{key}/index/{versions[-1]}"))

    def _within(self, start: Sequence[int], stop: Sequence[int], key: str) -> Column:
        """Chunks that a half-open box touches: conditions on folders, which are never opened beyond it."""
        tests = [(F.col(c) >= int(a) // n) & (F.col(c) <= (int(b) - 1) // n) for c, a, b, n in zip(self.ids, start, stop, self.chunks(key), strict=True)]
        return reduce(lambda p, q: p & q, tests)

    def _within_folders(self, start: Sequence[int], stop: Sequence[int], key: str) -> Column:
        """The same of folders that chunks share."""
        tests = [(F.col(f) >= int(a) // n // g) & (F.col(f) <= (int(b) - 1) // n // g) for (f, (_, g)), a, b, n in zip(self._folders(key).items(), start, stop, self.chunks(key))]
        return reduce(lambda p, q: p & q, tests, F.lit(True))

    def _rows(self, key: str, box: tuple[Sequence[int], Sequence[int]] | None = None) -> DataFrame:
        """Rows of current chunks, with their ids."""
        index = self.index(key)
        rows = self.spark.read.parquet(self._file(f"{key}/data"))
        if box is not None:
            which = self._within(*box, key)
            rows, index = rows.where(self._within_folders(*box, key)).where(which), index.where(which)
        return rows.join(index, [*self.ids, "v"], "left_semi").drop("v", *self.shared_ids)

    def open(self, key: str = "data") -> DataFrame:
        if key.startswith("_attributes/"):
            return super().open(key)
        return self._rows(key).drop(*self.ids)

    def read(self, start: Sequence[int], stop: Sequence[int], key: str = "data") -> DataFrame:
        """The rows of a half-open box."""
        inside = [(F.col(a) >= int(lo)) & (F.col(a) < int(hi)) for a, lo, hi in zip(self.axes, start, stop, strict=True)]
        return self._rows(key, (start, stop)).where(reduce(lambda p, q: p & q, inside)).drop(*self.ids)

    def _with_ids(self, df: DataFrame, key: str) -> DataFrame:
        """Rows with the ids of their chunks."""
        return df.withColumns({c: F.expr(f"cast({a} div {n} as int)") for c, a, n in zip(self.ids, self.axes, self.chunks(key), strict=True)})

    def _placed(self, df: DataFrame, key: str) -> DataFrame:
        """Rows with the ids of their chunks; a place beyond the shape is an error.  Only for writing: joins would test ids before other conditions."""
        beyond = reduce(lambda p, q: p | q, [(F.col(a) < 0) | (F.col(a) >= n) for a, n in zip(self.axes, self.shape(key), strict=True)])
        first = self.ids[0]
        return self._with_ids(df, key).withColumn(first, F.when(beyond, F.raise_error(F.lit("a row lies beyond the shape")).cast("int")).otherwise(F.col(first)))

    def write(self, df: DataFrame, key: str = "data") -> None:
        """The rows become the whole of every chunk that they touch; other chunks stay."""
        if key.startswith("_attributes/"):
            return super().write(df, key)
        versions = self._versions(key)
        n = versions[-1] + 1 if versions else 0
        folders = self._folders(key)
        placed = self._placed(df, key).withColumns({f: F.expr(f"cast({c} div {many} as int)") for f, (c, many) in folders.items()})
        by = list(folders) or list(self.ids)
        rows = placed.repartition(*by)
        if folders:
            rows = rows.sortWithinPartitions(*by, *self.ids)  # so that ids are told apart by the statistics of a file's pages
        rows.write.mode("overwrite").partitionBy(*by).parquet(self._file(f"{key}/data/v={n}"))
        fs, p = self._hadoop(f"{key}/data/v={n}")
        if not any(s.isDirectory() for s in fs.listStatus(p)):
            if not versions:
                self.spark.createDataFrame([], ", ".join(f"{c} int" for c in self.ids) + ", v int").write.parquet(self._file(f"{key}/index/{n}"))
            return
        new = self.spark.read.parquet(self._file(f"{key}/data/v={n}")).select(*self.ids).distinct().withColumn("v", F.lit(n))
        if versions:
            new = new.unionByName(self.index(key).join(new, list(self.ids), "left_anti"))
        new.write.mode("overwrite").parquet(self._file(f"{key}/index/{n}"))

    def write_box(self, new: DataFrame, value: str, key: str = "data") -> None:
        """Values of the places in ``new`` replace those that are stored; only the chunks that it touches are read and written again, and all are seen at once."""
        touched = self._with_ids(new, key).select(*self.ids).distinct()
        old = self._rows(key).join(touched, list(self.ids), "left_semi").drop(*self.ids)
        other = new.select(*self.axes, F.col(value).alias("_new"), F.lit(True).alias("_is"))
        joined = old.join(other, list(self.axes), "left")
        self.write(joined.withColumn(value, F.when(F.col("_is"), F.col("_new")).otherwise(F.col(value))).select(*old.columns), key)

    def vacuum(self, key: str = "data") -> None:
        """Versions that no chunk of the index names, and older indexes, go; nobody may be reading them."""
        versions = self._versions(key)
        used = {r.v for r in self.index(key).select("v").distinct().collect()}  # as many as there were writes, at most
        fs, p = self._hadoop(f"{key}/data")
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if name.startswith("v=") and int(name[2:]) not in used and int(name[2:]) < versions[-1]:
                fs.delete(s.getPath(), True)
        for n in versions[:-1]:
            fs.delete(self._hadoop(f"{key}/index/{n}")[1], True)
