"""Slices that arrive over time: segment counts and defects as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_slices(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def segment_counts(voxels: DataFrame, seg: str = "seg") -> DataFrame:
    """(z, n_segs) of a stream of voxels; distinct labels are found by deduplication of slice and label, then counted."""
    return voxels.select("z", seg).dropDuplicates(["z", seg]).groupBy("z").agg(F.count("*").alias("n_segs"))


def flag_defects(counts: DataFrame, least: float) -> DataFrame:
    return counts.withColumn("is_defect", F.col("n_segs") < least)
