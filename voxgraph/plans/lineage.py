"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one 8-byte id up to which a table of ids is sent to every executor.
BROADCAST_IDS = 1_000_000


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder (``spark.checkpoint.dir``) and read from there.

    Only where that is unset and Spark runs in one process, as in tests, a temporary folder stands in; on a cluster
    that is an error, as executors do not see each other's folders.  With ``spark.cleaner.referenceTracking.cleanCheckpoints``
    Spark removes the files of tables that are no longer used.
    """
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def _shared_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors see")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's checkpoint folder, for tables of this run."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def large(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent whole: tables of nodes, edges or blocks, which grow with the volume.

    Adaptive execution goes by the size of compressed shuffle files.  Rows of ids are several times as large in memory, where the driver
    collects them, and there are many such joins in a plan.
    """
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files, and checkpoints as above, of tables that nothing refers to any more.

    It does so when the driver collects garbage, which a driver that is not short of memory may not do within a whole run.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_ids(df: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi", most: int = BROADCAST_IDS) -> DataFrame:
    """Semi or anti join on one id; the ids are counted first and sent to every executor only if they are few."""
    ids = cut(ids.select(id_col).distinct())
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, id_col, how)


def settled(df: DataFrame) -> DataFrame:
    """``df`` cut, for loops: without the optimizer's guess of its size.

    Without statistics of columns a join's guess is the product of its sides', which ``cut`` hands on, so that its digits would grow
    threefold with every round.  Adaptive execution measures the sides anyway.
    """
    spark = df.sparkSession
    done = cut(df)
    plain = spark._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False)
    return DataFrame(plain, spark)
