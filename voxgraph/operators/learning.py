"""Random forests on edges and regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.plans.lineage import cut

KEYS = ("u", "v", "edge_type")


def feature_columns(features: DataFrame, keys: Sequence[str] = KEYS) -> list[str]:
    skip = {*keys, "z", "length", "edge_id", "label", "node"}
    return [c for c in features.columns if c not in skip]


#: Training rows of a partition: their number sets the partitions, so that a fit is the same however rows were dealt before.
FIT_ROWS = 200_000


def _plain(columns: Sequence[str]) -> list:
    """Features in single precision: the last digits of their sums depend on the order of the terms."""
    return [F.col(c).cast("float").cast("double").alias(c) for c in columns]


def fit_forest(rows: DataFrame, columns: Sequence[str], label: str = "label", n_trees: int = 500, max_depth: int = 12, seed: int = 0) -> PipelineModel:
    """The same rows give the same forest: they are dealt by a hash and ordered by all their values, and written before the passes over them."""
    rows = rows.select(*_plain(columns), label)
    parts = max(1, rows.count() // FIT_ROWS)
    rows = cut(rows.repartition(parts, F.hash(*columns, label)).sortWithinPartitions(*columns, label))
    assemble = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=n_trees, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[assemble, forest]).fit(rows)


def probability(model: PipelineModel, rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, prob): probability of label 1; undecided where the model has none."""
    p = vector_to_array("probability")
    p1 = F.when(F.size(p) > 1, p[1]).otherwise(F.lit(0.5))
    columns = model.stages[0].getInputCols()
    return model.transform(rows.select(*keys, *_plain(columns))).select(*keys, F.when(F.isnan(p1), 0.5).otherwise(p1).alias("prob"))


def training_rows(features: DataFrame, truth: DataFrame) -> DataFrame:
    """Features with label (1: cut) of the edges whose truth is known."""
    return features.join(truth.where("is_labelled").select(*KEYS, F.col("is_cut").cast("double").alias("label")), list(KEYS))


class EdgeClassifier:
    """One forest for all edges, or one for each type."""

    def __init__(self, models: dict[str, PipelineModel]):
        self.models = models

    @staticmethod
    def learn(sets: Sequence[tuple[DataFrame, DataFrame]], separate: bool = True, n_trees: int = 500, max_depth: int = 12, seed: int = 0) -> EdgeClassifier:
        """From (features, truth) of one or more volumes."""
        rows = [training_rows(f, t) for f, t in sets]
        every = rows[0]
        for r in rows[1:]:
            every = every.unionByName(r)
        columns = feature_columns(every)
        every = cut(every)
        kinds = [r[0] for r in every.select("edge_type").distinct().orderBy("edge_type").collect()] if separate else ["joined"]
        models = {k: fit_forest(every.where(F.col("edge_type") == k) if separate else every, columns, n_trees=n_trees, max_depth=max_depth, seed=seed) for k in kinds}
        return EdgeClassifier(models)

    def predict(self, features: DataFrame) -> DataFrame:
        """(u, v, edge_type, prob) of every edge."""
        if "joined" in self.models:
            return probability(self.models["joined"], features)
        out = None
        for kind, model in self.models.items():
            one = probability(model, features.where(F.col("edge_type") == kind))
            out = one if out is None else out.unionByName(one)
        return out

    def save(self, path: str) -> None:
        for kind, model in self.models.items():
            model.write().overwrite().save(f"{path}/rf_{kind}")

    @staticmethod
    def is_cached(spark: SparkSession, path: str, kinds: Sequence[str]) -> bool:
        """Whether the folder holds a whole forest of each kind."""
        return all(_saved(spark, f"{path}/rf_{k}") for k in kinds)

    @staticmethod
    def load(path: str, kinds: Sequence[str]) -> EdgeClassifier:
        return EdgeClassifier({k: PipelineModel.load(f"{path}/rf_{k}") for k in kinds})


def _saved(spark: SparkSession, path: str) -> bool:
    """Saved models write their stages last."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and {s.getPath().getName() for s in fs.listStatus(p)} >= {"metadata", "stages"}


def has_defect_forest(spark: SparkSession, path: str) -> bool:
    """Whether ``save_defects`` left a forest there."""
    return _saved(spark, f"{path}/rf_defects")


def save_defects(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(f"{path}/rf_defects")


def load_defects(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/rf_defects")


def learn_defects(nodes: DataFrame, truth: DataFrame, n_trees: int = 500, seed: int = 0) -> PipelineModel:
    """A forest that tells defective regions by their statistics; ``truth`` has (node, is_defect)."""
    rows = nodes.join(truth.select("node", F.col("is_defect").cast("double").alias("label")), "node")
    return fit_forest(rows, feature_columns(nodes, ("node",)), n_trees=n_trees, max_depth=30, seed=seed)
