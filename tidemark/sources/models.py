"""Fitted pipelines on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_model(model: PipelineModel, path: str) -> None:
    """Save the whole pipeline, preprocessing included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_forest(spark: SparkSession, path: str) -> DataFrame:
    """The forest that ends a saved pipeline, one row per node.

    ``left`` and ``right`` are -1 in leaves. A split with ``categories`` of -1 sends
    values up to ``cuts[0]`` to the left, any other the values listed in ``cuts``.
    ``stats`` counts the training rows per label.
    """
    stages = load_model(path).stages
    place = PipelineSharedReadWrite.getStagePath(stages[-1].uid, len(stages) - 1, len(stages), f"{path}/stages")
    n = F.col("nodeData")
    return spark.read.parquet(f"{place}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), n["split"]["leftCategoriesOrThreshold"].alias("cuts"),
        n["split"]["numCategories"].alias("categories"), n["impurityStats"].alias("stats"))
