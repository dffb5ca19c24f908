"""Churn model: fit, evaluate, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.operators.forest import forest_probability
from tidemark.operators.imputer import ExactImputer
from tidemark.operators.stats import roc_auc

# The column names of the churn feed.
NUMERIC = ("senior", "tenure_months", "monthly_charges", "total_charges", "num_services")
CATEGORY = ("gender", "contract", "payment_method")


def _spread(df: DataFrame) -> int:
    """Partitions for work that is bound by CPU, however few files its rows come from."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fit_churn(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    category: Sequence[str] = CATEGORY,
    label: str = "churn",
    trees: int = 200,
    seed: int = 42,
) -> PipelineModel:
    """Imputation, encoding and a random forest as one pipeline.

    Fitting reads the training rows many times and is bound by CPU, so they are
    written once, spread over all cores, with only the columns that are used.
    """
    train = stored(train.select(*numeric, *category, label).repartition(_spread(train)))
    filled = [f"{c}_filled" for c in numeric]
    index, flags = [f"{c}_index" for c in category], [f"{c}_flags" for c in category]
    return Pipeline(stages=[
        ExactImputer(inputCols=list(numeric), outputCols=filled),
        StringIndexer(inputCols=list(category), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=flags),
        VectorAssembler(inputCols=[*filled, *flags], outputCol="features"),
        RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed),
    ]).fit(train)


def hold_out(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. A row's side follows from its key, so a retried task
    cannot move it."""
    in_test = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) < int(test_share * 1_000_000)
    return df.where(~in_test), df.where(in_test)


def score(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """Customers with their churn ``probability``, to three places."""
    return model.transform(customers).select(
        *customers.columns, F.round(vector_to_array("probability")[1], 3).alias("probability")
    )


def score_by_nodes(model: PipelineModel, nodes: DataFrame, customers: DataFrame) -> DataFrame:
    """Like ``score``, with the forest's part done on its table of nodes.

    Customers are dealt evenly first: a small file is one task, and walking all trees is bound by CPU.
    """
    featured = PipelineModel(model.stages[:-1]).transform(customers.repartition(_spread(customers)))
    depth = model.stages[-1].getMaxDepth()
    return forest_probability(featured, nodes, depth).select(
        *customers.columns, F.round("probability", 3).alias("probability"))


def evaluate(model: PipelineModel, test: DataFrame, label: str = "churn") -> DataFrame:
    """ROC-AUC on held-out rows."""
    return roc_auc(score(model, test), "probability", label)


def take_sample(df: DataFrame, key: str, n: int = 200, seed: int = 42) -> DataFrame:
    """``n`` rows picked by a hash of their key: the same rows on every run."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), key).limit(n)
