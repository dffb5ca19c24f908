import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import rows
from tidemark.operators import churn, priority
from tidemark.operators.forest import forest_probability
from tidemark.operators.imputer import ExactImputer, ExactImputerModel
from tidemark.plans import models as plans
from tidemark.plans.tables import Tables, churn_customers
from tidemark.sources import models

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def test_medians_are_exact_and_survive_saving(spark, tmp_path):
    nan = float("nan")
    data = [(1, 4.0, None), (2, nan, None), (None, 1.0, None), (10, None, None), (3, 2.5, None)]
    df = spark.createDataFrame(data, "a INT, b DOUBLE, c DOUBLE")
    ExactImputer(inputCols=["a", "b", "c"], outputCols=["x", "y", "z"]).fit(df).write().save(str(tmp_path / "m"))
    loaded = ExactImputerModel.load(str(tmp_path / "m"))
    assert loaded.getFills() == [2.5, 2.5, 0.0]  # a column of gaps alone is filled with 0
    assert sorted(rows(loaded.transform(df), "x", "y", "z")) == [
        (1.0, 4.0, 0.0), (2.0, 2.5, 0.0), (2.5, 1.0, 0.0), (3.0, 2.5, 0.0), (10.0, 2.5, 0.0)]


def test_medians_of_many_rows_and_of_none(spark):
    fit = ExactImputer(inputCols=["a"], outputCols=["x"]).fit
    many = spark.range(100_001).select((F.pmod(F.col("id") * 7919, 100_001)).alias("a"))
    assert fit(many).getFills() == [50_000.0]
    assert fit(many.limit(0)).getFills() == [0.0]


def _walk(nodes, x):
    at = 0
    while nodes[at]["left"] >= 0:
        n = nodes[at]
        value = x[n["feature"]]
        left = value <= n["cuts"][0] if n["categories"] < 0 else value in n["cuts"]
        at = n["left"] if left else n["right"]
    return nodes[at]["stats"]


@pytest.fixture(scope="module")
def scored(spark):
    """Customers, the saved model's forest and each customer's probability by a plain walk over the nodes."""
    t = Tables(spark, FOLDER)
    path = plans._saved_model(t)
    model, trees = models.load_model(path), {}
    for n in models.read_forest(spark, path).collect():
        trees.setdefault(n["tree"], {})[n["node"]] = n
    customers = churn_customers(t)
    featured = PipelineModel(model.stages[:-1]).transform(customers)
    walked = {}
    for customer, x in featured.select("customer_id", vector_to_array("features")).collect():
        votes = [_walk(trees[tree], x) for tree in sorted(trees)]
        walked[customer] = sum(v[1] / (v[0] + v[1]) for v in votes) / len(trees)
    return customers, model, len(trees), walked


@needs_tables
def test_scores_are_those_of_the_nodes_and_of_the_model(spark, scored):
    customers, model, trees, walked = scored
    assert trees == 200
    got = {r["customer_id"]: r for r in contract.queries()["fit_churn_score"](spark, FOLDER).collect()}
    assert got.keys() == walked.keys()
    for customer, p in walked.items():
        assert abs(got[customer]["probability"] - p) <= 0.0005 + 1e-9
    own = model.transform(customers).select("customer_id", vector_to_array("probability")[1]).collect()
    assert all(abs(walked[customer] - p) < 1e-9 for customer, p in own)


@needs_tables
def test_call_list_is_the_top_of_the_month(spark, scored):
    customers, walked = scored[0], scored[3]
    month = churn.take_sample(customers, "customer_id", 200).select("customer_id", "monthly_charges").collect()
    got = rows(contract.queries()["retention_top"](spark, FOLDER), "customer_id", "expected_loss")
    losses = {r["customer_id"]: r["monthly_charges"] * walked[r["customer_id"]] for r in month}
    limit = sorted(losses.values(), reverse=True)[9]
    charges = {r["customer_id"]: abs(r["monthly_charges"]) for r in month}
    assert len(got) == 10 and [g[1] for g in got] == sorted((g[1] for g in got), reverse=True)
    for customer, loss in got:
        slack = 0.0005 * charges[customer] + 0.051  # three places of the probability, one of the loss
        assert abs(loss - losses[customer]) <= slack and losses[customer] >= limit - 2 * slack


@needs_tables
def test_auc_counts_rightly_ordered_pairs(spark, scored):
    customers, walked = scored[0], scored[3]
    test = churn.hold_out(customers, "customer_id")[1].select("customer_id", "churn").collect()
    probability = {c: float(p) for c, p in rows(contract.queries()["fit_churn_score"](spark, FOLDER), "customer_id", "probability")}
    bad = [probability[c] for c, gone in test if gone]
    good = [probability[c] for c, gone in test if not gone]
    pairs = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    got = contract.queries()["evaluate_churn"](spark, FOLDER).first()
    assert (got["positives"], got["negatives"]) == (len(bad), len(good))
    assert got["auc"] == pytest.approx(pairs / (len(bad) * len(good)), abs=1e-9)


@needs_tables
def test_forest_travels_as_one_row_and_customers_stay(spark):
    t = Tables(spark, FOLDER)
    path = plans._saved_model(t)
    scored = churn.score_by_nodes(models.load_model(path), models.read_forest(spark, path), churn_customers(t))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "Python" not in plan
    assert priority.risk_tier(scored).count() == t.customer.count()


def test_flat_forest_walks_both_kinds_of_split(spark):
    nodes = spark.createDataFrame([
        (7, 0, 1, 4, 0, [0.5], -1, [5.0, 5.0]), (7, 1, 2, 3, 1, [2.0, 0.0], 3, [1.0, 1.0]), (7, 2, -1, -1, -1, [], -1, [3.0, 1.0]),
        (7, 3, -1, -1, -1, [], -1, [1.0, 1.0]), (7, 4, -1, -1, -1, [], -1, [0.0, 4.0]), (9, 0, -1, -1, -1, [], -1, [1.0, 3.0])],
        "tree INT, node INT, left INT, right INT, feature INT, cuts ARRAY<DOUBLE>, categories INT, stats ARRAY<DOUBLE>")
    data = [("a", Vectors.dense(0.5, 2.0)), ("b", Vectors.dense(0.5, 1.0)), ("c", Vectors.dense(0.6, 0.0)), ("d", Vectors.dense(float("nan"), 0.0))]
    scored = forest_probability(spark.createDataFrame(data, ["id", "features"]), nodes, 3)
    assert scored.columns == ["id", "features", "probability"]
    assert dict(rows(scored, "id", "probability")) == {"a": 0.5, "b": 0.625, "c": 0.875, "d": 0.875}


@needs_tables
def test_trees_are_walked_once_however_scores_are_used(spark):
    for name in ("fit_churn_score", "evaluate_churn"):
        plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "aggregate(" not in plan
    path = plans._saved_model(t := Tables(spark, FOLDER))
    scored = churn.score_by_nodes(models.load_model(path), models.read_forest(spark, path), churn_customers(t))
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
