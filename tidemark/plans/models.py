"""Churn model queries. SQL cannot fit a forest; it checks all that follows from the scores, and a test walks the nodes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.functions.session import fresh_dir, stored
from tidemark.operators import churn, priority
from tidemark.operators.imputer import ExactImputer, ExactImputerModel
from tidemark.operators.stats import roc_auc
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, churn_customers
from tidemark.sources.models import load_model, read_forest, save_model


_CUSTOMERS = """
    SELECT 'CUST-' || lpad(c_custkey::varchar, 5, '0') AS customer_id, c_acctbal AS monthly_charges, c_mktsegment AS gender,
           coalesce(min(o_orderstatus), 'none') AS contract, coalesce(max(o_orderpriority), 'none') AS payment_method,
           count(DISTINCT o_orderpriority) AS num_services
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal, c_mktsegment"""
_FEATURES = """
    SELECT c_acctbal AS monthly_charges, count(DISTINCT o_orderpriority) AS num_services,
           CASE WHEN c_acctbal >= 0 THEN cast(coalesce(sum(cast(o_totalprice AS decimal(12,2))), 0) AS double) END AS total_charges
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal"""


_MODELS: dict[tuple[str, str], str] = {}


def _saved_model(t: Tables) -> str:
    """Where the model of this session's tables is saved; fitted on first use, on the training side of the hold-out."""
    place = (t.spark.sparkContext.applicationId, t.folder)
    if place not in _MODELS:
        path = fresh_dir(t.spark, "model")
        save_model(churn.fit_churn(churn.hold_out(churn_customers(t), "customer_id")[0]), path)
        _MODELS[place] = path
    return _MODELS[place]


def _scored(t: Tables, customers: DataFrame) -> DataFrame:
    """Written once: sorting by what follows from a score reads its rows twice, and each read would walk all trees."""
    path = _saved_model(t)
    return stored(churn.score_by_nodes(load_model(path), read_forest(t.spark, path), customers))


@query("fit_churn_score")
def fit_churn_score(t: Tables) -> DataFrame:
    """Every customer's probability of leaving, loss and tier, from the saved forest's nodes."""
    return priority.retention_priority(_scored(t, churn_customers(t)))


@query("churn_score_checks", f"""
    SELECT *, true AS in_range, true AS three_places, true AS nodes_as_model, true AS loss_follows, true AS tier_follows
    FROM ({_CUSTOMERS})""")
def churn_score_checks(t: Tables) -> DataFrame:
    """What must hold for the scores by nodes and by the loaded model, the losses and the tiers."""
    customers = churn_customers(t)
    ranked = priority.retention_priority(_scored(t, customers))
    own = churn.score(load_model(_saved_model(t)), customers).select("customer_id", F.col("probability").alias("own"))
    p, loss, tier = F.col("probability"), F.col("expected_loss"), F.col("tier")
    high, middle, low = texts.TIERS
    return ranked.join(own, "customer_id").select(
        "customer_id", "monthly_charges", "gender", "contract", "payment_method", "num_services",
        p.between(0, 1).alias("in_range"), (p == F.round(p, 3)).alias("three_places"),
        (F.abs(p - F.col("own")) <= 0.0010001).alias("nodes_as_model"),
        (F.abs(loss - p * F.col("monthly_charges")) <= 0.0500001).alias("loss_follows"),
        (((tier == high) == (p >= 0.6)) & ((tier == low) == (p < 0.35)) & tier.isin(high, middle, low)).alias("tier_follows"))


@query("churn_fill_values", " UNION ALL ".join(
    f'''SELECT '{c}' AS "column", coalesce(quantile_cont({c}, 0.5), 0) AS fill FROM ({_FEATURES})'''
    for c in ("monthly_charges", "total_charges", "num_services")))
def churn_fill_values(t: Tables) -> DataFrame:
    """Medians that the model's imputer learns from all customers, after it has been saved and loaded."""
    columns, path = ["monthly_charges", "total_charges", "num_services"], fresh_dir(t.spark, "imputer")
    ExactImputer(inputCols=columns, outputCols=[f"{c}_filled" for c in columns]).fit(churn_customers(t)).write().save(path)
    loaded = ExactImputerModel.load(path)
    return t.spark.createDataFrame(list(zip(loaded.getInputCols(), loaded.getFills())), "column STRING, fill DOUBLE")


@query("retention_top")
def retention_top(t: Tables) -> DataFrame:
    """The month's 200 customers scored by the saved model, and the ten to call first."""
    month = churn.take_sample(churn_customers(t), "customer_id", 200)
    return priority.call_list(_scored(t, month), 10)


@query("evaluate_churn")
def evaluate_churn(t: Tables) -> DataFrame:
    """ROC-AUC on customers held out of the fit."""
    return roc_auc(_scored(t, churn.hold_out(churn_customers(t), "customer_id")[1]), "probability", "churn")


@query("churn_auc_checks", """
    SELECT count(*) AS customers, true AS sides_add_up, true AS auc_in_range, true AS auc_as_pairs FROM customer""")
def churn_auc_checks(t: Tables) -> DataFrame:
    """The held-out ROC-AUC against the share of rightly ordered pairs counted per score."""
    customers = churn_customers(t)
    train, test = churn.hold_out(customers, "customer_id")
    scored = _scored(t, test)
    auc = roc_auc(scored, "probability", "churn")
    # Scores have three places, so there are at most 1,001 of them to order.
    per_score = scored.groupBy("probability").agg(F.sum("churn").alias("bad"), F.sum(1 - F.col("churn")).alias("good"))
    below = F.coalesce(F.sum("good").over(Window.orderBy("probability").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pairs = per_score.withColumn("below", below).agg(
        F.sum(F.col("bad") * (F.col("below") + F.col("good") / 2)).alias("right"), (F.sum("bad") * F.sum("good")).alias("pairs"))
    rows = customers.agg(F.count("*").alias("customers")).crossJoin(auc).crossJoin(pairs)  # one row each
    return rows.select(
        "customers", (F.lit(train.count()) + F.col("positives") + F.col("negatives") == F.col("customers")).alias("sides_add_up"),
        F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("auc_in_range"),
        F.coalesce(F.abs(F.col("auc") - F.try_divide(F.col("right"), F.col("pairs"))) <= 1e-9, F.lit(True)).alias("auc_as_pairs"))


@query("take_sample", """
    SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY md5('42:' || c_custkey) LIMIT 200""")
def take_sample(t: Tables) -> DataFrame:
    """The month's 200 customers."""
    return churn.take_sample(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", 200)
