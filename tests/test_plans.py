"""Physical plans: what reaches the scan, and what must not appear."""

import contextlib
import io

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _query(spark, name):
    return contract.queries()[name](spark, FOLDER)


def test_filter_and_columns_reach_the_scan(spark):
    plan = _plan(_query(spark, "amount_by_type"))
    assert "GreaterThan(value,100.0)" in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_sql_and_api_share_one_plan(spark):
    from tidemark.operators import logs
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    by_sql = _plan(logs.amount_by_type_sql(events, "value", 100))
    assert "GreaterThan(value,100.0)" in by_sql


def test_rules_reach_the_scan(spark):
    from tidemark.operators import validation
    part = spark.read.parquet(f"{FOLDER}/part.parquet").selectExpr(
        "p_name AS product_name", "p_retailprice AS price", "p_size AS stock")
    valid, _ = validation.validate(part, validation.product_rules())
    assert "GreaterThan(p_retailprice,0.0)" in _plan(valid)


@pytest.mark.parametrize("name", [
    "validate_valid", "validate_invalid", "store_metrics", "flatten_props", "normalise_types", "impute", "clip_iqr"])
def test_row_wise_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in _plan(_query(spark, name))


@pytest.mark.parametrize("name", [
    "sales_report_by_region", "pivot_revenue", "merge_stats", "expected_loss", "alerts", "open_alerts", "rate_by",
    "alert_snapshot", "rolling_alerts_by_user", "flatten_products"])
def test_joins_are_equi_joins(spark, name):
    plan = _plan(_query(spark, name))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["call_list", "take_sample", "bottom_tasks"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in _plan(_query(spark, name))


@pytest.mark.parametrize("name", ["rolling_error_rate", "rolling_error_rate_by_user"])
def test_rolling_window_is_partitioned(spark, name):
    plan = _plan(_query(spark, name))
    window = plan.index("Window")
    assert "hashpartitioning(_chunk" in plan[window:]


def test_sales_are_folded_before_the_join(spark):
    from tidemark.plans.tables import Tables, sales_by_type
    plan = _plan(sales_by_type(Tables(spark, FOLDER)))
    join = plan.index("HashJoin")
    assert "partial_sum" in plan[join:]
