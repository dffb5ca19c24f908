import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import money
from tidemark.operators import logs, ordering, priority, report


@pytest.fixture(scope="module")
def totals(spark):
    # Published group totals and their bar widths.
    data = [("Food", 1049, 1981805190.0), ("Beauty", 1012, 3001031054.0), ("Electronics", 995, 2524390519.0),
            ("Home", 977, 1973037045.0), ("Fashion", 967, 2657507846.0)]
    return spark.createDataFrame(data, "category STRING, orders LONG, total DOUBLE").select(
        "category", "orders", F.col("orders").alias("priced"),
        (F.col("orders") * 150000.4 * 100).cast("decimal(30,0)").alias("price_units"),
        (F.col("total") * 10_000).cast("decimal(30,0)").alias("total_units"))


def test_report_order_and_bars(totals):
    got = rows(report.sales_report(totals, "category").orderBy("rank"), "rank", "group", "share_pct")
    assert got == [(1, "Beauty", 100.0), (2, "Fashion", 88.6), (3, "Electronics", 84.1),
                   (4, "Food", 66.0), (5, "Home", 65.7)]


def test_report_text(totals):
    first = rows(report.report_rows(report.sales_report(totals, "category")))[0]
    assert first == (1, "Beauty", "1,012", "150,000", "3,001,031,054", "100.0%")


def test_headline_figures(totals):
    got = dict(rows(report.kpi_rows(report.sales_kpis(totals, "category"))))
    assert list(got.values()) == ["12,137,771,654", "5,000", "2,427,554", "Beauty"]


@pytest.mark.parametrize("parts", [1, 3, 7, 16])
def test_money_sums_to_the_same_bits_in_any_partition(spark, parts):
    prices = spark.range(400_000).select((F.xxhash64("id") % 10**13 / 100 + 10**11).alias("price"))
    units = F.sum(money.units("price", 2))
    total = prices.repartition(parts).agg(units.alias("u"), money.exact_sum("price", 2).alias("s")).first()
    exact = sum(round(r["price"] * 100) for r in prices.toLocalIterator())
    assert exact > 2**53 and (int(total["u"]), total["s"]) == (exact, float(exact) / 100)


def test_groups_are_ranked_by_partition(spark):
    values = random.Random(2).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v INT")
    got = rows(ordering.number_rows(df, [F.col("v").desc()], "rank").orderBy("rank"), "v", "rank")
    assert got == [(v, i) for i, v in enumerate(sorted(values, reverse=True), 1)]


def test_running_totals(spark):
    values = random.Random(4).sample(range(10_000), 400)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v INT, w LONG")
    got = dict(rows(ordering.running_totals(df, [F.col("v")], ["w"]), "v", "w_before"))
    total = 0
    for v in sorted(values):
        assert got[v] == total
        total += v % 7


def test_parts_merge_to_the_direct_aggregate(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("k"), (F.col("id") * 2).alias("v"))
    direct = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total"),
                                 F.min("v").alias("smallest"), F.max("v").alias("largest"))
    merged = logs.partial_then_final(df, "k", "v", ["id"])
    assert logs.differing_rows(direct, merged).count() == 0


def test_differing_rows_count_multiplicity(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "x INT"), spark.createDataFrame([(1,)], "x INT")
    assert rows(logs.differing_rows(a, b)) == [(1, "left")]


def test_log_shares(spark):
    df = spark.createDataFrame([(s,) for s in [204] * 31 + [307] * 5 + [410] * 9 + [502] * 3 + [599] * 2], "status INT")
    got = logs.log_summary(df, logs.server_error()).first()
    assert (got["total"], got["errors"], got["error_share"]) == (50, 5, 0.1)
    assert dict(rows(logs.status_classes(df))) == {2: 31, 3: 5, 4: 9, 5: 5}


# Customer, probability, monthly charges, expected loss, tier.
SCORED = [
    ("CUST-01673", 0.745, 116.35, 86.7, "🔴 높음"), ("CUST-00830", 0.84, 101.11, 84.9, "🔴 높음"),
    ("CUST-01144", 0.625, 98.13, 61.3, "🔴 높음"), ("CUST-02126", 0.52, 99.19, 51.6, "🟡 중간"),
    ("CUST-05125", 0.215, 114.43, 24.6, "🟢 낮음"), ("CUST-03648", 0.565, 36.56, 20.7, "🟡 중간"),
]


def test_priority_is_by_expected_loss(spark):
    schema = "customer_id STRING, probability DOUBLE, monthly_charges DOUBLE"
    df = spark.createDataFrame([s[:3] for s in reversed(SCORED)], schema)
    got = rows(priority.retention_priority(df), "customer_id", "probability", "monthly_charges", "expected_loss", "tier")
    assert got == SCORED
    assert [r[0] for r in rows(priority.call_list(df, 2), "customer_id")] == ["CUST-01673", "CUST-00830"]
    listed = priority.retention_list(df.selectExpr("*", "'One year' AS contract", "3 AS tenure_months"))
    assert listed.columns[1:3] == ["위험도", "이탈확률"]
