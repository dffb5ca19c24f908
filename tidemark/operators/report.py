"""Grouped sales report, headline figures, pivot and merge.

Totals are built from mergeable parts (counts and sums), so a fact table can be
folded by its join key first and by the report's group after the join: the join
then moves one row per key, and a key that holds a third of all rows has been
combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.functions.money import as_amount, units
from tidemark.operators.joins import null_safe_join


# Prices have up to two decimals and discounts are whole percents.
PRICE_PLACES, AMOUNT_PLACES = 2, 4


def revenue(quantity="quantity", price="unit_price", discount="discount") -> Column:
    """Quantity x price after discount."""
    return F.col(quantity) * F.col(price) * (1 - F.col(discount))


def fold_sales(sales: DataFrame, *by: str) -> DataFrame:
    """Mergeable sales totals per ``by``; sums are in whole units of money."""
    return sales.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.count("unit_price").alias("priced"),
        F.sum(units("unit_price", PRICE_PLACES)).alias("price_units"),
        F.sum(units(revenue(), AMOUNT_PLACES)).alias("total_units"),
    )


def merge_sales(folded: DataFrame, *by: str) -> DataFrame:
    """Totals of totals."""
    return folded.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("orders", "priced", "price_units", "total_units")]
    )


def sales_report(totals: DataFrame, group_by: str) -> DataFrame:
    """Rank, count, mean unit price, total and bar width per group, best first.

    ``totals`` comes from ``fold_sales`` or ``merge_sales``. The groups are the lines of
    a report, so one task ranks them: group by a category, not by a customer or an order
    (``ordering.number_rows`` ranks any number of rows).
    """
    best_first = Window.orderBy(F.col("total_units").desc(), F.col(group_by))
    largest = F.first(F.col("total_units").cast("double"), ignorenulls=True).over(best_first)
    return totals.select(
        F.row_number().over(best_first).cast("bigint").alias("rank"),
        F.col(group_by).alias("group"),
        F.col("orders").alias("count"),
        (as_amount("price_units", PRICE_PLACES) / F.nullif(F.col("priced"), F.lit(0))).alias("avg_price"),
        as_amount("total_units", AMOUNT_PLACES).alias("total"),
        F.round(F.col("total_units").cast("double") / F.nullif(largest, F.lit(0.0)) * 100, 1).alias("share_pct"),
    )


def report_rows(report: DataFrame) -> DataFrame:
    """The report as display text, best first."""
    return report.orderBy("rank").select(
        "rank", "group",
        F.format_number("count", 0).alias("count"),
        F.format_number("avg_price", 0).alias("avg_price"),
        F.format_number("total", 0).alias("total"),
        F.format_string("%.1f%%", "share_pct").alias("bar"),
    )


def sales_kpis(totals: DataFrame, group_by: str) -> DataFrame:
    """Total, order count, mean per order, number of groups and best group, as one row."""
    best_first = F.struct(-F.col("total_units"), F.col(group_by))
    return totals.agg(
        as_amount(F.sum("total_units"), AMOUNT_PLACES).alias("grand_total"),
        F.sum("orders").alias("orders"),
        F.count("*").alias("groups"),
        F.min_by(group_by, best_first).alias("top_group"),
    ).select(
        "grand_total", "orders",
        (F.col("grand_total") / F.nullif(F.col("orders"), F.lit(0))).alias("mean_per_order"),
        "groups", "top_group",
    )


def kpi_rows(kpis: DataFrame) -> DataFrame:
    """The headline figures as ``(label, value)`` display text."""
    shown = [
        (texts.KPI_TOTAL, F.format_number("grand_total", 0)),
        (texts.KPI_ORDERS, F.format_number("orders", 0)),
        (texts.KPI_MEAN, F.format_number("mean_per_order", 0)),
        (texts.KPI_TOP, F.col("top_group")),
    ]
    pairs = F.array(*[F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in shown])
    return kpis.select(F.explode(pairs).alias("kpi")).select("kpi.*")


def pivot_revenue(folded: DataFrame, row: str, column: str, values: Sequence[str], other: str = "other") -> DataFrame:
    """Revenue per ``row``, one column per listed value of ``column`` and one for all others, missing ones included.

    The values are listed so that Spark need not read the data twice.
    """
    listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    shown = folded.withColumn(column, F.when(listed, F.col(column)).otherwise(F.lit(other)))
    return shown.groupBy(row).pivot(column, [*values, other]).agg(as_amount(F.sum("total_units"), AMOUNT_PLACES))


def merge_stats(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Each row with the aggregates ``stats`` of its group; missing keys match each other.

    The group side is not hinted: adaptive execution broadcasts it when its
    measured size allows and otherwise splits hot keys of a sort-merge join.
    """
    grouped = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in stats.items()])
    return null_safe_join(df, grouped, keys, "left")
