"""Store metrics and the alert rules built on them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts

# Fixed value: days of stock shown for products that do not sell.
NO_SALES_DAYS = 999.0


@dataclass(frozen=True)
class AlertLimits:
    low_days: float = 2.0
    order_days: int = 7
    out_reorder_factor: int = 2
    expiry_days: int = 2
    price_change_pct: float = 20.0
    over_days: float = 30.0


def store_metrics(products: DataFrame) -> DataFrame:
    """Add inventory value, price change in percent and days of stock."""
    change = (F.col("price") - F.col("last_price")) / F.nullif(F.col("last_price"), F.lit(0)) * 100
    days = F.when(F.col("daily_sales") == 0, NO_SALES_DAYS).otherwise(
        F.round(F.col("stock") / F.nullif(F.col("daily_sales"), F.lit(0)), 1)
    )
    return products.withColumns({
        "inventory_value": F.col("price") * F.col("stock"),
        "price_change_pct": F.round(change, 1),
        "days_of_stock": days,
    })


def _rules(limits: AlertLimits) -> list[tuple[str, str, Column, Column, Column]]:
    """(prefix, level, condition, reason, action) per rule."""
    stock, daily, days = F.col("stock"), F.col("daily_sales"), F.col("days_of_stock")
    pct, expiry, reorder = F.col("price_change_pct"), F.col("expiry_days"), F.col("reorder_level")
    refill = F.greatest(F.ceil(limits.order_days * daily - stock), F.lit(0)).cast("bigint")
    return [
        ("OUT", texts.LEVEL_URGENT, stock == 0,
         F.lit(texts.OUT_REASON),
         F.format_string(texts.OUT_ACTION, (limits.out_reorder_factor * reorder).cast("bigint"))),
        ("EXP", texts.LEVEL_URGENT, (expiry <= limits.expiry_days) & (stock > 0) & (stock > expiry * daily),
         F.format_string(texts.EXP_REASON, expiry, stock.cast("bigint")),
         F.lit(texts.EXP_ACTION)),
        ("LOW", texts.LEVEL_CAUTION, (stock != 0) & ((stock <= reorder) | (days < limits.low_days)),
         F.format_string(texts.LOW_REASON, stock.cast("bigint"), days),
         F.format_string(texts.LOW_ACTION, F.lit(limits.order_days), refill)),
        ("PRICE", texts.LEVEL_CHECK, F.abs(pct) >= limits.price_change_pct,
         F.format_string(texts.PRICE_REASON, pct),
         F.lit(texts.PRICE_ACTION)),
        ("NOSALE", texts.LEVEL_WATCH, (daily == 0) & (stock > 0),
         F.format_string(texts.NOSALE_REASON, stock.cast("bigint")),
         F.lit(texts.NOSALE_ACTION)),
        ("OVER", texts.LEVEL_WATCH, (daily > 0) & (days >= limits.over_days),
         F.format_string(texts.OVER_REASON, days),
         F.lit(texts.OVER_ACTION)),
    ]


def product_alerts(metrics: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """One row per rule a product meets; a product may raise several. Narrow, no shuffle."""
    rules = _rules(limits)
    raised = F.array(*[
        F.when(condition, F.struct(
            F.concat(F.lit(f"{prefix}-"), "product_id").alias("alert_id"),
            F.lit(level).alias("level"),
            F.col("product_name").alias("product"),
            reason.alias("reason"),
            action.alias("action"),
        ))
        for prefix, level, condition, reason, action in rules
    ])
    some = reduce(lambda a, b: a | b, [condition for _, _, condition, _, _ in rules])
    return (
        metrics.where(some)
        .select(F.explode(raised).alias("alert"))
        .where(F.col("alert").isNotNull())
        .select("alert.*")
    )


def data_alerts(invalid: DataFrame) -> DataFrame:
    """Invalid products as alerts."""
    return invalid.select(
        F.concat(F.lit("DATA-"), "product_id").alias("alert_id"),
        F.lit(texts.LEVEL_DATA).alias("level"),
        F.col("product_name").alias("product"),
        F.concat("error_field", F.lit(": "), "error_message").alias("reason"),
        F.col("recommended_action").alias("action"),
    )


def level_rank(level: str = "level") -> Column:
    """Alert levels as numbers, most pressing first."""
    return F.array_position(F.array(*[F.lit(x) for x in texts.ALERT_LEVELS]), F.col(level))


def alerts(metrics: DataFrame, invalid: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """All alerts, most pressing level first, then by product name."""
    return _in_order(data_alerts(invalid).unionByName(product_alerts(metrics, limits)))


def _in_order(raised: DataFrame) -> DataFrame:
    return raised.orderBy(level_rank(), "product", "alert_id")


def open_alerts(raised: DataFrame, done: DataFrame) -> DataFrame:
    """Alerts that nobody has marked as done, in the order of ``alerts``."""
    return _in_order(raised.join(done.select("alert_id"), "alert_id", "left_anti"))
