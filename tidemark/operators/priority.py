"""Scored customers ranked by expected loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts


def expected_loss(scored: DataFrame) -> DataFrame:
    """Add the monthly charge at risk: probability x charge."""
    return scored.withColumn("expected_loss", F.round(F.col("probability") * F.col("monthly_charges"), 1))


def risk_tier(scored: DataFrame, hi: float = 0.6, mid: float = 0.35) -> DataFrame:
    """Add the risk tier for the churn probability."""
    high, middle, low = texts.TIERS
    p = F.col("probability")
    return scored.withColumn("tier", F.when(p >= hi, high).when(p >= mid, middle).otherwise(low))


def retention_priority(scored: DataFrame) -> DataFrame:
    """Customers by expected loss, largest first; equal losses by id."""
    return risk_tier(expected_loss(scored)).orderBy(F.col("expected_loss").desc(), "customer_id")


def call_list(scored: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers to call first."""
    return retention_priority(scored).limit(k)


def retention_list(scored: DataFrame) -> DataFrame:
    """The priority list under its headings, ready to export."""
    return retention_priority(scored).select(
        *[F.col(name).alias(heading) for name, heading in texts.RETENTION_HEADINGS.items()]
    )
