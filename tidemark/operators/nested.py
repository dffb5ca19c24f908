"""Nested records to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_products(df: DataFrame, sep: str = "|") -> DataFrame:
    """``seller`` struct to ``seller_id`` and ``seller_region``, ``tags`` array to one text."""
    return df.select(
        "id", "name", "category", "price", "quantity",
        F.array_join("tags", sep).alias("tags"),
        F.col("seller.id").alias("seller_id"),
        F.col("seller.region").alias("seller_region"),
    )


def flatten_props(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON text column to one column per field of ``schema``; bad JSON gives nulls."""
    return df.withColumn("_props", F.from_json(column, schema)).select(
        *[c for c in df.columns if c != column], "_props.*"
    )
