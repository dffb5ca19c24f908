"""Exploratory summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles


def profile(df: DataFrame, columns: Sequence[str], plain_table: bool = False) -> DataFrame:
    """Count, gaps, mean, deviation, extremes and quartiles, one row per numeric column.

    ``plain_table`` is that of ``exact_quantiles``.
    """
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], plain_table)
    moments = df.agg(*[
        F.struct(
            F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("missing"),
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in columns
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(c)["n"].alias("n"), F.col(c)["missing"].alias("missing"),
            F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"), F.col(c)["min"].alias("min"),
            *[F.lit(q).cast("double").alias(name) for q, name in zip(quartiles[c], ("q25", "q50", "q75"))],
            F.col(c)["max"].alias("max"),
        )
        for c in columns
    ])
    return moments.select(F.explode(rows).alias("r")).select("r.*")


def rate_by(df: DataFrame, key: str, target: str) -> DataFrame:
    """Rows and the share with ``target`` = 1, per key."""
    return df.groupBy(key).agg(
        F.count(target).alias("n"), F.sum(target).cast("bigint").alias("positives"),
    ).withColumn("rate", F.col("positives") / F.nullif(F.col("n"), F.lit(0)))
