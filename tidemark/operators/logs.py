"""Aggregates over logs and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sum
from tidemark.functions.times import hour_of


def server_error(status: str = "status") -> Column:
    """True for a 5xx status."""
    return F.floor(F.col(status) / 100) == 5


def log_summary(logs: DataFrame, error: Column) -> DataFrame:
    """Rows, errors and error share, as one row."""
    return logs.agg(
        F.count("*").alias("total"), F.count_if(error).alias("errors")
    ).withColumn("error_share", F.col("errors") / F.nullif(F.col("total"), F.lit(0)))


def status_classes(logs: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status class (2 for 2xx, 5 for 5xx)."""
    return logs.groupBy(F.floor(F.col(status) / 100).cast("int").alias("status_class")).agg(
        F.count("*").alias("n")
    )


def log_by(logs: DataFrame, key: str, size: str) -> DataFrame:
    """Count and summed size per key."""
    return logs.groupBy(key).agg(F.count("*").alias("n"), F.sum(size).alias("total_size"))


def partial_then_final(
    df: DataFrame, key: str, value: str, salt: Sequence[str], buckets: int = 16
) -> DataFrame:
    """Count, sum, smallest and largest per key by merging the parts of salted buckets.

    Equal to the direct aggregate; a hot key's rows are spread over ``buckets``
    parts before the final merge.
    """
    bucket = F.pmod(F.xxhash64(*salt), F.lit(buckets)).alias("bucket")
    parts = df.groupBy(key, bucket).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"),
        F.min(value).alias("smallest"), F.max(value).alias("largest"),
    )
    return parts.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("smallest").alias("smallest"), F.max("largest").alias("largest"),
    )


def hourly_traffic(logs: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows per hour."""
    return logs.groupBy(hour_of(ts, dict(logs.dtypes)[ts]).alias("hour")).agg(F.count("*").alias("n"))


def amount_by_type(events: DataFrame, amount: str = "amount", above: float = 0, places: int = 2) -> DataFrame:
    """Count, sum and mean of the amounts above a floor, per event type.

    Amounts have up to ``places`` decimals. The floor reaches the Parquet scan.
    """
    return (
        events.where(F.col(amount) > above)
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), exact_sum(amount, places).alias("total"))
        .withColumn("mean", F.col("total") / F.col("n"))
    )


AMOUNT_BY_TYPE_SQL = """
    SELECT event_type, count(*) AS n, sum(rint({amount} * {unit})) / {unit} AS total,
           sum(rint({amount} * {unit})) / {unit} / count(*) AS mean
    FROM {events}
    WHERE {amount} > {above}
    GROUP BY event_type
"""


def amount_by_type_sql(
    events: DataFrame, amount: str = "amount", above: float = 0, places: int = 2
) -> DataFrame:
    """``amount_by_type`` written in SQL."""
    text = AMOUNT_BY_TYPE_SQL.format(events="{events}", amount=amount, above=above, unit=10**places)
    return events.sparkSession.sql(text, events=events)


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with multiplicity) found on one side only; empty when results agree."""
    return (
        left.exceptAll(right).withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )


def parity(events: DataFrame, amount: str = "amount", above: float = 0) -> DataFrame:
    """The DataFrame answer, with the number of rows in which the SQL answer differs."""
    by_api, by_sql = amount_by_type(events, amount, above), amount_by_type_sql(events, amount, above)
    differing = differing_rows(by_api, by_sql).agg(F.count("*")).scalar()
    return by_api.withColumn("differing_rows", differing)
