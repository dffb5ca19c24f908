"""Log aggregates on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import as_instant, from_instant
from tidemark.operators.logs import log_by, log_summary
from tidemark.operators.report import fold_sales, sales_report
from tidemark.operators.sketches import merge, sketch
from tidemark.streaming.tables import DRAIN
from tidemark.streaming.versions import change, published, replace_by


def _timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with a watermark, which needs a TIMESTAMP column."""
    return stream.withColumn("_time", as_instant(ts, dict(stream.dtypes)[ts])).withWatermark("_time", delay)


def stream_log_summary(stream: DataFrame, error: Column) -> DataFrame:
    """Running rows, errors and error share."""
    return log_summary(stream, error)


def stream_log_by(stream: DataFrame, key: str, size: str) -> DataFrame:
    """Running count and size per key."""
    return log_by(stream, key, size)


def stream_hourly(stream: DataFrame, ts: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Rows per hour. An hour is emitted once the watermark, ``delay`` behind the newest
    row, has passed it; rows that come after that are dropped."""
    kind = dict(stream.dtypes)[ts]
    hours = _timed(stream, ts, delay).groupBy(F.window("_time", "1 hour").alias("w"))
    return hours.agg(F.count("*").alias("n")).select(from_instant("w.start", kind).alias("hour"), "n")


def stream_error_rate(
    stream: DataFrame,
    error: Column,
    length: str = "10 minutes",
    slide: str = "1 minute",
    ts: str = "timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """Error rate per sliding time window. Windows are independent groups and combine
    before the shuffle, so this form has no hot key however fast the stream."""
    kind = dict(stream.dtypes)[ts]
    windows = _timed(stream, ts, delay).groupBy(F.window("_time", length, slide).alias("w"))
    return windows.agg(
        F.count("*").alias("total"), F.count_if(error).alias("errors")
    ).select(
        from_instant("w.start", kind).alias("window_start"),
        from_instant("w.end", kind).alias("window_end"),
        "total", "errors", (F.col("errors") / F.col("total")).alias("error_rate"),
    )


def refresh_report(sales: DataFrame, group_by: str, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the totals of the sales report current; ``current_report`` ranks them.

    Totals are state, so a refresh reads only new files, and it rewrites only the buckets
    of groups that changed. Every trigger mode ends with the same report.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        change(batch.sparkSession, path, batch_id, batch, group_by, replace_by(group_by))

    return (
        fold_sales(sales, group_by).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{path}/progress").trigger(**(trigger or DRAIN)).start()
    )


def current_report(spark: SparkSession, path: str, group_by: str) -> DataFrame:
    """The report as of the newest published totals."""
    return sales_report(published(spark, path), group_by)


def stream_profile(stream: DataFrame, path: str, columns: Sequence[str], trigger: dict | None = None) -> StreamingQuery:
    """Keep mergeable column profiles of a stream: each batch is scanned once and its
    states are merged into those before it. ``versions.published(spark, path)`` reads them
    for ``sketches.sketched_profile`` or ``sketches.refine``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        change(batch.sparkSession, path, batch_id, sketch(batch, columns), "column",
               lambda there, new: merge(there.unionByName(new)))

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or DRAIN)).start()
    )
