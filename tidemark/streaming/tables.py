"""Running a stream into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.session import discard, scratch

DRAIN = {"availableNow": True}


def append_to(result: DataFrame, path: str, trigger: dict | None = None, table: str = "data") -> StreamingQuery:
    """Append finished rows to the Parquet table ``<path>/<table>``."""
    return (
        result.writeStream.outputMode("append").format("parquet")
        .option("path", f"{path}/{table}").option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or DRAIN)).start()
    )


def refresh_to(
    result: DataFrame,
    path: str,
    trigger: dict | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """On each trigger write the whole current aggregate, passed through ``finish``,
    as a new version. A replayed batch rewrites its own version. The version before it
    stays for readers that have begun; older ones are removed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            finish(batch).write.mode("overwrite").parquet(f"{path}/data/version={batch_id}")
        discard(batch.sparkSession, f"{path}/data/version={batch_id - 2}")

    return (
        result.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or DRAIN)).start()
    )


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version written by ``refresh_to``."""
    versions = spark.read.parquet(f"{path}/data")
    newest = versions.agg(F.max("version")).scalar()
    return versions.where(F.col("version") == newest).drop("version")


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait until a draining query has used up its input."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not finish in time")
