"""Hourly counts in which no row goes missing.

Spark's own watermark drops late rows without a trace but a counter. Here a batch's
rows are sorted into three: on time, late (their hour was closed by the rows of
earlier batches) and untimed (null time). On-time rows are folded into the hours,
late and untimed ones are kept whole in a table of their own, and every published
version carries the three counts.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.session import discard
from tidemark.functions.times import as_instant, from_instant
from tidemark.streaming.tables import DRAIN
from tidemark.streaming.versions import change, newest, published

_HOUR = 3_600_000_000


def _add(there: DataFrame, new: DataFrame) -> DataFrame:
    return there.unionByName(new).groupBy("hour").agg(F.sum("n").alias("n"))


def stream_hourly_accounted(
    stream: DataFrame,
    path: str,
    ts: str = "timestamp",
    delay: datetime.timedelta = datetime.timedelta(minutes=10),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count rows per hour into ``path``, see ``accounted_hours``, ``late_rows`` and ``row_accounts``.

    The watermark is ``delay`` behind the newest row of the batches before, to the
    millisecond, and an hour is closed when it ends at or before it: the rule of
    ``stream_hourly``. It is part of the published version, so a restart or a batch
    that runs again sorts its rows the same way.
    """
    kind, columns = dict(stream.dtypes)[ts], stream.columns
    lag = int(delay / datetime.timedelta(microseconds=1))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = newest(spark, path)
        if before is not None and before.batch >= batch_id:
            return
        notes = before.notes if before else {"newest": None, "rows": 0, "on_time": 0, "late": 0, "untimed": 0}
        closed = None if notes["newest"] is None else (notes["newest"] - lag) // 1000 * 1000
        micros = F.unix_micros(as_instant(ts, kind))
        hour = micros - F.pmod(micros, F.lit(_HOUR))
        late = F.coalesce(hour + _HOUR <= closed, F.lit(False)) if closed is not None else F.lit(False)

        aside = batch.where(late | F.col(ts).isNull())
        discard(spark, f"{path}/late/version={batch_id}")
        aside.select(*columns).write.mode("overwrite").parquet(f"{path}/late/version={batch_id}")
        sorted_rows = batch.select(hour.alias("hour"), late.alias("late"), micros.alias("at"))
        folded = sorted_rows.groupBy("hour", "late").agg(F.count("*").alias("n"), F.max("at").alias("newest"))
        folded = folded.persist()
        try:
            n = F.col("n")
            sums = folded.agg(
                F.max("newest").alias("newest"), F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("late"), n)), F.lit(0)).alias("late"),
                F.coalesce(F.sum(F.when(F.col("hour").isNull(), n)), F.lit(0)).alias("untimed")).first()
            counts = {c: notes[c] + sums[c] for c in ("rows", "late", "untimed")}
            counts["on_time"] = counts["rows"] - counts["late"] - counts["untimed"]
            counts["newest"] = max((v for v in (notes["newest"], sums["newest"]) if v is not None), default=None)
            on_time = folded.where("NOT late AND hour IS NOT NULL").select("hour", "n")
            change(spark, path, batch_id, on_time, "hour", _add, notes=lambda: counts)
        finally:
            folded.unpersist()

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or DRAIN)).start()
    )


def accounted_hours(
    spark: SparkSession, path: str, kind: str = "timestamp_ntz", delay: datetime.timedelta = datetime.timedelta(minutes=10)
) -> DataFrame:
    """Hour, rows counted in it, and whether the watermark has closed it."""
    last = newest(spark, path).notes["newest"]
    closed = None if last is None else (last - int(delay / datetime.timedelta(microseconds=1))) // 1000 * 1000
    hours = published(spark, path).withColumn("_at", F.timestamp_micros("hour"))
    return hours.select(
        from_instant("_at", kind).alias("hour"), "n", (F.col("hour") + _HOUR <= F.lit(closed).cast("bigint")).alias("closed"))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their hour was closed, and rows without a time, as they came; ``version`` is the batch."""
    return spark.read.parquet(f"{path}/late").where(F.col("version") <= newest(spark, path).batch)


def row_accounts(spark: SparkSession, path: str) -> DataFrame:
    """One row: all rows so far and how they were sorted; on_time + late + untimed = rows."""
    notes = newest(spark, path).notes
    names = ("rows", "on_time", "late", "untimed")
    return spark.createDataFrame([tuple(int(notes[c]) for c in names)], ", ".join(f"{c} BIGINT" for c in names))
