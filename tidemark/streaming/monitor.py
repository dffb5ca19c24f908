"""The rolling error monitor on a stream, in two forms.

``stream_monitor_by_key`` keeps each key's window in a state store: its cost follows the
batch. In ``stream_monitor`` each micro-batch runs the batch operators over its own rows plus the last rows of
every key from the batch before. A key of any weight is thus spread over tasks,
which a state store keyed by that key could not do.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.session import scratch
from tidemark.operators.joins import null_safe_join
from tidemark.operators.rolling import CHUNK_ROWS, rolling_alerts, rolling_error_rate
from tidemark.streaming.keyed import rocksdb
from tidemark.streaming.tables import DRAIN, append_to


def stream_monitor(
    stream: DataFrame,
    path: str,
    error: Column,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    n: int = 300,
    threshold: float = 0.12,
    cooldown: int = 300,
    trigger: dict | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> StreamingQuery:
    """Write alerts to ``<path>/alerts`` while rows flow in.

    Within a batch rows are taken in ``order_by`` order; batches follow each other as
    they arrive. State is the last n-1 rows of every key and the distance to its last alert, while that
    is within the cool-down. Tables that a batch needs in between are removed when it ends.
    Batches write it to two folders in turn, so a replayed batch finds the state it
    started from and old state does not pile up.
    """
    keys, order_by = list(keys), list(order_by)
    columns = list(dict.fromkeys([*keys, *order_by, *keep]))

    def step(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            advance(batch, batch_id)

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, after = f"{path}/state/{(batch_id + 1) % 2}", f"{path}/state/{batch_id % 2}"
        rows = batch.select(*columns, F.coalesce(error, F.lit(False)).alias("error"), F.lit(True).alias("fresh"))
        if batch_id > 0:
            tail = spark.read.schema(rows.schema).parquet(f"{before}/tail")
            rows = rows.unionByName(tail.withColumn("fresh", F.lit(False)))
        rates = rolling_error_rate(
            rows, F.col("error"), ["fresh", *order_by], n, keys,
            [*columns, "error"], chunk_rows,
        )
        ends = rates.groupBy(*keys).agg(
            F.max("rn").alias("end"), F.max(F.when(~F.col("fresh"), F.col("rn"))).alias("tail_end")
        )
        carried = None
        if batch_id > 0:
            last = spark.read.schema(
                T.StructType([*[rows.schema[k] for k in keys], T.StructField("since", T.LongType())])
            ).parquet(f"{before}/last")
            joined = null_safe_join(last, ends, keys) if keys else last.withColumn(
                "tail_end", ends.agg(F.max("tail_end")).scalar())
            carried = joined.select(*keys, (F.col("tail_end") - F.col("since")).alias("rn"))
        raised = rolling_alerts(
            rates.where("fresh"), n, threshold, cooldown, keys, last_alerts=carried
        ).drop("fresh", "error")
        raised.write.mode("overwrite").parquet(f"{path}/alerts/batch={batch_id}")

        fired = spark.read.schema(raised.schema).parquet(f"{path}/alerts/batch={batch_id}").select(*keys, "rn")
        if carried is not None:
            fired = fired.unionByName(carried)
        fired = fired.groupBy(*keys).agg(F.max("rn").alias("rn"))
        reach = max(n - 1, 1)  # one row is kept even for n = 1, to place the last alert
        if keys:
            since = null_safe_join(fired, ends, keys)
            tail = null_safe_join(rates, ends.drop("tail_end"), keys)
        else:
            end = ends.agg(F.max("end")).scalar()
            since, tail = fired.withColumn("end", end), rates.withColumn("end", end)
        # An alert further back than the cool-down silences nothing any more.
        since.where(F.col("end") - F.col("rn") < cooldown).select(
            *keys, (F.col("end") - F.col("rn")).alias("since")
        ).write.mode("overwrite").parquet(f"{after}/last")
        tail.where(F.col("rn") > F.col("end") - reach).select(*rows.columns).write.mode(
            "overwrite").parquet(f"{after}/tail")

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**(trigger or DRAIN)).start()
    )


def monitor_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts raised so far. ``rn`` is the position within the batch's own numbering."""
    return spark.read.parquet(f"{path}/alerts")


class _KeyMonitor(StatefulProcessor):
    """One key's window and cool-down. State: the last n-1 flags, packed, and how many rows ago the last alert was."""

    def __init__(self, columns: list[str], order_by: list[str], n: int, threshold: float, cooldown: int, idle_ms: int | None):
        self.columns, self.order_by, self.n, self.threshold, self.cooldown, self.idle_ms = columns, order_by, n, threshold, cooldown, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", "flags BINARY, filled INT, since LONG", self.idle_ms)

    def handleInputRows(self, key, rows, timerValues):
        fresh = pd.concat(list(rows)).sort_values(self.order_by, kind="stable")
        packed, filled, since = self.state.get() if self.state.exists() else (b"", 0, self.cooldown)
        tail = np.unpackbits(np.frombuffer(packed, np.uint8), count=filled)
        flags = np.concatenate([tail, fresh["is_error"].to_numpy(np.uint8)])
        before = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        at = np.arange(filled + 1, len(flags) + 1)
        errors = before[at] - before[np.maximum(at - self.n, 0)]
        rate = errors / np.minimum(at, self.n)
        breaches = np.flatnonzero((at >= self.n) & (rate > self.threshold))
        fired, free = [], self.cooldown - since - 1  # place in this batch that may alert again
        while (i := np.searchsorted(breaches, free)) < len(breaches):
            fired.append(int(breaches[i]))
            free = fired[-1] + self.cooldown
        since = min(len(fresh) - 1 - fired[-1] if fired else since + len(fresh), self.cooldown)
        tail = flags[len(flags) - min(len(flags), self.n - 1):]
        self.state.update((np.packbits(tail).tobytes(), len(tail), int(since)))
        yield fresh.iloc[fired][self.columns].assign(window_errors=errors[fired], error_rate=rate[fired])

    def close(self) -> None:
        pass


def stream_monitor_by_key(
    stream: DataFrame,
    path: str,
    error: Column,
    order_by: Sequence[str],
    keys: Sequence[str],
    keep: Sequence[str] = (),
    n: int = 300,
    threshold: float = 0.12,
    cooldown: int = 300,
    idle_ms: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The monitor for many keys: append alerts to ``<path>/alerts``, with keyed state in RocksDB.

    A batch reads and writes the state of the keys that are in it, some 50 bytes each for ``n`` = 300, however
    many keys there were before. Rows of a batch are taken in ``order_by`` order; batches follow each other as they
    arrive. After a restart the query goes on from its last commit and no alert is written twice.

    ``idle_ms`` forgets keys that were quiet for so long; such a query runs until it is stopped, as its
    state must go on ageing (give a ``processingTime`` trigger). A batch's rows of one key go through one task, so
    bound the intake (``max_files`` of ``read_log_stream``), or use ``stream_monitor`` where one key has most rows.
    """
    keys, order_by = list(keys), list(order_by)
    columns = list(dict.fromkeys([*keys, *order_by, *keep]))
    rows = stream.select(*columns, F.coalesce(error, F.lit(False)).alias("is_error"))
    schema = T.StructType([
        *[rows.schema[c] for c in columns], T.StructField("window_errors", T.LongType()), T.StructField("error_rate", T.DoubleType())])
    alerts = rows.groupBy(*keys).transformWithStateInPandas(
        _KeyMonitor(columns, order_by, n, threshold, cooldown, idle_ms), schema, "append", "none" if idle_ms is None else "processingTime")
    with rocksdb(stream.sparkSession):
        return append_to(alerts, path, trigger, "alerts")
