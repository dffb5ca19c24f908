"""Intake with admission control, retries inside the stream and dead letters."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.streaming.keyed import rocksdb
from tidemark.streaming.tables import append_to

Attempt = Callable[[pd.DataFrame, int], pd.DataFrame]
#: Groups that items are dealt to by hash. Each has one timer and keeps its own waiting items.
SLOTS = 256


class _Attempts(StatefulProcessor):
    """Attempts of one slot's items. State: packets of items that wait, with their next attempt and when it is due."""

    def __init__(self, attempt: Attempt, columns: list[str], max_attempts: int, wait_ms: int):
        self.attempt, self.columns, self.max_attempts, self.wait_ms = attempt, columns, max_attempts, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "due LONG, attempt INT, items BINARY")

    def _try(self, items: pd.DataFrame, attempt: int, now: int) -> tuple[pd.DataFrame, tuple | None]:
        """Finished items, and a packet of those to try again."""
        items = items.reset_index(drop=True)
        tried = self.attempt(items[self.columns], attempt)
        tried["ok"] = tried["ok"].fillna(False).astype(bool)
        again = ~tried["ok"].to_numpy() & (attempt < self.max_attempts)
        packet = None
        if again.any():
            table = pa.Table.from_pandas(items.loc[again, self.columns], preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            # Always ahead of now: a timer set for the moment that is being handled would go with it.
            packet = (now + max(self.wait_ms, 1) * 2 ** (attempt - 1), attempt + 1, sink.getvalue().to_pybytes())
        return tried[~again].assign(attempt=attempt), packet

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        finished, packet = self._try(pd.concat(list(rows)), 1, now)
        if packet:
            self.waiting.appendValue(packet)
            self.handle.registerTimer(packet[0])
        yield finished

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentProcessingTimeInMs()
        left, out = [], []
        for due, attempt, items in list(self.waiting.get()):
            if due > now:  # has a timer of its own
                left.append((due, attempt, items))
                continue
            finished, packet = self._try(pa.ipc.open_stream(items).read_all().to_pandas(), attempt, now)
            out.append(finished)
            if packet:
                left.append(packet)
                self.handle.registerTimer(packet[0])
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        yield from out

    def close(self) -> None:
        pass


def ingest(
    stream: DataFrame,
    attempt: Attempt,
    result: str,
    path: str,
    max_attempts: int = 3,
    wait_ms: int = 1000,
    slots: int = SLOTS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Try every item; try those that fail again, each time after twice the wait; set aside what never works.

    ``attempt(items, k)`` makes the k-th attempt on a pandas frame of items, for example a request for
    each; it returns the frame with the columns of ``result`` and a boolean ``ok``. How much a batch admits is bounded by
    the reader (``max_files`` of ``read_log_stream``). Items that fail wait in the query's state store and timers
    bring them back, also when nothing new arrives. Finished items are appended to ``<path>/outcomes``.

    An item is written once: when it worked, or after its last attempt. Stopped or lost queries go on from the
    last commit with all attempts counted; a batch that was cut off is attempted again as a whole. The query runs
    until it is stopped; ``keyed.drain`` stops it when all items are finished.
    """
    columns = stream.columns
    schema = T.StructType([
        *stream.schema.fields, *T.StructType.fromDDL(result).fields,
        T.StructField("ok", T.BooleanType()), T.StructField("attempt", T.IntegerType())])
    slot = "_" + "_".join(columns)  # longer than, so unlike any of them
    outcomes = stream.withColumn(slot, F.pmod(F.xxhash64(*columns), F.lit(slots))).groupBy(slot).transformWithStateInPandas(
        _Attempts(attempt, columns, max_attempts, wait_ms), schema, "append", "processingTime")
    with rocksdb(stream.sparkSession):
        return append_to(outcomes, path, trigger or {"processingTime": "0 seconds"}, "outcomes")


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """Items that worked, with the attempt that did."""
    return spark.read.parquet(f"{path}/outcomes").where("ok").drop("ok")


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Items that failed every attempt."""
    return spark.read.parquet(f"{path}/outcomes").where("not ok").drop("ok")
