"""Keyed state on a stream: settings that its queries share."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which writes per batch what has changed.

    A query copies the setting when it starts; the session gets its own back.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def drain(query: StreamingQuery, timeout: float = 3600.0) -> None:
    """Wait until a query with timers has read all its input and holds no state any more, then stop it.

    A trigger that ends by itself would leave the timers or, as such a query always has a next batch, never
    end. Two quiet batches in a row are needed: the first after a restart may repeat one that had no input.
    """
    until, quiet = time.monotonic() + timeout, None
    while query.isActive:
        done = query.lastProgress
        if done and (done.numInputRows or query.status["isDataAvailable"] or any(op.numRowsTotal for op in done.stateOperators)):
            quiet = None
        elif done and quiet is None:
            quiet = done.batchId
        elif done and done.batchId > quiet:
            break
        if time.monotonic() > until:
            query.stop()
            raise TimeoutError("stream did not finish in time")
        time.sleep(0.1)
    query.stop()
    if query.exception():
        raise query.exception()
