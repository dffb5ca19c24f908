"""Shared storage for intermediate tables.

Long jobs cut their lineage with tables written to shared storage, so a lost
executor costs a re-read and not a re-run. The folder is the one the cluster names
in ``spark.checkpoint.dir``; a local folder is made only where none is named.
A job that runs for long wraps its steps in ``scratch`` to have their tables removed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder for checkpoints and intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if named is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Folders that the current ``scratch`` block will remove.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a Parquet table in the shared folder and read back.

    For several passes over a few columns of a costly input, and where later steps
    rely on all reads seeing the same rows: range partitioning samples its bounds
    anew on each run.
    """
    path = fresh_dir(df.sparkSession, "stored")
    if (made := _SCRATCH.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query inside the block go when it ends, not when the driver happens to
    collect its garbage. A DataFrame that runs twice shuffles anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store it is in; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``stored`` writes inside the block when it ends. Results
    must be written out before that."""
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        for path in _SCRATCH.get():
            discard(spark, path)
        _SCRATCH.reset(token)
