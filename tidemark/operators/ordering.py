"""Positions and running totals over a whole table.

A window without ``partitionBy`` would pull every row into one task. Here rows
are range-partitioned and sorted, written once, and each partition's offset is
added from a table that has one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from tidemark.functions.session import stored

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in its low bits


def _spread(df: DataFrame, order_by: Sequence[Column], sums: Sequence[str] = ()) -> DataFrame:
    """Rows in global order, with their partition ``_part`` and place ``_place`` in it,
    and for each of ``sums`` the ``_<column>_inside`` sum of the partition's earlier rows."""
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    if sums:
        placed = placed.mapInArrow(_earlier_sums(sums), T.StructType([
            *df.schema.fields,
            *[T.StructField(f"_{c}_inside", df.schema[c].dataType) for c in sums],
        ]))
    return stored(placed.withColumn("_mid", F.monotonically_increasing_id())).select(
        *placed.columns,
        F.shiftright("_mid", _INDEX_BITS).alias("_part"),
        F.col("_mid").bitwiseAND((1 << _INDEX_BITS) - 1).alias("_place"),
    )


def _earlier_sums(columns: Sequence[str]):
    """Batch by batch, the sum of each column over the partition's rows so far."""
    def add(batches):
        carried = dict.fromkeys(columns, 0)
        for batch in batches:
            for c in columns:
                values = pc.fill_null(batch.column(c), 0)
                inside = pc.add(pc.subtract(pc.cumulative_sum(values), values), carried[c])
                carried[c] += pc.sum(values).as_py() or 0
                batch = batch.append_column(f"_{c}_inside", inside)
            yield batch

    return add


def _offsets(per_part: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Totals of all earlier partitions. One row per range partition, so it is
    bounded by the shuffle partition count and safe to broadcast."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        per_part.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums])
    )


def number_rows(df: DataFrame, order_by: Sequence[Column], name: str = "rn") -> DataFrame:
    """Add each row's 1-based position in the global order. ``order_by`` must be unique."""
    placed = _spread(df, order_by)
    starts = _offsets(placed.groupBy("_part").agg((F.max("_place") + 1).alias("_start")), ["_start"])
    return placed.join(starts, "_part").select(
        *df.columns, (F.col("_start") + F.col("_place") + 1).alias(name)
    )


def running_totals(df: DataFrame, order_by: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Add ``<column>_before``: the sum over all rows that come earlier in the
    global order. ``order_by`` must be unique and ``sums`` long or double."""
    placed = _spread(df, order_by, sums)
    starts = _offsets(
        placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}_start") for c in sums]),
        [f"_{c}_start" for c in sums],
    )
    return placed.join(starts, "_part").select(
        *df.columns,
        *[(F.col(f"_{c}_start") + F.col(f"_{c}_inside")).alias(f"{c}_before") for c in sums],
    )
