"""Every row's successor in a global order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored


def _bucket(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` lie below ``value`` (null: 0); looks at about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*(F.lit(g[-1]) for g in groups))
    whole = F.size(F.filter(heads, lambda b: b < value))
    part = F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), whole)
    return F.when(value.isNull(), 0).otherwise(whole * step + F.coalesce(F.size(F.filter(part, lambda b: b < value)), F.lit(0)))


def descending(rows: DataFrame, key: str, *ties: str, partitions: int | None = None) -> DataFrame:
    """``rows`` range-partitioned by falling ``key`` (nulls last), with ``_bucket`` and ``_halo``, sorted in each partition.

    Buckets are cut at quantiles of the key. Each bucket is followed by one more copy of the row after
    its last one (``_halo`` true), the first row of all for the last bucket, so that a task that reads a
    bucket in order meets every row's successor. Ties fall by the ``ties`` columns.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    bounds = sorted(set(cuts or []))
    bucketed = rows.withColumn("_bucket", _bucket(F.col(key), bounds))
    # One row for each bucket: its highest key, which the bucket above it also gets.
    tops = stored(rows.select(key, _bucket(F.col(key), bounds).alias("_bucket")).groupBy("_bucket").agg(F.max(key).alias("_top")))
    order = sorted((r["_bucket"] for r in tops.select("_bucket").collect()), reverse=True)
    above = [(b, order[i - 1]) for i, b in enumerate(order)]  # the highest bucket wraps round to the lowest
    if not above:
        return bucketed.withColumn("_halo", F.lit(False))
    to = F.create_map(*(F.lit(x) for pair in above for x in pair))
    heads = tops.select("_bucket", "_top", to[F.col("_bucket")].alias("_to"))
    copied = bucketed.join(F.broadcast(heads), "_bucket").withColumn("_goes", F.when(
        F.col(key).eqNullSafe(F.col("_top")), F.array(
            F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("h")), F.struct(F.col("_to").alias("b"), F.lit(True).alias("h"))))
        .otherwise(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("h")))))
    dealt = copied.withColumn("_go", F.explode("_goes")).withColumns({"_bucket": F.col("_go.b"), "_halo": F.col("_go.h")}).drop("_goes", "_go", "_top", "_to")
    return dealt.repartition(n, "_bucket").sortWithinPartitions(
        "_bucket", "_halo", F.desc_nulls_last(key), *(F.asc_nulls_first(t) for t in ties))


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """(row, its successor) for every row of the buckets in a partition of ``descending``."""
    before: dict | None = None
    closed = False
    for batch in batches:
        for row in batch.to_pylist():
            if before is not None and row["_bucket"] == before["_bucket"] and not closed:
                yield before, row
            if before is None or row["_bucket"] != before["_bucket"]:
                closed = False
            closed = closed or row["_halo"]
            before = row
