"""Tables that a stream changes a part at a time, published by manifest.

Rows lie in buckets by a hash of their key. A batch rewrites only the buckets whose keys
it touches, into a folder of its own, and then publishes a manifest: a small file, made
visible by one rename, that names the folder of every bucket. Readers follow the newest
manifest, so a crash between writing and publishing leaves the version before it whole.
A batch that is run again after its manifest was published changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.session import discard, scratch, stored


@dataclass(frozen=True)
class Manifest:
    """What a version consists of; ``notes`` are a few numbers that go with it."""

    batch: int
    schema: str
    parts: dict[str, int]
    notes: dict


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def newest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest that readers follow; None before the first."""
    place, store = _folder(spark, f"{path}/manifests")
    if not store.exists(place):
        return None
    names = [f.getPath().getName() for f in store.listStatus(place)]
    numbers = [int(name) for name in names if name.isdigit()]
    return _manifest(spark, path, max(numbers)) if numbers else None


def _manifest(spark: SparkSession, path: str, number: int) -> Manifest:
    place, store = _folder(spark, f"{path}/manifests/{number}")
    source = store.open(place)
    try:
        return Manifest(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")))
    finally:
        source.close()


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a version the newest one: write its manifest aside, then rename it."""
    place, store = _folder(spark, f"{path}/manifests/{manifest.batch}")
    aside, _ = _folder(spark, f"{path}/manifests/{manifest.batch}.part")
    out = store.create(aside, True)
    try:
        out.write(bytearray(json.dumps(manifest.__dict__).encode()))
    finally:
        out.close()
    if not store.rename(aside, place):
        raise OSError(f"could not publish {path} version {manifest.batch}")


def _read(spark: SparkSession, path: str, manifest: Manifest, buckets: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(manifest.schema))
    chosen = manifest.parts if buckets is None else [b for b in buckets if b in manifest.parts]
    files = [f"{path}/data/version={manifest.parts[b]}/_bucket={b}" for b in chosen]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest published version."""
    manifest = newest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return _read(spark, path, manifest)


def change(
    spark: SparkSession,
    path: str,
    batch_id: int,
    changes: DataFrame,
    key: str,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = 16,
    notes: Callable[[], dict] = dict,
) -> None:
    """Publish ``combine(rows there, changes)`` for the buckets that ``changes`` touch.

    Work follows those buckets, not the whole table. The version before the new one
    stays for readers that have begun; folders that neither uses are removed.
    """
    before = newest(spark, path)
    if before is not None and before.batch >= batch_id:
        return
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    with scratch(spark):
        new = stored(changes)
        touched = [str(r[0]) for r in new.select(bucket).distinct().collect()]  # at most ``buckets``
        there = _read(spark, path, before, touched) if before else spark.createDataFrame([], new.schema)
        if touched:
            rows = combine(there, new).withColumn("_bucket", bucket)
            rows.repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
                f"{path}/data/version={batch_id}")
        parts = (before.parts if before else {}) | {b: batch_id for b in touched}
        publish(spark, path, Manifest(batch_id, new.schema.json(), parts, notes()))
    if before is not None:
        _forget(spark, path, before, parts)


def _forget(spark: SparkSession, path: str, before: Manifest, parts: dict[str, int]) -> None:
    """Remove what only versions older than ``before`` used."""
    place, store = _folder(spark, f"{path}/manifests")
    numbers = [int(n) for f in store.listStatus(place) if (n := f.getPath().getName()).isdigit()]
    used = {*before.parts.values(), *parts.values()}
    for number in sorted(n for n in numbers if n < before.batch):
        for b, version in _manifest(spark, path, number).parts.items():
            if version not in used:
                discard(spark, f"{path}/data/version={version}")
            elif version not in (before.parts.get(b), parts.get(b)):
                discard(spark, f"{path}/data/version={version}/_bucket={b}")
        discard(spark, f"{path}/manifests/{number}")


def replace_by(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Combine for changes that hold whole new rows: they take the place of the key's old one."""
    def combine(there: DataFrame, new: DataFrame) -> DataFrame:
        kept = there.join(new.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        return kept.unionByName(new)
    return combine
