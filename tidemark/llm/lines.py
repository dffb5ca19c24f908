"""Line deduplication with levelled, sorted runs of line hashes.

Documents come in batches. A batch's line hashes become one sorted run, bucketed by
hash: how many documents hold the line, and the largest doc_id that does. Before that
the batch is merge-anti-joined with the runs: an entry that a run already holds often
enough, under a doc_id as large, adds nothing and is not written. Two runs of a level
are merged into one of the next, bucket by bucket.

A line's hash is the md5 of its key. Two of 1e12 different keys share one with a
probability below 1e-14.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from tidemark.functions.session import discard, fresh_dir, stored
from tidemark.llm.text import text_key

#: Blanks cut off at both ends of a line (fixed value).
BLANKS = b" \t\n\x0b\x0c\r"
#: Entries that one bucket of a run should hold.
BUCKET_ROWS = 2_000_000
#: Texts handed to Python at a time. A batch of line rows is written out after each.
TEXTS = 256


def line_key(line: bytes) -> bytes:
    """The line without blanks at both ends, A to Z in lower case."""
    return line.strip(BLANKS).lower()  # bytes.lower changes A to Z only


def _places(text: bytes, least: int) -> dict[bytes, list[int]]:
    """Line numbers of every key of at least ``least`` code points."""
    places: dict[bytes, list[int]] = {}
    for at, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least):
            places.setdefault(key, []).append(at)
    return places


def line_table(docs: DataFrame, least: int = 20) -> DataFrame:
    """(doc_id, text, line, at): per document row and different key, its hash and its line numbers."""
    kind = docs.schema["doc_id"].dataType
    slim = docs.select("doc_id", text_key(F.col("text")).alias("text"), F.col("text").cast("string").cast("binary").alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                row, line, at = [], [], []
                for i, body in enumerate(batch.column(2)):
                    for key, places in _places(body.as_py() or b"", least).items():
                        row.append(i)
                        line.append(hashlib.md5(key).digest())
                        at.append(places)
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(line, pa.binary()), pa.array(at, pa.list_(pa.int32()))],
                    ["doc_id", "text", "line", "at"])

    return slim.mapInArrow(cut, T.StructType([
        T.StructField("doc_id", kind), T.StructField("text", T.BinaryType()), T.StructField("line", T.BinaryType()),
        T.StructField("at", T.ArrayType(T.IntegerType()))]))


class Runs:
    """Sorted runs of (line, n, top) in levels: ``n`` documents hold the line, ``top`` is the largest doc_id of them.

    A run is a table bucketed and sorted by line, so that merging two runs joins bucket with
    bucket and moves no row. ``settled`` is the count from which a line's exact count no longer matters.
    """

    def __init__(self, spark: SparkSession, buckets: int = 8, settled: int = 3):
        self.spark, self.buckets, self.settled = spark, buckets, settled
        self.levels: list[list[str]] = []
        self.folder = fresh_dir(spark, "line-runs")

    def _write(self, entries: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (entries.sortWithinPartitions("line").write.format("parquet")
         .bucketBy(self.buckets, "line").sortBy("line").option("path", f"{self.folder}/{name}").saveAsTable(name))
        while level >= len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)

    def _merge(self, first: str, second: str, level: int) -> None:
        """Write the two runs as one of ``level`` and remove them."""
        a, b = (self.spark.table(name).toDF(f"line_{i}", f"n_{i}", f"top_{i}") for i, name in enumerate((first, second)))
        both = a.join(b, F.col("line_0") == F.col("line_1"), "full")
        self._write(both.select(
            F.coalesce("line_0", "line_1").alias("line"), (F.coalesce("n_0", F.lit(0)) + F.coalesce("n_1", F.lit(0))).alias("n"),
            F.when(F.col("top_1").isNull() | (F.col("top_0") >= F.col("top_1")), F.col("top_0")).otherwise(F.col("top_1")).alias("top")), level)
        for name in (first, second):
            self._remove(name)

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, f"{self.folder}/{name}")

    def add(self, batch: DataFrame) -> None:
        """Add the (line, doc_id) rows of documents that no earlier batch held, one row per document and line."""
        own = batch.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")).repartition(self.buckets, "line")
        for name in [n for level in self.levels for n in level]:
            held = self.spark.table(name).where(F.col("n") >= self.settled).select(F.col("line").alias("held"), F.col("top").alias("known"))
            own = own.join(held, (F.col("line") == F.col("held")) & (F.col("top").isNull() | (F.col("known") >= F.col("top"))), "left_anti")
        self._write(own, 0)
        self.compact()

    def compact(self) -> None:
        """Merge the runs of every level that has two into one run of the next, lowest level first."""
        for level, names in enumerate(self.levels):  # a level that this adds is visited too
            if len(names) == 2:
                self.levels[level] = []
                self._merge(*names, level + 1)

    def entries(self) -> DataFrame:
        """All runs, merged into one: every line's count, exact below ``settled`` and at least that otherwise, and its top."""
        while len(names := [n for level in self.levels for n in level]) > 1:
            self.levels = [[n] for n in names[2:]]
            self._merge(*names[:2], len(self.levels))
        return self.spark.table(names[0])

    def drop(self) -> None:
        """Remove all runs."""
        for name in [n for level in self.levels for n in level]:
            self._remove(name)
        self.levels = []
        discard(self.spark, self.folder)


def repeated_lines(lines: DataFrame, batches: int = 4, documents: int = 3) -> DataFrame:
    """(line, top) of every line that at least ``documents`` rows of ``line_table`` hold, stored.

    The batches are taken by a hash of doc_id and text; the result does not depend on their number.
    """
    spark = lines.sparkSession
    runs = Runs(spark, max(1, -(-lines.count() // BUCKET_ROWS)), settled=documents)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    for b in range(batches):
        runs.add(lines.where(share == b).select("line", "doc_id"))
    often = stored(runs.entries().where(F.col("n") >= documents).select("line", "top"))
    runs.drop()
    return often


def drop_repeated_lines(docs: DataFrame, least: int = 20, documents: int = 3, batches: int = 4) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every row: lines found in ``documents`` documents stay in the last only.

    A line's key is the line without blanks at both ends and in lower case (A to Z); keys under
    ``least`` code points always stay. The last document is the one with the largest doc_id.

    Every row is a document, so repeated rows count each, and all rows that share the largest
    doc_id keep the line. A null doc_id is below all others; lines found under null ids only stay.
    Null text is empty, which is one empty line. A very long text is split in one task. doc_id may have any
    type with an order. Other columns are not read, so their names cannot clash.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = stored(line_table(docs, least))
    often = repeated_lines(lines, batches, documents)
    hits = (lines.join(often, "line").where(~F.col("doc_id").eqNullSafe(F.col("top")))
            .groupBy(F.col("doc_id").alias("hit_id"), F.col("text").alias("hit_text")).agg(F.flatten(F.collect_set("at")).alias("gone")))
    parts = docs.select("doc_id", text_key(F.col("text")).alias("text"), F.split("text", "\n").alias("parts"))
    joined = parts.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text") == F.col("hit_text")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    return joined.select(
        "doc_id", F.size("parts").cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.array_join("parts", "\n")).otherwise(
            F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n")).alias("kept"))
