"""Token-id files: fixed-size blocks of ids, split into byte or bit planes, each compressed.

A file set is a Parquet dataset with one row per block, so that any store Spark
writes to can hold it and a lost task is written again. A row carries the block
(planes, each zstandard-compressed), its entry of the chunk index (shard,
chunk, first id, number of ids) and the documents whose ids it holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.tokens import encoded

#: Ids in a block; only a shard's last block is shorter.
BLOCK_IDS = 65_536
_SCHEMA = ("shard int, chunk int, first_id long, n_ids int, bits boolean, planes array<binary>, "
           "seg_place array<long>, seg_doc array<{kind}>, seg_start array<long>, seg_n array<int>, seg_first array<boolean>, seg_last array<boolean>")


def to_planes(ids: np.ndarray, bits: bool = False, level: int = 1) -> list[bytes]:
    """Planes of unsigned 32-bit ids, lowest first: 4 byte planes, or 32 bit planes."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    columns = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        columns = np.packbits(np.unpackbits(columns, axis=1, bitorder="little"), axis=0, bitorder="little")
    return [squeeze(np.ascontiguousarray(plane).tobytes()) for plane in columns.T]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids that ``to_planes`` split."""
    rows = np.stack([np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8) for p in planes], axis=1)
    if len(planes) == 32:
        rows = np.packbits(np.unpackbits(rows, axis=0, bitorder="little")[:n_ids], axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class _Writer:
    """Cuts a shard's stream of documents into blocks."""

    def __init__(self, shard: int, block: int, bits: bool):
        self.shard, self.block, self.bits = shard, block, bits
        self.chunk = self.written = self.held = self.place = 0
        self.parts: list[bytes] = []
        self.segments: list[tuple] = []
        self.ready: list[dict] = []

    def add(self, doc, ids: bytes) -> None:
        total, done = len(ids) // 4, 0
        while done < total:
            take = min(total - done, self.block - self.held)
            self.parts.append(ids[4 * done:4 * (done + take)])
            self.segments.append((self.place, doc, self.written + self.held, take, done == 0, done + take == total))
            self.held += take
            done += take
            if self.held == self.block:
                self.flush()
        self.place += 1

    def flush(self) -> None:
        if not self.held:
            return
        ids = np.frombuffer(b"".join(self.parts), dtype="<u4")
        row = {"shard": self.shard, "chunk": self.chunk, "first_id": self.written, "n_ids": self.held, "bits": self.bits,
               "planes": to_planes(ids, self.bits)}
        names = ("seg_place", "seg_doc", "seg_start", "seg_n", "seg_first", "seg_last")
        self.ready.append(row | dict(zip(names, map(list, zip(*self.segments)), strict=True)))
        self.written, self.chunk, self.held, self.parts, self.segments = self.written + self.held, self.chunk + 1, 0, [], []


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS,
                      bits: bool = False, partitions: int | None = None) -> None:
    """Write the ids of every document, in ascending doc_id order (nulls first), to ``path``.

    A null or empty text is the end id alone. Equal doc_ids are ordered by text and kept
    apart. An empty table gives a file set without blocks.
    """
    spark = docs.sparkSession
    shards = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, schema = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer, schema = _Writer(batch["shard"][0].as_py(), block_ids, bits), _arrow_schema(batch["doc_id"].type)
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoded((t.as_py() for t in batch["text"]), tokenizer, end_id), strict=True):
                writer.add(doc, ids)
                if len(writer.ready) >= 8:
                    yield pa.RecordBatch.from_pylist(writer.ready, schema=schema)
                    writer.ready = []
        if writer is not None:
            writer.flush()
            if writer.ready:
                yield pa.RecordBatch.from_pylist(writer.ready, schema=schema)

    ordered = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
               .select(F.spark_partition_id().alias("shard"), "doc_id", "text"))
    (ordered.mapInArrow(run, _SCHEMA.format(kind=kind)).write.option("compression", "none").mode("overwrite").parquet(path))


def _arrow_schema(doc: pa.DataType) -> pa.Schema:
    lists = {"seg_place": pa.int64(), "seg_doc": doc, "seg_start": pa.int64(), "seg_n": pa.int32(), "seg_first": pa.bool_(), "seg_last": pa.bool_()}
    return pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("bits", pa.bool_()),
                      ("planes", pa.list_(pa.binary())), *((n, pa.list_(k)) for n, k in lists.items())])


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, first_id, n_ids), first_id counted over the whole file set."""
    blocks = spark.read.parquet(path).select("shard", "chunk", "first_id", "n_ids")
    return blocks.join(F.broadcast(_shard_bases(blocks)), "shard").select(
        "shard", "chunk", (F.col("first_id") + F.col("base")).alias("first_id"), "n_ids")


def _shard_bases(blocks: DataFrame) -> DataFrame:
    """(shard, base): ids ahead of each shard. One row per range partition, so it is small enough to broadcast."""
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select(
        "shard", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("base"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, ids): the ids of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [from_planes(p, n) for p, n in zip(batch["planes"].to_pylist(), batch["n_ids"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["shard"], batch["chunk"], pa.array([x.astype("int64") for x in ids], pa.list_(pa.int64()))], names=["shard", "chunk", "ids"])

    return spark.read.parquet(path).select("shard", "chunk", "n_ids", "planes").mapInArrow(run, "shard int, chunk int, ids array<long>")


def _zero_bytes() -> list[list[int]]:
    """Matrix k moves a CRC-32 over 2**k zero bytes; a row for each bit of the CRC."""
    def squared(rows: list[int]) -> list[int]:
        return [_times(rows, row) for row in rows]

    step = [0xEDB88320, *(1 << i for i in range(31))]  # over one zero bit
    powers = [squared(squared(squared(step)))]
    while len(powers) < 48:
        powers.append(squared(powers[-1]))
    return powers


def _times(rows: list[int], vector: int) -> int:
    total = 0
    for row in rows:
        if vector & 1:
            total ^= row
        vector >>= 1
    return total


_MOVES = _zero_bytes()


def crc_join(first: int, second: int, second_bytes: int) -> int:
    """CRC-32 of two byte strings in a row, from the CRC-32 of each and the second one's length."""
    for k in range(second_bytes.bit_length()):
        if second_bytes >> k & 1:
            first = _times(_MOVES[k], first)
    return first ^ second


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids ahead in the file set. Documents inside one block are
    finished where it is decoded; the few that cross a border are put together from
    the checksums of their parts.
    """
    files = spark.read.parquet(path)
    kind = files.schema["seg_doc"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], [], [], []]
            for row in batch.to_pylist():
                raw, at = from_planes(row["planes"], row["n_ids"]).tobytes(), 0
                for n in row["seg_n"]:
                    columns[5].append(zlib.crc32(raw[at:at + 4 * n]))
                    at += 4 * n
                columns[0] += [row["shard"]] * len(row["seg_n"])
                for k, name in ((1, "seg_place"), (2, "seg_doc"), (3, "seg_start"), (4, "seg_n"), (6, "seg_first"), (7, "seg_last")):
                    columns[k] += row[name]
            doc = batch.schema.field("seg_doc").type.value_type
            kinds = [pa.int32(), pa.int64(), doc, pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            names = ["shard", "place", "doc_id", "start", "n_tokens", "ids_crc32", "first", "last"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, checks = [], []
            for parts in batch["parts"].to_pylist():
                crc = total = 0
                for part in parts:
                    crc, total = crc_join(crc, part["ids_crc32"], 4 * part["n_tokens"]), total + part["n_tokens"]
                totals.append(total)
                checks.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in ("shard", "doc_id", "start")), pa.array(totals, pa.int64()), pa.array(checks, pa.int64())],
                names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    rows = stored(files.select("shard", "n_ids", "planes", "seg_place", "seg_doc", "seg_start", "seg_n", "seg_first", "seg_last").mapInArrow(
        decode, f"shard int, place long, doc_id {kind}, start long, n_tokens long, ids_crc32 long, first boolean, last boolean"))
    inside = F.col("first") & F.col("last")
    # A border has one crossing document at most, and a document as many parts as blocks, 16 bytes each.
    parts = rows.where(~inside).groupBy("shard", "place").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"),
        F.sort_array(F.collect_list(F.struct("start", "n_tokens", "ids_crc32"))).alias("parts"))
    crossing = parts.select("shard", "doc_id", "start", "parts").mapInArrow(
        together, f"shard int, doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    whole = rows.where(inside).select("shard", "doc_id", "start", "n_tokens", "ids_crc32")
    return whole.unionByName(crossing).join(F.broadcast(_shard_bases(files)), "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
