"""Best-fit packing of pieces into sequences, by hierarchical residual packing.

Every partition packs its own pieces best-fit in falling order of length. Bins
that nothing left could fit into are finished. The others become items of the
next round, on a fraction of the partitions, until one task has packed all that
is left. Only lengths travel; tokens stay where they are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.session import stored
from tidemark.llm.tokens import encoded

#: Each round has this fraction of the partitions of the one before.
FAN_IN = 4
#: Items that one task may pack; more items keep more partitions.
TASK_ITEMS = 1_000_000
#: A round on several partitions that closes less than this share of the bins is the last of its kind.
LEAST_GAIN = 0.01
_ROW_BITS = 36


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item: falling length, each into the fullest bin that holds it."""
    placed = [(0, 0)] * len(lengths)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some open bin has r places left
    bins = 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[i]
        fits = rooms >> size
        if fits:
            room = (fits & -fits).bit_length() - 1 + size
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            place, room, bins = bins, capacity, bins + 1
        placed[i] = (place, capacity - room)
        by_room[room - size].append(place)
        rooms |= 1 << (room - size)
    return placed


def _packed(items: DataFrame, level: int, capacity: int, task_items: int) -> DataFrame:
    """Items with the bin of this level and the offset in it; up to ``task_items`` of a partition are packed together.

    Bin ids hold the level, the partition and a number, so they are unique in a run.
    """
    fields = [f for f in items.schema.fields if f.name not in ("bin", "offset")]
    schema = T.StructType([*fields, T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType())])
    shift = level << 56

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows = (TaskContext.get().partitionId() << _ROW_BITS) + shift, [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                rows += batch.num_rows
            if rows and (batch is None or rows >= task_items):
                table = pa.Table.from_batches(held)
                placed = best_fit(table["length"].to_pylist(), capacity)
                table = table.append_column("bin", pa.array([first + b for b, _ in placed], pa.int64()))
                table = table.append_column("offset", pa.array([o for _, o in placed], pa.int64()))
                yield from table.to_batches(max_chunksize=100_000)
                first, held, rows = first + 1 + max(b for b, _ in placed), [], 0

    return items.mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = 4096, fan_in: int = FAN_IN, task_items: int = TASK_ITEMS) -> DataFrame:
    """``items`` (a column ``length``, any others) with ``sequence_id`` and ``offset``.

    The items of a sequence fill places 0 up to the sum of their lengths without gaps.
    Equal rows are separate items. Rows whose length is null or below 1 get null
    for both; a length above ``capacity`` is an error, as only the caller can cut an
    item. No items: no rows. Columns named ``sequence_id``, ``offset`` or ``bin`` are replaced.
    """
    items = stored(items.drop("sequence_id", "offset", "bin"))
    checked = items.where(F.col("length") >= 1).withColumn(
        "length", F.when(F.col("length") > capacity, F.raise_error(F.lit(f"an item is longer than {capacity}")))
        .otherwise(F.col("length")))
    placed = stored(_packed(checked, 0, capacity, task_items))
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = placed.groupBy("bin").agg(F.sum("length").alias("length"))
    moves: list[DataFrame] = []
    while True:
        bins = stored(bins)
        smallest = bins.agg(F.min("length")).first()[0]
        if smallest is None:
            break
        # The smallest bin itself stays only if a second one could join it.
        left = bins.where(F.col("length") + F.lit(smallest) <= capacity)
        count = left.count()
        if count < 2:
            break
        level = len(moves) + 1
        needed = math.ceil(count / task_items)
        parts = max(1, math.ceil(parts / fan_in), needed)
        dealt = left.select(F.col("bin").alias("child"), "length").repartition(parts, F.xxhash64("child", F.lit(level)))
        move = stored(_packed(dealt, level, capacity, task_items))
        moves.append(move)
        bins = move.groupBy("bin").agg(F.sum("length").alias("length"))
        if parts == 1 or parts == needed and _gain(move, count) < LEAST_GAIN:
            break
    for move in moves:
        step = move.select(F.col("child").alias("bin"), F.col("bin").alias("_to"), F.col("offset").alias("_by"))
        placed = placed.join(step, "bin", "left").withColumns({
            "bin": F.coalesce("_to", "bin"), "offset": F.col("offset") + F.coalesce("_by", F.lit(0))}).drop("_to", "_by")
    unplaced = items.where(~F.coalesce(F.col("length") >= 1, F.lit(False)))
    return placed.withColumnRenamed("bin", "sequence_id").unionByName(
        unplaced.withColumn("sequence_id", F.lit(None).cast("long")).withColumn("offset", F.lit(None).cast("long")))


def _gain(move: DataFrame, count: int) -> float:
    """Share of the bins of a round that it emptied into others."""
    return 1 - move.select("bin").distinct().count() / count


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, cut at ``capacity``.

    A null or empty text has the end id alone. Rows that repeat a document repeat its pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch["doc_id"], encoded((t.as_py() for t in batch["text"]), tokenizer, end_id), strict=True):
                width, key = 4 * capacity, doc.as_py()
                out += [(key, at // width, at // 4, len(cut) // 4, zlib.crc32(cut))
                        for at in range(0, len(ids), width) if (cut := ids[at:at + width])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, pieces joined in order of their offset.

    ``docs`` needs one row per doc_id. A group holds at most ``capacity`` ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [memoryview(x).cast("I").tolist() for x in encoded((t.as_py() for t in batch["text"]), tokenizer, end_id)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<long>")
    cut = placed.where(F.col("sequence_id").isNotNull()).join(coded, "doc_id").select(
        "sequence_id", "offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids"))
    return cut.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
