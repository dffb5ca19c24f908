"""SimHash fingerprints and their near-duplicate classes, found with Burkhard-Keller trees.

Distinct fingerprints are dealt to shards so that any two within the radius meet
in one: with the 64 bits cut into blocks, two fingerprints that differ in r bits
agree on all but r blocks. Each shard grows a tree whose children are keyed by
their Hamming distance to the parent, and a search follows only the edges
within the radius. Trees travel by shuffle, not by broadcast: together they
grow with the data. A shard with more values than one task should hold is split
in the same way by the bits that its members need not agree on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.graph import components
from tidemark.llm.text import free_name, text_key

SEED = 42
#: Blocks beyond the radius that a shard's fingerprints agree on; 4 leave about 21 free bits.
AGREE = 4
#: Fingerprints that one tree holds; a shard with more is dealt to finer ones, on 2 blocks more than the radius of its free bits.
SHARD_VALUES = 4096


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bitwise majority (over half) of the XXH64 of the text's word shingles; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    if len(words) > width:
        starts, stops = starts[:len(words) - width + 1], stops[width - 1:]
    else:
        starts, stops = starts[:1], stops[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):  # long texts in steps, as a hash takes 64 bytes here
        counts += np.unpackbits(hashes[at:at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every text as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


class BKTree:
    """Burkhard-Keller tree over 64-bit integers; children are keyed by distance to their parent."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def near(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            node, children = todo.pop()
            far = (node ^ value).bit_count()
            if far <= radius:
                found.append(node)
            if children:
                todo += [children[d] for d in range(far - radius, far + radius + 1) if d in children]
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node, children = self.root
        while far := (node ^ value).bit_count():
            if far not in children:
                children[far] = (value, {})
                return
            node, children = children[far]


def _shard_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """One link per value at most, joining the classes within one shard."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in values:
        parent[value] = value
        for other in tree.near(value, radius):
            parent[find(value)] = find(other)
        tree.add(value)
    for value in values:
        if (root := find(value)) != value:
            yield value, root


def _finer(mask: int, radius: int, agree: int) -> list[int]:
    """Masks of the bits that shards agree on: those of ``mask``, and all but ``radius`` of the blocks that the others are cut into."""
    free = [k for k in range(64) if not mask >> k & 1]
    blocks = radius + agree
    edges = [round(i * len(free) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << k for k in free[a:b]) for a, b in zip(edges, edges[1:])]
    return sorted({(1 << 64) - 1 - sum(chosen) for chosen in combinations(parts, radius)})


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Shards:
    """Links of shards whose values arrive in order; values of shards with more than ``most`` are handed on instead.

    Values that agree on all but ``radius`` bits cannot be split further; they are 2 ** radius at most.
    """

    def __init__(self, radius: int, most: int):
        self.radius, self.most = radius, most
        self.key, self.values, self.wide = None, np.zeros(0, np.int64), False
        self.found: list[tuple[int, int]] = []
        self.handed: list[tuple[int, np.ndarray]] = []

    def too_many(self, mask: int, n: int) -> bool:
        return n > self.most and 64 - (mask % (1 << 64)).bit_count() > self.radius

    def whole(self, mask: int, values: np.ndarray) -> None:
        if self.too_many(mask, len(values)):
            self.handed.append((mask, values))
        elif len(values) > 1:
            self.found += _shard_links(values.view(np.uint64).tolist(), self.radius)

    def more(self, key: tuple[int, int], values: np.ndarray) -> None:
        """Values of a shard that may go on after them."""
        if key != self.key:
            self.close()
            self.key = key
        self.values = np.concatenate([self.values, values])
        if self.wide or self.too_many(key[0], len(self.values)):
            self.handed.append((key[0], self.values))
            self.values, self.wide = self.values[:0], True

    def close(self) -> None:
        if self.key is not None and len(self.values):
            self.whole(self.key[0], self.values)
        self.key, self.values, self.wide = None, self.values[:0], False

    def given(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            pairs = np.array(self.found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], names=["a", "b", "mask"])
        for mask, values in self.handed:
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.nulls(len(values), pa.int64()), pa.array(np.full(len(values), mask))], names=["a", "b", "mask"])
        self.found, self.handed = [], []


def _searched(dealt: DataFrame, radius: int, most: int) -> DataFrame:
    """(a, b, mask): links (mask null) from (mask, fp) rows, and the rows (fp as ``a``) of shards with over ``most`` values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(radius, most)
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, shared, fp = (batch[n].to_numpy() for n in ("mask", "shared", "fp"))
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (shared[1:] != shared[:-1])) + 1
            starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
            key = lambda at: (int(mask[at]), int(shared[at]))  # noqa: E731, B023
            shards.more(key(0), fp[:stops[0]])
            if len(starts) > 1:
                inner = np.flatnonzero(stops[1:-1] - starts[1:-1] > 1) + 1
                for i in inner.tolist():
                    shards.whole(int(mask[starts[i]]), fp[starts[i]:stops[i]])
                shards.more(key(starts[-1]), fp[starts[-1]:])
            yield from shards.given()
        shards.close()
        yield from shards.given()

    rows = dealt.withColumn("shared", F.col("fp").bitwiseAND(F.col("mask")))
    rows = rows.select("mask", "shared", "fp").repartition("mask", "shared").sortWithinPartitions("mask", "shared", "fp")
    return rows.mapInArrow(run, "a long, b long, mask long")


def links(distinct: DataFrame, radius: int = 2, most: int = SHARD_VALUES) -> DataFrame:
    """Links (a, b) between different fingerprints (column ``fp``) whose components are those of all pairs within ``radius``.

    No tree holds more than ``most`` fingerprints, but for those that agree on all but ``radius`` bits.
    """
    masks = _finer(0, radius, AGREE)
    dealt = distinct.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    found = None
    while True:
        out = stored(_searched(dealt, radius, most))
        part = out.where("mask IS NULL").select("a", "b")
        found = part if found is None else found.unionByName(part)
        wide = out.where("mask IS NOT NULL")
        kinds = [r.mask for r in wide.select("mask").distinct().collect()]  # as many as there are masks, at most
        if not kinds:
            return found
        finer = [(F.lit(m), F.array(*(F.lit(_signed(n)) for n in _finer(m % (1 << 64), radius, 2)))) for m in kinds]
        dealt = wide.select(F.col("a").alias("fp"), F.explode(F.element_at(
            F.create_map(*(x for pair in finer for x in pair)), F.col("mask"))).alias("mask")).distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root, first): the component and the smallest ``row`` of every fingerprint in ``prints``."""
    distinct = stored(prints.groupBy("fp").agg(F.min("row").alias("first")))
    roots = components(links(distinct, radius))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    return classes.join(classes.groupBy("root").agg(F.min("first").alias("least")), "root").select("fp", "least")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``radius`` bits; component_id
    is the smallest doc_id that links reach. Empty and null texts have the fingerprint zero and are
    linked like any other. A null doc_id keeps its row and never names a component unless it
    has no other member. Repeated rows stay; other columns are ignored; no rows give none.
    """
    prints = stored(fingerprints(docs, width))
    named = _classes(prints.withColumnRenamed("doc_id", "row"), radius)
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def representatives(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id, nulls last, then the smallest text hash.

    All columns of ``docs`` are kept as they are, whatever their names. Of rows that repeat doc_id and text one stays.
    Null and empty texts have the fingerprint zero. A very long text is hashed in one task.
    """
    id_rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("text"))
    # Fingerprints are computed on the keys and texts alone, and meet the rows again by that key.
    prints = stored(fingerprints(docs.select(id_rank.alias("doc_id"), "text"), width))
    row = free_name("row", docs)
    least = _classes(prints.withColumnRenamed("doc_id", "row"), radius).select(F.col("least").alias(row)).distinct()
    kept = docs.withColumn(row, id_rank).join(least, row, "left_semi")
    repeats = kept.groupBy(F.col(row)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    return (kept.dropDuplicates([row]) if repeats else kept).drop(row)
