"""Document fingerprints from closed syncmers.

A window of K bytes is an anchor if its least inner substring of S bytes lies at
either end. Whether a window is one depends on the window alone, so the same
passage has the same anchors in any text and at any place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.neighbours import descending, pairs

#: Bytes of an anchor and of the inner substring whose hash is compared.
K, S = 12, 6
#: Anchors in a fingerprint: the smallest hashes. Texts with fewer have them all.
SKETCH = 64
#: Bytes hashed in one go; longer texts go through in pieces that overlap by K - 1.
PIECE = 1 << 20

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of at least K bytes."""
    wide = data.astype(np.uint64)
    two = wide[:-1] | (wide[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    inner = _mix(four[:-2] | (two[4:] << np.uint64(32)))  # one for each substring of S bytes
    low = np.minimum(inner[:-1], inner[1:])
    low = np.minimum(low[:-2], low[2:])
    span = K - S + 1  # substrings in a window; two runs of four cover its seven
    least = np.minimum(low[:len(inner) - span + 1], low[span - 4:])
    at = np.flatnonzero((inner[:len(least)] == least) | (inner[span - 1:] == least))
    return at, _mix(inner[at] ^ (inner[at + K - S] * _M3))


def anchors(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and 64-bit hashes of the closed syncmers of a whole text (null or short: none)."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found = [(at + start, hashes) for start in range(0, max(1, len(data) - K + 1), PIECE)
             for at, hashes in [_piece(data[start:start + PIECE + K - 1])]]
    return np.concatenate([a for a, _ in found]), np.concatenate([h for _, h in found])


def sketch(text: str | None) -> np.ndarray:
    """The smallest distinct anchor hashes, 32 bits each, in order; a text without anchors has one hash of all of it."""
    hashes = anchors(text)[1]
    if not len(hashes):
        whole = hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=4).digest()
        return np.frombuffer(whole, dtype=">u4").astype(np.uint32)
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(top) > 16 * SKETCH:  # the smallest few are enough, unless repeats fill them
        few = np.unique(np.partition(top, 8 * SKETCH)[:8 * SKETCH])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(top)[:SKETCH]


def as_text(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common anchors among the smallest of both sketches: an estimate of the Jaccard index."""
    both = np.union1d(a, b)[:SKETCH]
    return float(np.isin(both, a, assume_unique=True) @ np.isin(both, b, assume_unique=True).astype(np.int64)) / len(both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; equal texts have equal fingerprints, a null text the empty one's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(sketch(t.as_py())) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def anchor_table(docs: DataFrame) -> DataFrame:
    """(doc_id, offset, hash): every anchor of every text with its byte offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch["text"]):
                at, hashes = anchors(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(np.full(len(at), row))), pa.array(at.astype(np.int64)), pa.array(hashes.view(np.int64))],
                    names=["doc_id", "offset", "hash"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, offset long, hash long")


def positional_matches(docs: DataFrame, others: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, other_id, shift, n_anchors): passages of ``others`` found in ``docs``.

    A match is at least ``least`` distinct anchors whose offsets differ by the same shift. Anchors that a
    text repeats count once, at their first place, so a pair's rows follow its common anchors.
    """
    first = lambda df, name: anchor_table(df).groupBy(F.col("doc_id").alias(name), "hash").agg(F.min("offset").alias(f"{name}_at"))
    return first(docs, "doc_id").join(first(others, "other_id"), "hash").groupBy(
        "doc_id", "other_id", (F.col("doc_id_at") - F.col("other_id_at")).alias("shift")).agg(
        F.count(F.lit(1)).alias("n_anchors")).where(F.col("n_anchors") >= least)


def edited_likeness(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of an edited one, and how alike they are.

    Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edit replaces the last third of the code points, rounded down, by as many first ones (or
    all) of the next document by falling doc_id; after the last comes the first. A null text is empty,
    a null doc_id comes last, equal doc_ids follow their texts' order, a single row is its own next.
    Other columns are ignored; no rows give none.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        schema: pa.Schema | None = None
        held: tuple[dict, np.ndarray] | None = None

        def tapped() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
                yield batch

        for row, following in pairs(tapped()):
            own = held[1] if held is not None and held[0] is row else sketch(row["text"])
            held = (following, sketch(following["text"]))
            cut = len(row["text"]) // 3
            edited = row["text"][:len(row["text"]) - cut] + following["text"][:cut]
            changed = sketch(edited)
            out.append((row["doc_id"], len(row["text"]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own), as_text(changed),
                        likeness(own, changed), likeness(own, held[1])))
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)

    return descending(rows, "doc_id", "text", partitions=partitions).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
