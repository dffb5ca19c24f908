"""Removal of repeated passages by merged Burrows-Wheeler transforms.

A byte goes if a string of LENGTH bytes that covers it also starts earlier.

Every string of LENGTH bytes is filed under its least K-byte substring by hash
(its anchor), which depends on the string alone. Neighbouring strings with one
anchor form a cell, about LENGTH / 2.6 bytes apart. Cells whose anchor occurs
once cannot repeat; cells that equal an earlier one go whole (128-bit hashes of
their bytes tell them apart; among n cells of one anchor two different ones
agree with a probability below n * n / 2 ** 129). What is left, the first of
each set of equal cells where other cells share the anchor, is sorted as
suffixes: shards build their transforms, and the transforms of a bucket of
anchors are merged by refining their interleave, one symbol of depth a round.
An anchor with more cells than one task should hold is split: its strings are
filed anew under their least substring of more bytes, up to LENGTH, where all
strings of an anchor are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.text import text_key

LENGTH = 100
#: Bytes of an anchor.
K = 24
#: String starts worked on in one go; longer texts go through in pieces.
PIECE = 1 << 20

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _anchor_hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hash of each ``k``-byte substring, K at least."""
    wide = data.astype(np.uint64)
    wide = wide[:-1] | (wide[1:] << np.uint64(8))
    wide = wide[:-2] | (wide[2:] << np.uint64(16))
    wide = wide[:-4] | (wide[4:] << np.uint64(32))
    n = len(data) - K + 1
    mixed = wide[:n] * _M1
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed ^ wide[8:n + 8]) * _M2
    mixed ^= mixed >> np.uint64(29)
    mixed = (mixed ^ wide[16:n + 16]) * _M3
    short = mixed ^ (mixed >> np.uint64(32))
    if k == K:
        return short
    n = len(data) - k + 1
    mixed = short[:n]
    for at in (*range(K, k - K, K), k - K):  # K-byte substrings that cover the longer one
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _M2 + short[at:at + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _M3
    return mixed ^ (mixed >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _pieces(raw: bytes, k: int = K) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece of a text: its place and bytes, and first starts, last starts and anchor hashes of its cells."""
    for begin in range(0, len(raw) - LENGTH + 1, PIECE):
        part = raw[begin:begin + PIECE + LENGTH - 1]
        hashes = _anchor_hashes(np.frombuffer(part, dtype=np.uint8), k)
        places = np.arange(len(hashes), dtype=np.uint64)
        anchor = (_least((hashes & np.uint64(0xFFFFFFFF00000000)) | places, LENGTH - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        yield begin, part, first, last, hashes[anchor[first]].view(np.int64)


def anchors(raw: bytes) -> np.ndarray:
    """Anchor hash of each cell of a text."""
    return np.concatenate([np.zeros(0, np.int64), *(hashes for *_, hashes in _pieces(raw))])


def cells(raw: bytes, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of further starts, anchor hash and content hash (16 bytes) of each cell of a text."""
    found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "V16"))]
    digest = xxhash.xxh3_128_digest
    for begin, part, first, last, hashes in _pieces(raw, k):
        content = b"".join([digest(part[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)])
        found.append((first + begin, last - first, hashes, np.frombuffer(content, dtype="V16")))
    return tuple(np.concatenate(x) for x in zip(*found))


def _binary(hashes: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(16), len(hashes), [None, pa.py_buffer(hashes.tobytes())]).cast(pa.binary())


#: Symbols that one round of sorting or merging looks at, if a bucket has few enough different groups of them.
STRIDES = (10, 5, 4, 2, 1)
#: Bytes of a shard, whose suffixes are sorted by themselves before they are merged.
SHARD_BYTES = 1 << 14
#: Cells that share a bucket; an anchor with more cells than HOT_CELLS is split by anchors of LONGER bytes, one after another.
BUCKET_CELLS, HOT_CELLS, LONGER = 450, 16_000, (2 * K, 3 * K, LENGTH)
#: Documents whose ids may be broadcast, to keep the texts of the others out of a shuffle.
BROADCAST_DOCS = 1_000_000


class Collection:
    """Strings one after another, each with an end mark, read as circles."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
        self.begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)
        self.offset = np.arange(sizes.sum()) - self.begin[self.owner]
        self.size = sizes[self.owner]
        self.symbols = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        self.symbols[self.begin + sizes - 1] = 0
        for self.stride in STRIDES:
            self.codes, fits = self._codes(self.stride)
            if fits and LENGTH % self.stride == 0:
                break
        self.before = self.moved(-self.stride)

    def moved(self, by: int) -> np.ndarray:
        """The place ``by`` symbols on from each place, round its own string."""
        return self.begin[self.owner] + (self.offset + by) % self.size

    def _codes(self, stride: int) -> tuple[np.ndarray, bool]:
        """Order-keeping codes of the next ``stride`` symbols; whether 16 bits hold them, for counting sorts."""
        if stride == 1:
            return self.symbols.astype(np.uint16), True
        half = stride // 2 if stride > 5 else 1  # five symbols fit one number, longer strides are two halves
        value = part = self._codes(half)[0].astype(np.int64)
        for step in range(half, stride, half):
            value = value * (int(part.max()) + 1) + part[self.moved(step)]
        seen, codes = np.unique(value, return_inverse=True)
        return (codes.astype(np.uint16), True) if len(seen) < 1 << 16 else (codes, False)

    def sorted_suffixes(self, first: int, stop: int) -> np.ndarray:
        """Suffix array of the strings that fill ``first`` to ``stop``, to a depth of LENGTH symbols at least."""
        rank, step, depth = self.codes[first:stop].astype(np.int64), self.moved(self.stride)[first:stop] - first, self.stride
        while depth < LENGTH:
            key = rank * (stop - first + (1 << 16)) + rank[step]
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(stop - first, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], sorted_key[1:] != sorted_key[:-1])))
            step, depth = step[step], 2 * depth
        return order + first


def merged(strings: list[bytes], shard_bytes: int = SHARD_BYTES) -> tuple[Collection, np.ndarray, np.ndarray]:
    """All suffixes in order to LENGTH symbols, and where a suffix differs from the one before it.

    Each shard has its suffix array and its transform, the symbols ahead of its sorted suffixes. The
    interleave, kept as places in the shards' transforms, starts shard by shard. A round reads the
    transforms in its order and deals the entries out by symbol, stably, each to where its shard's
    last-to-first mapping leads: after t rounds the interleave is right for t strides of symbols. A
    border between suffixes first shows in the round of their common prefix.
    """
    all_of = Collection(strings)
    n = len(all_of.symbols)
    cuts, held = [0], 0
    for begin, string in zip(all_of.begin.tolist(), strings, strict=True):
        if held and held + len(string) > shard_bytes:
            cuts.append(begin)
            held = 0
        held += len(string) + 1
    cuts.append(n)
    suffixes = np.concatenate([all_of.sorted_suffixes(a, b) for a, b in zip(cuts, cuts[1:])])
    transform = all_of.codes[all_of.before[suffixes]]
    place = np.empty(n, dtype=np.int32)
    place[suffixes] = np.arange(n, dtype=np.int32)
    first = place[all_of.before[suffixes]]  # last-to-first mapping; shards never mix, as strings are circles
    border = np.zeros(n, dtype=bool)
    border[:1] = True
    interleave = np.arange(n, dtype=np.int32)
    for _ in range(LENGTH // all_of.stride):
        ahead = transform[interleave]
        order = np.argsort(ahead, kind="stable")
        block = np.cumsum(border, dtype=np.int32)[order]
        ahead = ahead[order]
        border[1:] = (ahead[1:] != ahead[:-1]) | (block[1:] != block[:-1])
        interleave = first[interleave[order]]
    return all_of, suffixes[interleave], border


def later_strings(strings: list[bytes], spans: list[int], shard_bytes: int = SHARD_BYTES) -> list[tuple[int, int, int]]:
    """(string, first, last): runs of starts whose LENGTH bytes also start earlier, in the order of the strings.

    Only starts from 0 to a string's span count, for both sides.
    """
    if not strings:
        return []
    all_of, suffixes, border = merged(strings, shard_bytes)
    valid = all_of.offset[suffixes] <= np.array(spans, dtype=np.int64)[all_of.owner[suffixes]]
    place = np.where(valid, suffixes, len(suffixes))
    first = np.minimum.reduceat(place, np.flatnonzero(border))[np.cumsum(border) - 1]
    later = np.sort(suffixes[valid & (suffixes != first)])
    if not len(later):
        return []
    cut = np.flatnonzero((np.diff(later) != 1) | np.diff(all_of.owner[later]).astype(bool)) + 1
    heads, tails = later[np.concatenate(([0], cut))], later[np.concatenate((cut - 1, [len(later) - 1]))]
    return list(zip(all_of.owner[heads].tolist(), all_of.offset[heads].tolist(), all_of.offset[tails].tolist(), strict=True))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, raw): ``doc`` orders documents; it is doc_id where that is a key, else doc_id with a text hash."""
    count = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.countDistinct("doc_id")).first()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id") if count[0] == count[1] == count[2] else F.struct("doc_id", text_key(text).alias("text"))
    return docs.select(doc.alias("doc"), "doc_id", text.cast("binary").alias("raw"))


def _anchors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *(anchors(raw.as_py()) for raw in batch["raw"])]))], names=["anchor"])

    return rows.select("raw").mapInArrow(run, "anchor long")


def _cells(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [cells(raw.as_py()) for raw in batch["raw"]]
            if not parts:
                continue
            row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            lo, span, anchor, content = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"].take(pa.array(row)), pa.array(lo), pa.array(span.astype(np.int32)), pa.array(anchor), _binary(content)],
                names=["doc", "lo", "span", "anchor", "content"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.select("doc", "raw").mapInArrow(run, f"doc {kind}, lo long, span int, anchor long, content binary")


def _split(strings: DataFrame, k: int) -> DataFrame:
    """The cells of ``strings`` cut anew by the least ``k``-byte substring, each with its bytes, filed under both anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch["bytes"].to_pylist()
            parts = [cells(raw, k) for raw in held]
            if not parts:
                continue
            row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            at, span, anchor, content = (np.concatenate(x) for x in zip(*parts))
            both = (batch["anchor"].to_numpy()[row].view(np.uint64) * _M1 ^ anchor.view(np.uint64)).view(np.int64)
            pieces = [held[r][a:b] for r, a, b in zip(row.tolist(), at.tolist(), (at + span + LENGTH).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"].take(pa.array(row)), pa.array(batch["lo"].to_numpy()[row] + at), pa.array(span.astype(np.int32)), pa.array(both),
                 _binary(content), pa.array(pieces, pa.binary())], names=["doc", "lo", "span", "anchor", "content", "bytes"])

    kind = strings.schema["doc"].dataType.simpleString()
    return strings.select("doc", "lo", "anchor", "bytes").mapInArrow(
        run, f"doc {kind}, lo long, span int, anchor long, content binary, bytes binary")


def _texts_of(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``rows`` that ``docs`` (one column, doc) names; ids are few beside texts, so they go to the texts if they may."""
    if docs.limit(BROADCAST_DOCS + 1).count() > BROADCAST_DOCS:
        return rows
    return rows.join(F.broadcast(docs), "doc", "left_semi")


def _told_apart(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of stored cells, the ranges (doc, lo, hi) of those that equal an earlier one, and the first of each set of equal
    cells where others share the anchor, with the number of such sets (``n_cells``) and all other columns."""
    place = F.struct(*(c for c in found.columns if c not in ("anchor", "content")))  # doc and lo come first
    classes = stored(found.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    several = classes.where("n > 1").select("anchor", "content", F.struct("first.doc", "first.lo").alias("first"))
    whole = found.join(several, ["anchor", "content"]).where(F.struct("doc", "lo") != F.col("first")).select(
        "doc", "lo", (F.col("lo") + F.col("span") + LENGTH).alias("hi"))
    crowd = stored(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_cells")).where("n_cells > 1"))
    return whole, stored(classes.join(crowd, "anchor").select("anchor", "n_cells", "first.*"))


def covered(rows: DataFrame) -> DataFrame:
    """(doc, lo, hi): byte ranges that strings which also start earlier cover; ranges of a document may overlap."""
    # Both counts are written before they are joined, so that a hot anchor's side of the join can be split.
    common = stored(_anchors(rows).groupBy("anchor").count().where("count > 1").select("anchor"))
    whole, open_cells = _told_apart(stored(_cells(rows).join(common, "anchor", "left_semi").select("doc", "lo", "span", "anchor", "content")))
    lists = open_cells.groupBy("doc").agg(F.collect_list(F.struct("anchor", "n_cells", "lo", "span")).alias("cells"))
    texts = _texts_of(rows.select("doc", "raw").dropDuplicates(["doc"]) if _is_struct(rows) else rows.select("doc", "raw"), open_cells.select("doc").distinct())
    strings = stored(texts.join(lists, "doc").select("doc", F.explode(F.transform("cells", lambda c: F.struct(
        c["anchor"].alias("anchor"), c["n_cells"].alias("n_cells"), c["lo"].alias("lo"), c["span"].alias("span"),
        F.substring("raw", (c["lo"] + 1).cast("int"), c["span"] + LENGTH).alias("bytes")))).alias("c")).select("doc", "c.*"))
    ranges = whole
    for k in LONGER:
        hot = strings.where(F.col("n_cells") > HOT_CELLS)
        if not hot.limit(1).count():
            break
        ranges = ranges.unionByName(_by_suffix(strings.where(F.col("n_cells") <= HOT_CELLS)))
        whole, strings = _told_apart(stored(_split(hot, k)))
        ranges = ranges.unionByName(whole)
    return ranges.unionByName(_by_suffix(strings))


def _is_struct(rows: DataFrame) -> bool:
    return rows.schema["doc"].dataType.typeName() == "struct"


def _by_suffix(strings: DataFrame) -> DataFrame:
    """Covered ranges from merged transforms, a bucket of anchors at a time."""
    buckets = max(1, -(-strings.count() // BUCKET_CELLS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def worked() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            runs = later_strings(table["bytes"].to_pylist(), table["span"].to_pylist())
            if runs:
                owner, head, tail = (np.array(x, dtype=np.int64) for x in zip(*runs))
                part = table.select(["doc", "lo"]).take(pa.array(owner))
                lo = part["lo"].to_numpy()
                yield from pa.table({"doc": part["doc"], "lo": lo + head, "hi": lo + tail + LENGTH}).to_batches()

        for batch in batches:
            ids = batch["bucket"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and held[0]["bucket"][0].as_py() != ids[a]:
                        yield from worked()
                        held.clear()
                    held.append(batch.slice(a, b - a))
        if held:
            yield from worked()

    kind = strings.schema["doc"].dataType.simpleString()
    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).repartition("bucket").sortWithinPartitions("bucket", "doc", "lo")
    return dealt.select("bucket", "doc", "lo", "span", "bytes").mapInArrow(run, f"doc {kind}, lo long, hi long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (binary).

    Texts are UTF-8 bytes, a null one is empty. A byte is removed if a string of LENGTH bytes that covers it
    starts earlier too: in a document with a smaller doc_id (null first, equal ones by a hash of their text),
    or in the same document. Rows that repeat both doc_id and text are one document and have the same
    result. Strings never cross documents and are judged on the input. Other columns are ignored; no rows give none.
    """
    rows = _identified(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = stored(covered(rows))
    lists = ranges.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for raw, ranges in zip(batch["raw"].to_pylist(), batch["ranges"].to_pylist(), strict=True):
                kept, end, removed, spans = [], 0, 0, 0
                for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges):
                    if lo > end or not spans:
                        kept.append(raw[end:lo])
                        spans, end = spans + 1, hi
                        removed += hi - lo
                    elif hi > end:
                        removed, end = removed + hi - end, hi
                kept = b"".join([*kept, raw[end:]])
                out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds))], names=names)

    named = ranges.select("doc").distinct()
    small = named.limit(BROADCAST_DOCS + 1).count() <= BROADCAST_DOCS
    rest = rows.join(F.broadcast(named) if small else named, "doc", "left_anti").select(
        "doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256"), F.col("raw").alias("kept"))
    cut = _texts_of(rows, named).join(lists, "doc").select("doc_id", "raw", "ranges").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return cut.unionByName(rest)
