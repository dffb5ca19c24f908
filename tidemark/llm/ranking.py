"""Ranked lexical search: largest inner products of term weights, with buckets by length.

A document is a vector of integer impacts over the queries' terms, and its score for a query
is the inner product with the query's term counts. Vectors are ordered by length and written in
slices of similar length. Rounds go from the longest vectors to the shortest, and each knows the k-th best
scores of the rounds before:

* a bucket whose longest vector, times the query's length, stays below the query's k-th best score is
  passed over (Cauchy-Schwarz), and so is a whole slice;
* inside a bucket the query's terms with the largest possible share are added up first. What the other
  coordinates can add is bounded by the bucket's largest impact in each, and by Cauchy-Schwarz on what is
  left of both vectors; documents that cannot reach the k-th best score fall out;
* those left are scored over all terms in integers.

Bounds never undercut a score, so the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F, types as T

from tidemark.functions.session import stored
from tidemark.operators.ordering import number_rows

#: Queries searched at a time. Their terms, weights and best scores go to every task; more queries go in further blocks.
QUERY_BLOCK = 5_000
#: Documents in a slice, and in a bucket of it.
SLICE_ROWS, BUCKET_ROWS = 50_000, 4_096
#: Share by which bounds in doubles are raised, far above their rounding.
SLACK = 1e-9

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Stretches of ASCII letters, digits and other characters beyond ASCII; A to Z in lower case."""
    return text.translate(_WORD_BYTES).split()


@dataclass
class Queries:
    """A block of queries: per query, term numbers and how often it has them."""

    numbers: list[int]
    vocabulary: dict[bytes, int]
    parts: list[tuple[np.ndarray, np.ndarray]]


def _block(rows: list) -> Queries:
    vocabulary: dict[bytes, int] = {}
    parts = []
    for r in rows:
        counts = Counter(terms((r.text or "").encode("utf-8", "surrogatepass")))
        at = np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counts], np.int64)
        parts.append((at, np.array(list(counts.values()), np.int64)))
    return Queries([r.number for r in rows], vocabulary, parts)


def _ints(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of the documents with a term: ``n`` counts all their terms, the lists hold those of the vocabulary."""
    slim = docs.selectExpr("doc_id", "cast(cast(text AS string) AS binary) AS body")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n, at, tf, ends = [], [], [], [], [0]
            for i, body in enumerate(batch.column(1)):
                words = terms(body.as_py() or b"")
                if words:
                    counts = Counter(map(vocabulary.get, words))
                    counts.pop(None, None)
                    row.append(i)
                    n.append(len(words))
                    at.extend(counts)
                    tf.extend(counts.values())
                    ends.append(len(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(n, pa.int64()),
                 _ints(np.array(at, np.int32), ends), _ints(np.array(tf, np.int32), ends)], ["doc_id", "n", "terms", "tf"])

    numbers = T.ArrayType(T.IntegerType())
    return slim.mapInArrow(scan, T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", numbers), T.StructField("tf", numbers)]))


def impact_vectors(counts: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, terms, impacts, length) of the documents with an impact above 0."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            at, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
            n = batch.column(1).to_numpy()
            m = 25 + 75 * n * n_docs // n_terms
            impact = weights[at] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)))
            row = np.repeat(np.arange(len(n)), sizes)
            square = np.bincount(row, impact.astype(float) ** 2, len(n))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            whole = pa.RecordBatch.from_arrays(
                [batch.column(0), _ints(at, ends), _ints(impact, ends), pa.array(np.sqrt(square))], ["doc_id", "terms", "impacts", "length"])
            yield whole.filter(pa.array(square > 0))

    return counts.mapInArrow(weigh, T.StructType([
        counts.schema["doc_id"], counts.schema["terms"], T.StructField("impacts", T.ArrayType(T.LongType())),
        T.StructField("length", T.DoubleType())]))


class _Bucket:
    """Impact vectors of similar length, by document and by term."""

    def __init__(self, batch: pa.RecordBatch):
        at, impacts = batch.column("terms"), batch.column("impacts")
        self.ids = batch.column("doc_id")
        self.length = batch.column("length").to_numpy()
        self.longest = float(self.length.max())
        ends = at.offsets.to_numpy()
        self.starts, self.sizes = ends[:-1] - ends[0], np.diff(ends)
        self.terms, self.impacts = at.flatten().to_numpy(), impacts.flatten().to_numpy()
        order = np.argsort(self.terms, kind="stable")
        self.by_term, self.by_impact = self.terms[order], self.impacts[order]
        self.rows = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]

    def scores(self, at: np.ndarray, times: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of all documents that may reach ``least`` (1 or more) for one query."""
        low, high = np.searchsorted(self.by_term, at), np.searchsorted(self.by_term, at, side="right")
        here = high > low
        at, times, low, high = at[here], times[here], low[here], high[here]
        most = times * np.array([self.by_impact[a:b].max() for a, b in zip(low, high, strict=True)], np.int64)
        order = np.argsort(-most, kind="stable")
        rest = most.sum() - np.cumsum(most[order])  # what the terms after each can add, by the largest impacts
        part, square = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes))
        left = float((times.astype(float) ** 2).sum())
        bound = int(most.sum())
        for k, i in enumerate(order):
            if bound < least:  # documents without one of the terms so far are out
                break
            rows, impacts = self.rows[low[i]:high[i]], self.by_impact[low[i]:high[i]]
            part[rows] += times[i] * impacts
            square[rows] += impacts.astype(float) ** 2
            left, bound = left - float(times[i]) ** 2, int(rest[k])
        tail = np.sqrt(max(left, 0.0) * np.maximum(self.length ** 2 * (1 + SLACK) - square, 0.0))
        rows = np.flatnonzero(part + np.minimum(tail, bound) * (1 + SLACK) + 1 >= least)
        if not len(rows):
            return rows, np.zeros(0, np.int64)
        # Survivors over all their terms, in integers.
        dense = np.zeros(int(self.by_term[-1]) + 1, np.int64)
        dense[at] = times
        sizes = self.sizes[rows]
        first = np.cumsum(sizes) - sizes
        entry = np.repeat(self.starts[rows] - first, sizes) + np.arange(sizes.sum())
        exact = np.add.reduceat(dense[self.terms[entry]] * self.impacts[entry], first)
        good = exact >= least
        return rows[good], exact[good]


def _search(queries: Queries, least: list[int], k: int, kind: T.DataType):
    """Task: the best ``k`` documents of its vectors for each query, from the score in ``least`` on."""
    lengths = [math.sqrt(float((times.astype(float) ** 2).sum())) for _, times in queries.parts]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = list(least)
        best: list[list[tuple]] = [[] for _ in floor]
        ids = None
        for whole in batches:
            ids = whole.column("doc_id").type
            for start in range(0, whole.num_rows, BUCKET_ROWS):
                bucket = _Bucket(whole.slice(start, BUCKET_ROWS))
                for q, (at, times) in enumerate(queries.parts):
                    if lengths[q] * bucket.longest * (1 + SLACK) + 1 < floor[q]:
                        continue
                    rows, scores = bucket.scores(at, times, floor[q])
                    if not len(rows):
                        continue
                    # Of equal scores the smaller ids come first, nulls last; the order is Arrow's, which is Spark's.
                    found = pa.table({"doc_id": bucket.ids.take(pa.array(rows)), "score": scores})
                    if best[q]:
                        kept = pa.table({"doc_id": pa.array([d for d, _ in best[q]], ids), "score": pa.array([s for _, s in best[q]], pa.int64())})
                        found = pa.concat_tables([kept, found])
                    order = pc.sort_indices(found, [("score", "descending"), ("doc_id", "ascending")])
                    found = found.take(order[:k])
                    best[q] = list(zip(found["doc_id"].to_pylist(), found["score"].to_pylist(), strict=True))
                    if len(best[q]) == k:
                        floor[q] = max(floor[q], best[q][-1][1])
        rows = [(queries.numbers[q], d, s) for q, found in enumerate(best) for d, s in found]
        if rows:
            number, doc_id, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(doc_id, ids), pa.array(score, pa.int64())], ["number", "doc_id", "score"])

    return search, T.StructType([T.StructField("number", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame | None:
    """(number, doc_id, score, rank) of one block of queries."""
    counts = stored(term_counts(docs, queries.vocabulary))
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not queries.vocabulary:
        return None
    weights = np.zeros(len(queries.vocabulary), np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the block
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    # Ties in length (copies) are spread by doc_id.
    vectors = impact_vectors(counts, weights, n_docs, n_terms).repartitionByRange(
        max(1, -(-n_docs // SLICE_ROWS)), F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length"), "doc_id")
    vectors = stored(vectors.withColumn("slice", F.spark_partition_id()))
    longest = dict(vectors.groupBy("slice").agg(F.max("length")).collect())  # a row for each slice
    least, found, done, step = [1] * len(queries.numbers), None, -1, 1
    lengths = [math.sqrt(float((times.astype(float) ** 2).sum())) for _, times in queries.parts]
    last = max(longest, default=-1)
    while done < last:
        alive = [s for s in longest if s > done and any(length * longest[s] * (1 + SLACK) + 1 >= floor for length, floor in zip(lengths, least, strict=True))]
        if not alive:  # all vectors left are too short for every query
            break
        done, step = min(max(done + step, min(alive)), last), step * 4
        task, schema = _search(queries, least, k, docs.schema["doc_id"].dataType)
        new = vectors.where((F.col("slice") >= min(alive)) & (F.col("slice") <= done)).drop("slice").mapInArrow(task, schema)
        found = stored(_best(new if found is None else found.drop("rank").unionByName(new), k))
        for number, floor in found.where(F.col("rank") == k).select("number", "score").collect():  # a row for each query of the block
            least[number - queries.numbers[0]] = floor
    return found


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each row of ``items`` with a score above 0.

    Equal scores rank by ascending doc_id. Terms are stretches of ASCII letters, digits and characters beyond ASCII, A to
    Z in lower case. A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))) over the N documents with a term;
    a document adds weight * (1e9 tf div (1000 tf + 8 m)) for each term of the item, with m = 25 + 75 n N div L.

    Null and empty texts have no terms: such documents are not counted, such items have no rows. Every row is a document
    and every row of ``items`` an item of its own, so repeated rows rank each; a null doc_id comes last among equal scores.
    A very long text is counted in one task. Items are taken in blocks of ``QUERY_BLOCK``; a block's terms and
    best scores pass through the driver. Other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    numbered = stored(number_rows(items, [F.col("item_id"), F.col("text")], "number"))
    found = []
    for start in range(1, numbered.count() + 1, QUERY_BLOCK):
        rows = numbered.where(F.col("number").between(start, start + QUERY_BLOCK - 1)).orderBy("number").collect()
        found.append(_search_block(docs, _block(rows), k))
    found = [f for f in found if f is not None]
    if not found:
        return spark.createDataFrame([], T.StructType([
            items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())]))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return numbered.select("item_id", "number").join(rows, "number").select("item_id", "rank", "doc_id", "score")
