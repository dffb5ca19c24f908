import math
import re
from collections import Counter

import pytest

from tests.llm.messy import documents, prose
from tidemark.llm import ranking

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return _TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for d, bag, n in bags:
            m = 25 + 75 * n * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in terms(text) if bag[t])
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, prose(1, 30)), (2, "One TWO two"), (3, prose(7, 13)), (4, None), (5, ""), (6, "Ünïcödé 😀"), (7, prose(4, 9).upper()), (3, prose(5, 20)),
         (8, "nowhere"), (9, " ... "), (None, prose(2, 12)), (10, "alpha1-alpha1"), (11, prose(99, 200))]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, number int")


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("k, rows, bucket", [(10, 50_000, 4096), (3, 7, 2), (1, 5, 1)])
def test_search_equals_brute_force(spark, monkeypatch, k, rows, bucket):
    monkeypatch.setattr(ranking, "SLICE_ROWS", rows)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", bucket)
    more = [(100 + i, prose(i % 20, 5 + i % 40)) for i in range(80)] + [(300, prose(1, 30))] * 12
    docs = documents(spark).unionByName(documents(spark, more))
    got = ranking.search(docs, benchmark(spark), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(pairs(docs), ITEMS, k)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranking, "QUERY_BLOCK", 4)
    docs = documents(spark)
    assert sorted(map(tuple, ranking.search(docs, benchmark(spark)).collect()), key=str) == brute(pairs(docs), ITEMS)


def test_buckets_and_documents_are_passed_over(spark, monkeypatch):
    seen = []
    scores = ranking._Bucket.scores

    def watched(self, at, times, least):
        rows, exact = scores(self, at, times, least)
        seen.append((len(self.sizes), len(rows)))
        return rows, exact

    monkeypatch.setattr(ranking._Bucket, "scores", watched)
    import pyarrow as pa
    import numpy as np

    rng = np.random.default_rng(1)
    n = 400
    sizes = np.sort(rng.integers(1, 40, n))[::-1]
    parts = [rng.choice(60, s, replace=False) for s in sizes]
    impacts = [rng.integers(1, 1000, s) * int(1 + 1000 / (1 + i)) for i, s in enumerate(sizes)]
    length = np.array([math.sqrt(float((x.astype(float) ** 2).sum())) for x in impacts])
    order = np.argsort(-length)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array([parts[i].tolist() for i in order], pa.list_(pa.int32())),
         pa.array([impacts[i].tolist() for i in order], pa.list_(pa.int64())), pa.array(length[order])], ["doc_id", "terms", "impacts", "length"])
    queries = ranking.Queries([1], {}, [(np.arange(0, 60, 6), np.ones(10, np.int64))])
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 20)
    from pyspark.sql import types as T

    task, _ = ranking._search(queries, [1], 3, T.LongType())
    (out,) = list(task(iter([batch])))
    want = sorted(((-int(sum(x for t, x in zip(parts[i], impacts[i], strict=True) if t % 6 == 0)), int(d)) for d, i in enumerate(order)))[:3]
    assert [(-s, d) for d, s in zip(out["doc_id"].to_pylist(), out["score"].to_pylist(), strict=True)] == want
    assert len(seen) < n // 20 and sum(rows for _, rows in seen) < n // 4


def test_no_terms_and_empty_tables(spark):
    docs = documents(spark)
    assert ranking.search(docs.limit(0), benchmark(spark)).collect() == []
    assert ranking.search(docs, benchmark(spark).limit(0)).collect() == []
    assert ranking.search(documents(spark, [(1, None), (2, "...")]), benchmark(spark)).collect() == []
