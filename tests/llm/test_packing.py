import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.messy import documents
from tidemark.llm import packing, queries
from tidemark.llm.tokens import Coder


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


def gapless(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_word_cache_equals_the_library(path):
    coder = Coder(path)
    texts = ["Hello, world! It's 2024... don't", "á café CAFÉ", "ΣΑΣ İstanbul K Å ﬁ", "<|endoftext|> x", "", " \n\n ", "tab\tnbsp x y", "ß½²x", "ÀÉÎ,. x!!y",
             "日本語 テキスト", "🙂🙂 a-b_c", "a" * 3000, "'s 't're we'll", "\x1c\x85z"]
    for text in texts:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.library.encode(text, add_special_tokens=False).ids, text


def test_small_caches_change_nothing(path, monkeypatch):
    monkeypatch.setattr("tidemark.llm.tokens.CACHE_WORDS", 3)
    test_word_cache_equals_the_library(path)


def test_pieces_and_sequences_hold_every_id(spark, path):
    docs, capacity = documents(spark), 64
    rows = packing.pack_documents(docs, path, capacity).collect()
    coder = Coder(path)
    ids = [(r.doc_id, np.append(np.frombuffer(coder.encode(r.text or ""), "<u4"), np.uint32(1))) for r in docs.collect()]
    want = sorted((str(i), at // capacity, at, len(x[at:at + capacity]), zlib.crc32(x[at:at + capacity].astype("<u4").tobytes()))
                  for i, x in ids for at in range(0, len(x), capacity))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(len(x) for _, x in ids)
    assert gapless(rows, capacity) <= math.ceil(total / capacity) + 2


@pytest.mark.parametrize("task_items", [7, 1_000_000])
def test_rounds_come_near_the_bound(spark, task_items):
    chance = random.Random(4)
    lengths = [chance.randint(1, 100) for _ in range(3000)]
    items = spark.createDataFrame([(n, n) for n in lengths], "length long, bin long").repartition(16)
    rows = packing.pack(items, 100, task_items=task_items).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    whole = 1 + max(b for b, _ in packing.best_fit(lengths, 100))
    assert gapless(rows, 100) <= whole * (1.03 if task_items > 7 else 1.25)


def test_large_items_stay_alone(spark):
    rows = packing.pack(spark.range(50).select(F.lit(60).cast("long").alias("length")), 100).collect()
    assert gapless(rows, 100) == 50


def test_bad_lengths(spark):
    items = spark.createDataFrame([(None, 1), (0, 2), (-3, 3), (5, 4), (5, 4)], "length long, offset long")
    rows = packing.pack(items, 10).collect()
    assert sorted((r.length if r.length is not None else -9, r.sequence_id is None) for r in rows) == [(-9, True), (-3, True), (0, True), (5, False), (5, False)]
    with pytest.raises(Exception, match="longer than 10"):
        packing.pack(spark.range(1).select(F.lit(11).cast("long").alias("length")), 10).collect()


def test_sequences_join_the_pieces(spark, path):
    docs = documents(spark).where("doc_id in (1, 6, 7, 8)")
    placed = packing.pack_documents(docs, path, 32)
    coder, got = Coder(path), {r.sequence_id: r.ids for r in packing.sequences(docs, placed, path, 32).collect()}
    texts = {r.doc_id: [*np.frombuffer(coder.encode(r.text), "<u4").tolist(), 1] for r in docs.collect()}
    for r in placed.collect():
        assert got[r.sequence_id][r.offset:r.offset + r.length] == texts[r.doc_id][r.start:r.start + r.length]


def test_empty_table(spark, path):
    assert packing.pack_documents(documents(spark).limit(0), path).collect() == []
