import hashlib

import numpy as np
import pytest

from tests.llm.messy import LONG, documents, prose
from tidemark.llm import syncmers


def brute_anchors(text):
    raw = text.encode()
    inner = syncmers._mix(np.array([int.from_bytes(raw[i:i + syncmers.S], "little") for i in range(len(raw) - syncmers.S + 1)], dtype=np.uint64))
    span = syncmers.K - syncmers.S + 1
    return [i for i in range(len(raw) - syncmers.K + 1) if min(inner[i:i + span]) in (inner[i], inner[i + span - 1])]


@pytest.mark.parametrize("text", ["x" * 12, "x" * 13, prose(1, 40), "é😀 " * 20, "ab" * 50])
def test_anchors_equal_brute_force(text):
    assert syncmers.anchors(text)[0].tolist() == brute_anchors(text)


def test_pieces_of_a_long_text_join(monkeypatch):
    whole = syncmers.anchors(LONG)
    monkeypatch.setattr(syncmers, "PIECE", 1000)
    assert all(np.array_equal(a, b) for a, b in zip(whole, syncmers.anchors(LONG), strict=True))


def test_anchors_do_not_depend_on_the_place():
    inside, text = prose(1, 30), prose(2, 40) + " "
    own = set(syncmers.anchors(inside)[1].tolist())
    assert own <= set(syncmers.anchors(text + inside + " " + prose(3, 10))[1].tolist())


def brute(docs):
    order = sorted(docs, key=lambda r: (r.doc_id is not None, r.doc_id or 0), reverse=True)
    # Equal ids follow their texts' order.
    order = sorted(order, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), (r.text or "").encode()))
    out = []
    for r, following in zip(order, order[1:] + order[:1], strict=True):
        text, other = r.text or "", following.text or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        prints = [syncmers.sketch(t) for t in (text, edited, other)]
        out.append((r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *map(syncmers.as_text, prints[:2]),
                    syncmers.likeness(prints[0], prints[1]), syncmers.likeness(prints[0], prints[2])))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edits_equal_brute_force(spark, partitions):
    docs = documents(spark)
    assert sorted(map(tuple, syncmers.edited_likeness(docs, partitions).collect()), key=str) == brute(docs.collect())


def test_one_document_is_its_own_next(spark):
    row = syncmers.edited_likeness(documents(spark, [(5, prose(1, 60))])).collect()[0]
    assert row.near_next == 1.0 and row.near_edited > 0.3


def test_equal_texts_have_equal_fingerprints(spark):
    prints = {}
    for r in syncmers.fingerprints(documents(spark)).join(documents(spark).select("doc_id", "text"), "doc_id").collect():
        if r.doc_id != 2:
            prints.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_positional_matches_find_a_passage(spark):
    passage = prose(5, 30)
    docs = documents(spark, [(1, prose(1, 50) + " " + passage), (2, prose(2, 50)), (3, None)])
    others = documents(spark, [(9, passage + " " + prose(3, 10)), (8, "")])
    got = syncmers.positional_matches(docs, others).collect()
    assert [(r.doc_id, r.other_id, r.shift) for r in got] == [(1, 9, len(prose(1, 50)) + 1)]


def test_empty_table(spark):
    assert syncmers.edited_likeness(documents(spark).limit(0)).collect() == []
