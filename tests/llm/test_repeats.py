import hashlib
import random

import pytest

from tests.llm.messy import ROWS, documents, prose
from tidemark.llm import repeats

L = repeats.LENGTH


def brute(rows):
    """Of distinct (doc_id, text): sizes and digest of what is left."""
    seen, out = set(), {}
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).digest()))
    for i, text in order:
        raw = text.encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - L + 1):
            if raw[at:at + L] in seen:
                gone[at:at + L] = b"\1" * L
            seen.add(raw[at:at + L])
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[(i, text)] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[(i, t or "")]) for i, t in rows), key=str)


def got(docs):
    return sorted((tuple(r)[:5] for r in repeats.remove_repeats(docs).collect()), key=str)


PASSAGE = prose(30, 25)
CASES = {
    "messy": [r for r in ROWS if r[1] is None or len(r[1]) < 50_000],
    "passages": [(i, prose(100 + i, 20) + f" {PASSAGE} " + prose(200 + i, 15)) for i in range(30)],
    "edits": [(i, PASSAGE[:60 + i] + "#" + PASSAGE[61 + i:]) for i in range(60)],
    "periodic": [(1, "ab" * 300), (2, "ba" * 120), (3, "a" * 500), (4, "a" * 99), (5, "a" * 100), (6, "\0" * 230), (7, "é" * 130)],
    "borders": [(i, chr(65 + i) * i + PASSAGE[:95 + i] + chr(75 + i) * 3) for i in range(12)],
}


@pytest.mark.parametrize("case", CASES)
def test_removal_equals_brute_force(spark, case):
    assert got(documents(spark, CASES[case])) == brute(CASES[case])


@pytest.mark.parametrize("settings", [{"HOT_CELLS": 2}, {"HOT_CELLS": 1, "LONGER": (repeats.LENGTH,)}, {"BUCKET_CELLS": 5, "SHARD_BYTES": 400}, {"BROADCAST_DOCS": 0}, {"PIECE": 150}])
def test_every_way_gives_the_same(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(repeats, name, value)
    for case in ("passages", "edits"):
        assert got(documents(spark, CASES[case])) == brute(CASES[case])


@pytest.mark.parametrize("k", [repeats.K, *repeats.LONGER])
def test_cells_cover_every_start_and_equal_strings_share_an_anchor(k):
    text = (PASSAGE + "#" + PASSAGE[7:] + "ab" * 150).encode()
    first, span, anchor, content = repeats.cells(text, k)
    assert [a + j for a, n in zip(first.tolist(), span.tolist()) for j in range(n + 1)] == list(range(len(text) - L + 1))
    of = {}
    for a, n, h in zip(first.tolist(), span.tolist(), anchor.tolist(), strict=True):
        for at in range(a, a + n + 1):
            assert of.setdefault(text[at:at + L], h) == h
    bytes_of = {}
    for a, n, c in zip(first.tolist(), span.tolist(), content, strict=True):
        assert bytes_of.setdefault(c.tobytes(), text[a:a + n + L]) == text[a:a + n + L]
    if k == L:  # here an anchor has equal strings only, so that nothing is left to split
        assert not span.any() and len({*of.values()}) == len(of)


@pytest.mark.parametrize("seed", range(8))
def test_merged_transforms_equal_brute_force(seed):
    chance = random.Random(seed)
    letters = chance.choice(["ab", "abcdefgh ", "\0a", "aaaab"])
    source = "".join(chance.choice(letters) for _ in range(300))
    strings = []
    for _ in range(14):
        part = list(source[(at := chance.randrange(120)):at + chance.randrange(L, 177)])
        if chance.random() < 0.5:
            part[chance.randrange(len(part))] = "z"
        strings.append("".join(part).encode())
    spans = [chance.randrange(len(s) - L + 1) for s in strings]
    seen, want = set(), set()
    for k, (string, span) in enumerate(zip(strings, spans, strict=True)):
        for at in range(span + 1):
            if string[at:at + L] in seen:
                want.add((k, at))
            seen.add(string[at:at + L])
    for shard in (150, 600, 1 << 20):
        found = repeats.later_strings(strings, spans, shard)
        assert {(k, at) for k, a, b in found for at in range(a, b + 1)} == want


def test_merged_order_and_borders():
    strings = [prose(1, 20).encode(), prose(1, 20).encode()[5:], prose(2, 20).encode()]
    collection, suffixes, border = repeats.merged(strings, 100)
    rings = [s + b"\0" for s in strings]
    key = lambda p: (rings[collection.owner[p]] * 9)[collection.offset[p]:][:L]
    keys = [key(p) for p in suffixes]
    assert keys == sorted(keys)
    assert border.tolist() == [True, *(a != b for a, b in zip(keys, keys[1:]))]


def test_kept_bytes_and_empty_table(spark):
    rows = repeats.remove_repeats(documents(spark, [(1, PASSAGE), (2, "x " + PASSAGE + " y")])).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in rows) == [(1, PASSAGE.encode()), (2, b"x  y")]
    assert repeats.remove_repeats(documents(spark).limit(0)).collect() == []
