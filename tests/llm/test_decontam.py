import hashlib
import re

from tests.llm.messy import documents, prose
from tidemark.llm import decontam

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items, width=13):
    mine, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        for window in [other[i:i + width] for i in range(max(1, len(other) - width + 1))] if other else []:
            for at in range(len(mine) - len(window) + 1):
                if mine[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    return len(mine), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(mine)


ITEMS = [(1, prose(1, 30)), (2, "one two"), (3, prose(7, 13)), (4, None), (5, ""), (6, "Ünïcödé"), (7, prose(1, 30).upper()), (8, " ... "), (9, prose(8, 20)),
         (3, prose(7, 13))]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, i) for i, t in items], "item_id long, text string, key int")


def test_contamination_equals_brute_force(spark):
    extra = [(50, prose(6, 20) + " " + prose(7, 13).replace(" ", "--").title() + " x"), (51, " ".join(prose(7, 13).split()[1:])), (52, prose(8, 20) * 2),
             (53, prose(6, 400) + " " + prose(7, 13))]
    docs = documents(spark).unionByName(documents(spark, extra))
    got = sorted((tuple(r)[:6] for r in decontam.contamination(docs, benchmark(spark)).drop("item_ids").collect()), key=str)
    want = sorted(((r.doc_id, *brute(r.text, ITEMS)) for r in docs.collect()), key=str)
    assert got == want


def test_stage_keeps_clean_rows_whole(spark):
    docs = documents(spark)
    kept = decontam.clean(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if not brute(r.text, ITEMS)[4])


def test_proximity_allows_words_out_of_place(spark):
    original = prose(7, 13).split()
    moved = original[:5] + ["extra"] + original[5:]
    swapped = [*original[:3], original[4], original[3], *original[5:]]
    far = original[:5] + ["a", "b", "c"] + original[5:]
    docs = documents(spark, [(1, " ".join(moved)), (2, " ".join(swapped)), (3, " ".join(far)), (4, " ".join(original))])
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontam.contamination(docs, benchmark(spark, [(9, " ".join(original))])).collect()}
    assert got == {1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (13, 0)}


def test_large_sides_are_shuffled_with_the_same_result(spark, monkeypatch):
    docs, items = documents(spark), benchmark(spark)
    before = sorted(map(str, decontam.contamination(docs, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_TERMS", 1)
    monkeypatch.setattr(decontam, "BROADCAST_TEXTS", 0)
    assert sorted(map(str, decontam.contamination(docs, items).collect())) == before


def test_empty_tables(spark):
    assert decontam.contamination(documents(spark).limit(0), benchmark(spark)).collect() == []
    clean = decontam.contamination(documents(spark), benchmark(spark).limit(0)).collect()
    assert len(clean) == documents(spark).count() and not any(r.contaminated or r.n_hit for r in clean)
