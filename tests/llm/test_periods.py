import random
import zlib

import numpy as np
import pytest

from tests.llm.messy import documents, prose
from tidemark.llm import periods


def brute(words):
    """Runs by trying every period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def noisy(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 11, 12, 13, 40, 150, 400])
    words = [str(rng.randrange(rng.choice([1, 2, 3, 8, 40]))) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 3:
            at, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
            for i in range(max(at, p), min(n, at + rng.randrange(1, n))):
                words[i] = words[i - p]
    return words


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


SPECIAL = [fibonacci(300), thue_morse(4096), ["x"] * 700, ["x"] * 11, ["x"] * 12, "a b c d e f".split() * 2, "a b c d e f g".split() * 2,
           "a b c d e".split() * 2, ("a b " * 9 + "a c " * 9).split()]


def found(texts):
    _, _, spans, kept = periods._chunk(list(range(len(texts))), [" ".join(t).encode() for t in texts], None)
    return [[tuple(s) for s in x] for x in spans], [k.decode() for k in kept]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    texts = [noisy(100 * seed + k) for k in range(25)] + ([t for t in SPECIAL if len(t) < 1000] if seed == 0 else [])
    spans, kept = found(texts)
    for words, runs, text in zip(texts, spans, kept, strict=True):
        assert runs == brute(words)
        assert text == collapsed(words, runs)


def test_overlapping_squares_have_none_of_the_hash_faults():
    (runs,), _ = found([thue_morse(4096)])
    assert runs == brute(thue_morse(4096)) and all(length == 2 * period or length < 3 * period for _, length, period in runs)


def test_grammar_gives_the_words_back():
    texts = [noisy(k) for k in range(40)]
    texts = [[f"{k}:{w}" for w in t] for k, t in enumerate(texts) if t]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    ids = np.array([numbers[w] for t in texts for w in t])
    starts = np.cumsum([0, *[len(t) for t in texts]])[:-1]
    g = periods.repair(ids, starts)
    assert len(g.roots) == len(texts) and g.root_at.tolist() == starts.tolist()

    def words(symbol):
        if symbol < g.first:
            return [symbol]
        return words(g.left[symbol - g.first]) + words(g.right[symbol - g.first])

    assert [w for r in g.roots for w in words(r)] == ids.tolist()
    for rule in range(len(g.left)):
        whole = words(g.first + rule)
        assert ids[g.place[rule]:g.place[rule] + len(whole)].tolist() == whole


def test_repeats_make_few_rules():
    g = periods.repair(np.tile(np.arange(10), 1000), np.array([0]))
    assert len(g.left) < 60


def test_long_periodic_text_is_quick():
    words = [f"w{i % 1000}" for i in range(200_000)]
    (runs,), (kept,) = found([words])
    assert runs == [(0, 200_000, 1000)] and kept == " ".join(words[:1000])
    (runs,), _ = found([["x"] * 300_000])
    assert runs == [(0, 300_000, 1)]


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


def test_operator_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periods, "CHUNK_WORDS", 100)
    rows = [(k, " \n\t".join(noisy(k)) + (" \x0bünï" if k % 3 else "")) for k in range(60)]
    docs = documents(spark).where("length(text) < 10000 or text is null").unionByName(documents(spark, rows))
    want = []
    for r in docs.collect():
        words = planted(r.doc_id, (r.text or "").encode().decode("ascii", "surrogateescape").split())
        words = [w.encode("ascii", "surrogateescape").decode() for w in words]
        runs = brute(words)
        want.append((r.doc_id, len(words), runs, collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.find_runs(docs, periods.plant).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[2] for r in got)


def test_query_columns(spark, tmp_path):
    from tidemark.llm import queries

    rows = [(k, prose(k, 60)) for k in range(40)] + [(99, "a b " * 10 + prose(1, 5) + " c" * 20), (98, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == 42
    for doc_id, text in rows:
        runs = brute(planted(doc_id, (text or "").split()))
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (None if top[1] is None else 1000 * top[1] // top[2])


def test_empty_table(spark):
    assert periods.find_runs(documents(spark).limit(0)).collect() == []
