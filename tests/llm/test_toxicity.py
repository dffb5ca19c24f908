import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.messy import documents, prose
from tidemark.functions import session
from tidemark.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_and_trie_equal_edit_distance():
    words, stems = ["stupid", "scum", "idiot", "worthless"], ["loweis", "grub"]
    trie = toxicity.Trie(words, stems)
    letters = "abdiostu"
    tries = ["stupid", "scum", "scums", "loweisch", "grubxy", "grup", "worthles", "wortless", "xworthless", "idiots", "diot", "iidiot", ""]
    tries += [w[:i] + c + w[j:] for w in (*words, *stems) for i in range(len(w) + 1) for j in (i, i + 1) for c in (*letters, "")]
    for word in tries:
        near = [(distance(word, w), w) for w in words] + [(min(distance(word[:n], s) for n in range(len(word) + 1)), s) for s in stems]
        near = [(d, e) for d, e in near if d == 0 or d == 1 and len(e) >= toxicity.FUZZY_LETTERS]
        assert trie.match(word) == ((min(near)[1], min(near)[0]) if near else None), word


BAD = ["grobbel", "snarfid", "ploxer"]


def corpus(n=240):
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 30).split()
        if i % 4 == 0:
            words[5], words[6], words[20] = BAD[i % 3], BAD[(i + 1) % 3], BAD[i // 3 % 3]
        elif i % 4 == 1:
            words[5:7] = ["“" + BAD[i % 3] + "”", "said"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0), i))
    return rows, [*labels, (None, 1, 1, 0), (3, 1, None, 0)]


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = corpus()
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text int")
    return rows, labels, toxicity.learn(docs, marks.where(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_documents_are_told_apart(spark, learnt):
    rows, labels, model = learnt
    assert set(BAD) <= set(model.words) and not model.stems
    right = [(model.score(rows[i][1]) >= 0.7) == bool(t) for i, _, t, _ in labels if i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(right) > 50 and sum(right) == len(right)


def test_misspellings_count_and_quotations_do_not(learnt):
    *_, model = learnt
    clean = prose(999, 30)
    assert model.score(clean + " grobel snarfld ploxxer") > 0.7 > model.score(clean)
    assert model.score(f"{clean} the word “grobbel” and “snarfid” in a dictionary") < model.score(f"{clean} the word grobbel and snarfid in a dictionary")


def test_rows_and_columns_stay(spark, learnt):
    *_, model = learnt
    docs = documents(spark)
    out = toxicity.scored(docs, model)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(str((r.doc_id, r.text, r.pos)) for r in out.collect()) == sorted(str((r.doc_id, r.text, r.pos)) for r in docs.collect())
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_degenerate_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).score("anything") < 0.01
    assert toxicity.learn(docs, labels.limit(0)).score("anything") < 0.01
    assert toxicity.learn(docs.limit(0), labels).score("anything") < 0.01


def test_held_out_rule(spark):
    ids = [(0,), (7,), (-3,), (10 ** 12,), (None,)]
    got = {r.doc_id: r.h for r in spark.createDataFrame(ids, "doc_id long").select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(got[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, in ids if i is not None)


def test_many_words_and_long_stems_are_learnt(spark):
    stem = "zq" * 20  # forty letters, beyond what every word's prefixes cover
    words = [f"bad{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}x" for i in range(1100)]
    rows, labels = [], []
    for i in range(2400):
        body = prose(i, 12).split()
        if i % 2:
            body[3:3] = [words[(i // 2 * 7 + k) % 1100] for k in range(14)]
            body[9:9] = [stem + "abcdefghij"[i // 2 % 10] * 2]
        rows.append((i, " ".join(body)))
        labels.append((i, i % 2))
    docs = documents(spark, rows)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.words) + len(model.stems) > 0
    assert any(stem.startswith(s) or s.startswith(stem) for s in [*model.stems, *model.words])
    fresh = documents(spark, [(1, " ".join([prose(5000, 10), stem + "qq", *words[::100], prose(5001, 5)])), (2, prose(5002, 20))])
    got = {r.doc_id: r.score for r in toxicity.scored(fresh, model).collect()}
    assert got[1] > 0.5 > got[2]


def brute_score(model, text):
    """The score from the model's entries and weights by whole tables of edit distances and every pair of hits."""
    entries = [(w, w, False) for w in model.words] + [(s, s, True) for s in model.stems]

    def nearest(word):
        near = []
        for entry, letters, stem in entries:
            far = min(distance(word[:n], letters) for n in range(len(word) + 1)) if stem else distance(word, letters)
            if far == 0 or far == 1 and len(entry) >= 5 and entry not in model.exact:
                near.append((far, entry))
        return min(near, default=None)

    def evidence(chunk):
        best = (0.0, 0)
        for word in re.findall(r"[^\W_]+", chunk.lower()):
            near = nearest(word)
            if near and (near[0] == 0 or word not in model.clean):
                best = max(best, ({**model.stems, **model.words}[near[1]], near[0]))
        return best

    opening, closing = set("\"'“”„«»‘‚‹"), set("\"'“”»«’‘›")
    chunks = (text or "").split()
    begins = [c[0] in opening for c in chunks]
    ends = [bool(c.rstrip(".,;:!?")) and c.rstrip(".,;:!?")[-1] in closing for c in chunks]

    def quoted(i):
        before = [k for k in range(max(0, i - 5), i + 1) if begins[k] or ends[k]]
        after = [k for k in range(i, min(len(chunks), i + 6)) if begins[k] or ends[k]]
        return bool(before and after) and begins[before[-1]] and ends[after[0]]

    hits = [(i, *e) for i, c in enumerate(chunks) if (e := evidence(c))[0]]
    plain = sum(w for i, w, edits in hits if not edits and not quoted(i))
    misspelt = sum(w for i, w, edits in hits if edits and not quoted(i))
    inside = sum(w for i, w, _ in hits if quoted(i))
    company = [sum(w for j, w, _ in hits if i - 10 <= j < i) for i, *_ in hits if not quoted(i)]
    x = [1.0, *(math.log1p(v) for v in (plain, misspelt, inside, max(company, default=0.0), 100 * (plain + misspelt + inside) / max(len(chunks), 1)))]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, math.fsum(a * b for a, b in zip(model.weights, x, strict=True))))))


def test_scores_equal_brute_force(spark):
    model = toxicity.Model(
        {"stupid": 2.5, "scum": 1.25, "idiot": 3.0, "worthless": 0.75, "grobbel": 1.5}, {"loweis": 2.0, "grub": 1.0},
        frozenset({"idiom", "stupor"}), frozenset({"worthless"}), [-3.0, 1.5, 1.25, -0.5, 0.75, 0.4])
    chance = random.Random(4)
    pool = ["stupid", "Stupid,", "stupld", "scum", "scun", "idiot!", "idiom", "idiots", "worthles", "worthless", "loweisch", "loweischer", "lowies", "grubxy", "grupxy",
            "grobel", "stupor", "“idiot”", "\"scum", "stupid\"", "„loweisch“", "'", "«", "gone»,", "stupid-idiot", "scum_grub", "...", "É", "alpha", "beta", "gamma"]
    rows = [(i, " ".join(chance.choice(pool) if chance.random() < share else chance.choice(("alpha", "beta", "der", "la")) for _ in range(chance.randrange(40))))
            for i, share in enumerate([0.05, 0.2, 0.6] * 60)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "idiot " * 3000), (904, "stupid"), (905, "“stupid”"), (905, "“stupid”")]
    got = sorted((r.doc_id, r.text or "", r.score) for r in toxicity.scored(documents(spark, rows), model).collect())
    want = sorted((i, t or "", brute_score(model, t) if i != 903 else None) for i, t in rows)
    assert len(got) == len(want) and len({round(s, 9) for *_, s in got}) > 60
    for (i, t, s), (j, u, w) in zip(got, want, strict=True):
        assert (i, t) == (j, u)
        assert w is None and s > 0.99 or w is not None and abs(s - w) < 1e-9, (i, t, s, w)


def test_all_labelled_documents_are_learnt_from(spark, monkeypatch):
    used, fit = [], toxicity.fit_weights

    def spied(seen):
        used.append(seen.groupBy("toxic").agg({"n": "sum"}).collect())
        return fit(seen)

    monkeypatch.setattr(toxicity, "fit_weights", spied)
    docs = spark.range(20_400).selectExpr("id AS doc_id", "if(id % 4 = 0, concat('you badword', id % 50), concat('a fine day ', id % 70)) AS text")
    toxicity.learn(docs, docs.selectExpr("doc_id", "if(doc_id % 4 = 0, 1, 0) AS toxic"))
    assert {r[0]: r[1] for r in used[0]} == {0: 15_300, 1: 5_100}


def test_every_word_of_a_doc_id_has_its_least_context(spark):
    rows = [(1, 1, 1, "a b a c"), (2, 0, 2, "a b é"), (2, 0, 2, "x b a b b"), (3, 1, 1, ""), (4, 0, 1, "Solo"), (5, 1, 2, "b b"), (5, 1, 2, "b b")]
    known = spark.createDataFrame(rows, "doc_id long, toxic int, texts long, text string")
    near = lambda *words: [r[0] for r in spark.createDataFrame(words, "a string, b string").select(F.xxhash64("a", "b")).collect()]
    places = {}
    for doc_id, toxic, _, text in rows:
        words = text.lower().split()
        if words:
            pairs = list(zip([None, *words[:-1]], [*words[1:], None], strict=True))
            for word, context in zip(words, near(*pairs), strict=True):
                places.setdefault((doc_id, toxic, word), []).append(context)
    used = toxicity._used(known)
    assert sorted(tuple(r) for r in used.select("word", "near", "toxic").collect()) == sorted((w, min(c), t) for (_, t, w), c in places.items())
    # Documents with one text are not shuffled to tell their words apart.
    assert toxicity._used(known.where("texts = 1"))._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") <= 1


def test_stems_do_not_depend_on_how_they_meet_the_texts(spark, monkeypatch):
    rows, labels = [], []
    for i in range(400):
        body = prose(i, 12).split()
        if i % 4 == 0:
            body[3:3] = ["lowex" + "abcdefghij"[i // 4 % 10] * 2, "grobbel"]
        rows.append((i, " ".join(body)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = documents(spark, [*rows, rows[0], (4, "lowexzz again lowexzz")]), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    assert model.stems
    monkeypatch.setattr(toxicity, "NAMED_STEMMED", -1)
    monkeypatch.setattr(toxicity, "BROADCAST_STEMMED", 0)
    again = toxicity.learn(docs, marks)
    assert (again.words, again.stems, again.clean, again.exact) == (model.words, model.stems, model.clean, model.exact)


def test_learning_leaves_no_tables(spark, tmp_path, monkeypatch):
    made, fresh = [], session.fresh_dir
    monkeypatch.setattr(session, "fresh_dir", lambda spark, label: made.append(f"{tmp_path}/{label}-{len(made)}") or made[-1])
    rows, labels = corpus(80)
    toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text int"))
    assert fresh is not session.fresh_dir and made and not list(tmp_path.iterdir())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
