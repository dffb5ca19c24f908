import hashlib
import re

import pytest

from tests.llm.messy import documents, prose
from tidemark.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
]


def brute(text):
    return sorted((m.start(), r, m.end(), kind) for r, (kind, pattern, test) in enumerate(BASE) for m in re.finditer(pattern, text or "") if test(m[0]))


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


TEXTS = ["a@b.c@d.e x+1 (555) 123-4567, 1.2.3.4.5", "a@b-c.dx@e.f a@b.c_d@e.f %+@x.y..z a@b a@b.c.", "999.1.1.1 256.1.1.1 255.255.255.255 001.002.003.0004 1.2.3",
         "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111", "1 " * 4000 + "7" * 4000, "é😀 bob@x.org 😀 +4930 1234567 ++1 22 333 4444", "a" * 30_000 + "@" + "b" * 50,
         "0" * 30_000, "+" * 5000 + "1", "+1" + " " * 5000, "mail@" * 2000, "1.2.3.4@5.6.7.8 +49(30)12345678.", "\n4111\n1111 1111 1111 1111", "@.@", "+12345678901234567"]


def test_base_spans_equal_the_patterns(spark):
    docs = documents(spark).unionByName(documents(spark, list(enumerate(TEXTS, 100))))
    got = pii.digest(pii.find(docs)).collect()
    want = sorted((str(r.doc_id), sha(brute(r.text)), *(sum(s[3] == k for s in brute(r.text)) for k in pii.KINDS)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want


def corpus(n=300):
    rows = []
    for i in range(n):
        words = prose(i, 25).split()
        part = 100 + i * 7 % 800
        words[4] = [f"card 4111 1111 1111 1111 {words[4]}", f"call +1 ({part}) 555-{1000 + i}", f"host 10.{i % 250}.3.{i % 200}", f"u{i}@mail.org", f"no 4111 1111 1111 {1112 + i % 50}"][i % 5]
        rows.append((i, " ".join(words)))
    return rows


def test_trees_keep_base_spans_and_add_what_looks_alike(spark):
    docs = documents(spark, corpus())
    spans = pii.stored(pii.candidates(docs))
    kept = pii.accepted(spans).collect()
    base = [(r.key, r.kind, r.start, r.end) for r in spans.where("base").collect()]
    assert set(map(str, base)) == {str((r.key, r.kind, r.start, r.end)) for r in kept if r.base}
    assert all(0 <= r.probability <= 1 for r in kept)
    added = [r for r in kept if not r.base]
    assert len(added) <= 0.1 * len(base)


LOOSE = [("email", "bob{i} at mail dot org"), ("card", "4111.1111.1111.1111"), ("phone", "(555) 123-4{i:03}"), ("", "2021-03-15"), ("", "4111.1111.1111.1112")]


def loose_corpus(n=300):
    """``corpus`` with numbers that are nothing, and a loose form in every second text: as many as there are base spans."""
    rows, planted = [], {}
    for i, text in corpus(n):
        words = text.split(" ")
        kind, form = LOOSE[i // 2 % len(LOOSE)]
        value = form.format(i=i)
        words[-3] = str(1000 + i)
        if i % 2:
            cue = {"email": "mail", "card": "card", "phone": "call"}.get(kind, "on")
            words += [cue, value, "and", "more"]
            start = len(" ".join(words[:-3])) + 1
            planted[i] = (kind, start, start + len(value))
        rows.append((i, " ".join(words)))
    return rows, planted


def test_common_loose_forms_are_added(spark):
    rows, planted = loose_corpus()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.find(documents(spark, rows)).collect()}
    for kind in ("email", "card", "phone"):
        mine = {i: span for i, span in planted.items() if span[0] == kind}
        assert len(mine) == 30 and all(span in found[i] for i, span in mine.items()), kind
    nothing = [i for i, span in planted.items() if not span[0]]
    assert len(nothing) == 60 and not any(a < planted[i][2] and planted[i][1] < b for i in nothing for _, a, b in found[i])


def test_nothing_is_added_inside_a_base_span(spark):
    rows, _ = loose_corpus()
    for r in pii.find(documents(spark, rows)).collect():
        base = [s for s in r.spans if s.base]
        assert not any(b.start <= s.start and s.end <= b.end for s in r.spans if not s.base for b in base)


def test_trees_and_thresholds_see_every_match(spark, monkeypatch):
    rows = [(i, " ".join(f"+1 555 {i:05}{n:03} x +7 {n:03}," for n in range(100))) for i in range(500)]
    seen, judged = [], pii._judged

    def spied(vectors, matches, *settings):
        seen.append(matches.groupBy("label").agg({"n": "sum"}).collect())
        return judged(vectors, matches, *settings)

    monkeypatch.setattr(pii, "_judged", spied)
    spans = pii.stored(pii.candidates(documents(spark, rows)))
    pii.accepted(spans)
    phones = spans.where("generator = 'phone'").groupBy("base").count().collect()
    assert {float(r["base"]): r["count"] for r in phones} == {0.0: 50_000, 1.0: 50_000}
    assert {r[0]: r[1] for r in seen[-1]} == {0.0: 50_000, 1.0: 50_000}


def test_redaction_replaces_every_span(spark):
    rows = [(1, "x a@b.cd y 4111 1111 1111 1111 z"), (2, None), (3, ""), (4, "no data"), (5, "+49 30 1234567, é1.2.3.4"), (6, "1.2.3.4"), (6, "1.2.3.4"), (7, prose(1, 20_000))]
    docs = documents(spark, rows)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1][0] == "x <EMAIL> y <CARD> z" and got[1][1] == len(got[1][0])
    assert got[5][0] == "<PHONE>, é<IP>" and got[6][0] == "<IP>" and got[2] == (None, None) and got[4][0] == "no data"
    assert got[7][0] == prose(1, 20_000)


@pytest.mark.parametrize("value", ["79927398713", "4111111111111111", "4111111111111112", "0", "18", "26"])
def test_luhn(spark, value):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii.luhn(F.lit(value))).first()[0] == luhn(value)


def test_empty_table(spark):
    assert pii.find(documents(spark).limit(0)).collect() == []
    assert pii.redact(documents(spark).limit(0)).collect() == []


def test_no_python_in_the_plans(spark):
    plan = pii.candidates(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
