import re

import corpus_pipeline
import pytest
from tests.conftest import rows
from tests.llm.messy import EXTRAS, LONG, prose
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_pii import brute as private
from tests.llm.test_simhash import brute_print, classes
from tidemark.functions.session import fresh_dir

BAD = ["grobbel", "snarfid", "ploxer"]


@pytest.fixture(scope="module")
def folder(spark):
    path = fresh_dir(spark, "pipeline-test")
    docs, labels = [], []
    for i in range(200):
        words = prose(i, 30).split()
        if i % 4 == 0:
            words[3], words[9], words[17] = BAD[i % 3], BAD[(i + 1) % 3], BAD[i // 3 % 3]
        if i % 10 == 1:
            words[5] = f"u{i}@mail.org"
        if i % 10 == 2:
            words[:13] = prose(7000, 13).split()
        docs.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 4 == 0)))
    docs += [(300 + i, docs[3 + 4 * i][1]) for i in range(10)] + [(400, None), (401, ""), (None, prose(900, 20)), (402, LONG), (1, docs[1][1])]
    extras = "".join(f", {c} int" for c in EXTRAS)
    spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), *[k] * len(EXTRAS)) for k, (i, t) in enumerate(docs)],
                          f"doc_id long, text string, lang string, source string, n_chars long{extras}").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(7000, 13)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, given = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh_dir(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == names
        kept = docs.collect()
        if name == "toxicity":
            want = [r for r in given if not any(b in (r.text or "") for b in BAD)]
        elif name == "near_duplicates":
            root, least = classes({brute_print(r.text) for r in given}), {}
            for r in given:
                k = root[brute_print(r.text)]
                least[k] = min(least.get(k, r), r, key=lambda x: (x.doc_id is None, x.doc_id or 0))
            want = list(least.values())
        elif name == "decontamination":
            want = [r for r in given if not contaminated(r.text, [(1, prose(7000, 13))])[4]]
        else:
            want = [r.asDict() | {"text": re.sub(r"\S+@mail\.org", "<EMAIL>", r.text)} if private(r.text) else r.asDict() for r in given]
            want = [spark_row(r | {"n_chars": len(r["text"]) if r["text"] is not None else None}, names) for r in want]
        assert sorted(map(str, map(tuple, kept))) == sorted(map(str, map(tuple, want))), name
        given = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in given}


def spark_row(values, names):
    return tuple(values[n] for n in names)


def test_run_and_empty_documents(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 50
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == []
