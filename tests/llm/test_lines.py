import pytest
from pyspark.sql import functions as F

from tests.llm.messy import documents, prose
from tidemark.llm import lines

COMMON = "  This line stands in MANY documents\t"
ROWS = [
    (1, f"{COMMON}\nfirst\n{prose(1, 5)}"), (2, f"{COMMON.strip().lower()}\n\n\n"), (3, f"a\n{COMMON}\n{COMMON.upper()}\nb"), (3, "b\n" + COMMON),
    (4, None), (5, ""), (None, COMMON), (None, None), (6, "\n".join(["short"] * 5)), (7, "short\nshort"), (8, "short"),
    (9, "ü" * 19 + "\n" + "é" * 20), (10, "ü" * 19 + "\r\n" + "é" * 20), (11, "\x0b" + "ü" * 19 + "\n" + "é" * 20),
    (12, f"{prose(1, 5)}\nx"), (13, f"y\n{prose(1, 5)}"), (13, f"y\n{prose(1, 5)}"), (14, "\n".join(prose(k, 6) for k in range(3000))),
    (15, "\n".join(prose(k, 6) for k in range(0, 3000, 2))), (16, "\n".join(prose(k, 6) for k in range(0, 3000, 3))),
    (17, "É" * 20 + "\n" + "é" * 20), (18, f"tail {COMMON.strip()}"),
]


def brute(rows, least=20, documents=3):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), {})[i] = doc_id
    top = {k: max((d for d in h.values() if d is not None), default=None) for k, h in holders.items() if len(k) >= least and len(h) >= documents}
    out = []
    for doc_id, text in rows:
        whole = (text or "").split("\n")
        kept = [t for t in whole if key(t) not in top or top[key(t)] == doc_id]
        out.append((doc_id, len(whole), len(whole) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_lines_equal_brute_force(spark, batches):
    got = lines.drop_repeated_lines(documents(spark, ROWS), batches=batches).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    assert any(r.n_dropped for r in got)


def test_other_thresholds(spark):
    got = lines.drop_repeated_lines(documents(spark, ROWS), least=5, documents=2).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, 5, 2)


def test_text_ids(spark):
    docs = documents(spark, ROWS).withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 2, "0")))
    want = brute([(None if d is None else f"d{d:02}", t) for d, t in ROWS])
    assert sorted(map(tuple, lines.drop_repeated_lines(docs).collect()), key=str) == want


def test_runs_merge_level_by_level(spark):
    runs = lines.Runs(spark, buckets=3)
    for b in range(5):
        runs.add(spark.range(b * 10, b * 10 + 10).select(F.unhex(F.md5(F.lit("hot"))).alias("line"), F.col("id").alias("doc_id")).union(
            spark.range(b, b + 2).select(F.unhex(F.md5(F.col("id").cast("string"))), F.col("id"))))
        # As in counting with two digits: 1, 10, 11, 100, 101 runs.
        assert [len(level) for level in runs.levels] == [int(d) for d in reversed(f"{b + 1:b}")]
    entries = {bytes(r.line): (r.n, r.top) for r in runs.entries().collect()}
    assert sorted(v for v in entries.values() if v[0] < 3) == [(1, 0), (1, 5), (2, 1), (2, 2), (2, 3), (2, 4)]
    assert [v[1] for v in entries.values() if v[0] >= 3] == [49]
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_settled_lines_are_not_written_again(spark):
    runs = lines.Runs(spark, buckets=2)
    for low in (100, 50):  # the second batch holds smaller ids only
        runs.add(spark.range(low, low + 5).select(F.unhex(F.md5(F.lit("hot"))).alias("line"), F.col("id").alias("doc_id")))
    (row,) = runs.entries().collect()
    runs.drop()
    assert (row.n, row.top) == (5, 104)


def test_merging_moves_no_rows(spark):
    runs = lines.Runs(spark, buckets=4)
    for b in range(2):
        runs._write(spark.range(100).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("line"), F.lit(1).cast("long").alias("n"),
                                            (F.col("id") + b).alias("top")).repartition(4, "line"), b)
    a, b = (spark.table(level[0]) for level in runs.levels)
    plan = a.join(b, "line", "full")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    runs.drop()


def test_empty_table(spark):
    assert lines.drop_repeated_lines(documents(spark).limit(0)).collect() == []
