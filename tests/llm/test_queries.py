import duckdb
import pytest

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.CHECKS[name]})").fetchall()
    assert sorted(map(str, map(tuple, frame.select(*columns).collect()))) == sorted(map(str, want))


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
