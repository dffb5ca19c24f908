"""Every query against its SQL on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = duck.execute(contract.oracle_sql()[name])
    want = _sorted([c[0] for c in cursor.description], cursor.fetchall())
    assert _sorted(df.columns, df.collect()) == want


def test_every_check_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 6
