import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import cleaning, quantiles, report, validation
from tidemark.sources.readers import SALES

RAW = [
    ("o1", "2025-01-01", "Seoul", "Food", "3", "100.0", "0.1"),
    ("o2", "not a date", "", "Food", "8", "", "0"),
    ("o3", "2025-01-03", " ", "Home", "x", "-50.0", "0"),
    ("o4", "2025-01-04", "Busan", "Home", "1995", "300.0", "0.05"),
    ("o5", "2025-01-05", "Busan", "Home", "5", "200.0", "0"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, ", ".join(f"{c} STRING" for c in SALES))


def test_text_that_does_not_parse_becomes_null(raw):
    got = rows(cleaning.normalise_types(raw, SALES))
    assert got[0] == ("o1", datetime.date(2025, 1, 1), "Seoul", "Food", 3, 100.0, 0.1)
    assert got[1][1] is None and got[1][2] is None and got[1][5] is None
    assert got[2][2] is None and got[2][4] is None and got[2][5] == -50.0


def test_both_timestamp_forms_parse(spark):
    df = spark.createDataFrame([("2025-01-01T10:00:00",), ("2025-01-01 10:00:00",), ("soon",)], "ts STRING")
    noon = datetime.datetime(2025, 1, 1, 10)
    assert rows(cleaning.normalise_types(df, {"ts": "timestamp_ntz"})) == [(noon,), (noon,), (None,)]


def test_null_profile_and_imputation(raw):
    typed = cleaning.normalise_types(raw, SALES)
    fixed = cleaning.fix_negative(typed, "unit_price")
    missing = dict(rows(cleaning.null_profile(fixed)))
    assert (missing["region"], missing["unit_price"], missing["quantity"], missing["order_id"]) == (2, 2, 1, 0)
    full = cleaning.impute(fixed, ["unit_price", "quantity"], ["region"])
    assert dict(rows(cleaning.null_profile(full)))["unit_price"] == 0
    assert [r[0] for r in rows(full, "unit_price")] == [100.0, 200.0, 200.0, 300.0, 200.0]
    assert [r[0] for r in rows(full, "region")] == ["Seoul", "Unknown", "Unknown", "Busan", "Busan"]
    assert full.count() == 5


def test_clip_keeps_rows_and_gaps_and_rounds_whole_columns(spark):
    data = [(v,) for v in list(range(1, 11)) * 20 + [1995, None]]
    df = spark.createDataFrame(data, "q INT")
    clipped = cleaning.clip_iqr(df, "q")
    assert clipped.agg(F.max("q")).first()[0] == 16
    assert clipped.count() == 202 and clipped.where("q IS NULL").count() == 1


def test_clean_report(raw):
    typed = cleaning.normalise_types(raw, SALES)
    clean = cleaning.impute(cleaning.fix_negative(typed, "unit_price"), ["unit_price", "quantity"], ["region"])
    got = rows(cleaning.clean_report(typed, clean, ["region", "unit_price", "quantity"], "quantity"))
    assert got == [("before", 5, 4, 1995), ("after", 5, 0, 1995)]


def test_set_where_leaves_other_rows_alone(raw):
    got = rows(cleaning.set_where(raw, F.col("region") == "Busan", "category", "moved"), "category")
    assert [g[0] for g in got] == ["Food", "Food", "Home", "moved", "moved"]


@pytest.mark.parametrize("values", [
    np.random.default_rng(0).normal(size=5000).round(2),
    np.repeat([1.0, 2.0, 3.0], [3000, 10, 2000]),
    np.array([5.0]),
])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, values):
    monkeypatch.setattr(quantiles, "_ACCURACY", 100)
    df = spark.createDataFrame([(float(v), float(-v)) for v in values] + [(None, None)], "a DOUBLE, b DOUBLE")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b"], probs)
    assert got["a"] == pytest.approx(np.quantile(values, probs))
    assert got["b"] == pytest.approx(np.quantile(-values, probs))


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "a DOUBLE")
    assert quantiles.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
    assert rows(cleaning.clip_iqr(df, "a")) == [(None,)]


def test_merge_matches_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k STRING, v INT")
    merged = report.merge_stats(df, ["k"], {"total": F.sum("v")})
    assert sorted(rows(merged, "v", "total")) == [(1, 4), (3, 4), (5, 5)]


# The ids of the records that fail, with the field that does.
USERS = [
    (7, "user_007", "user7@example.com", -5, 50.0),
    (13, "user_013", "not-an-email", 30, 50.0),
    (21, "user_021", None, 30, 50.0),
    (29, "user_029", "user29@example.com", 30, 150.0),
    (30, "user_030", "user30@example.com", 30, 100.0),
]


def test_user_rules_name_field_and_reason(spark):
    df = spark.createDataFrame(USERS, "id LONG, username STRING, email STRING, age INT, score DOUBLE")
    df = df.withColumn("profile", F.struct("score"))
    valid, invalid = validation.validate(df, validation.user_rules())
    assert rows(valid, "id") == [(30,)]
    assert rows(invalid.orderBy("id"), "id", "error_field", "error_message") == [
        (7, "age", "Input should be greater than or equal to 0"),
        (13, "email", "value is not a valid email address"),
        (21, "email", "Field required"),
        (29, "profile.score", "Input should be less than or equal to 100"),
    ]


def test_a_record_may_break_several_rules(spark):
    df = spark.createDataFrame([("p", None, 0, -1)], "product_id STRING, product_name STRING, price INT, stock INT")
    _, invalid = validation.validate(df, validation.product_rules())
    assert {r[0] for r in rows(invalid, "error_field")} == {"product_name", "price", "stock"}
