import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import quantiles, sketches
from tidemark.streaming import late, logs, versions
from tidemark.streaming.tables import finish

START = datetime.datetime(2025, 3, 1)
LOG = "timestamp TIMESTAMP_NTZ, status INT"
COUNTS = "name STRING, n INT"


def _write(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def _at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def _put(spark, path, batch, data, buckets=4):
    versions.change(spark, path, batch, spark.createDataFrame(data, COUNTS), "name", versions.replace_by("name"), buckets)


def test_changes_replace_their_keys_and_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    _put(spark, path, 0, [(f"k{i}", i) for i in range(40)] + [(None, -1)], 16)
    _put(spark, path, 1, [("k3", 300), (None, -2), ("new", 7)], 16)
    want = {f"k{i}": i for i in range(40)} | {"k3": 300, None: -2, "new": 7}
    assert dict(rows(versions.published(spark, path))) == want
    assert len([f for f in os.listdir(f"{path}/data/version=1") if f.startswith("_bucket")]) <= 3


def test_a_crash_before_publishing_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _put(spark, path, 0, [("a", 1), ("b", 2)])

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", crash)
        with pytest.raises(OSError):
            _put(spark, path, 1, [("a", 10), ("c", 3)])
    assert os.path.isdir(f"{path}/data/version=1")
    assert dict(rows(versions.published(spark, path))) == {"a": 1, "b": 2}
    _put(spark, path, 1, [("a", 10), ("c", 3)])  # the batch runs again
    assert dict(rows(versions.published(spark, path))) == {"a": 10, "b": 2, "c": 3}
    _put(spark, path, 1, [("a", 99)])  # published already: nothing changes
    assert dict(rows(versions.published(spark, path))) == {"a": 10, "b": 2, "c": 3}


def test_old_versions_go_but_the_one_before_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    readers = []
    for k in range(6):
        _put(spark, path, k, [("a", k)])
        readers.append(versions.published(spark, path))
        assert dict(rows(readers[max(0, k - 1)])) == {"a": max(0, k - 1)}
    assert sorted(os.listdir(f"{path}/data")) == ["version=4", "version=5"]


def test_nothing_published_and_empty_changes(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        versions.published(spark, str(tmp_path / "none"))
    _put(spark, str(tmp_path / "t"), 0, [])
    assert rows(versions.published(spark, str(tmp_path / "t"))) == []


def test_no_row_goes_missing_behind_the_watermark(spark, tmp_path):
    files = [(1, 30, 59, 61, 100), (75, 130), (5, 200, 62), (10, 131, None, 131), (300, 199, 100)]
    hours, aside, newest = {}, [], None
    for batch, minutes in enumerate(files):
        _write(spark, tmp_path / "in", [(None if m is None else _at(m), batch) for m in minutes], LOG)
        closed = None if newest is None else newest - 10
        for m in minutes:
            if m is None or (closed is not None and m // 60 * 60 + 60 <= closed):
                aside.append((None if m is None else _at(m), batch))
            else:
                hours[m // 60] = hours.get(m // 60, 0) + 1
        newest = max([m for m in minutes if m is not None] + ([] if newest is None else [newest]))
        # One batch a run, each after a restart.
        finish(late.stream_hourly_accounted(_stream(spark, tmp_path / "in", LOG), str(tmp_path / "out")))
        account = late.row_accounts(spark, str(tmp_path / "out")).first()
        assert account["on_time"] + account["late"] + account["untimed"] == account["rows"] == sum(map(len, files[:batch + 1]))
        assert account["on_time"] == sum(hours.values())
    out = str(tmp_path / "out")
    assert sorted(rows(late.accounted_hours(spark, out))) == sorted((_at(60 * h), n, 60 * h + 60 <= newest - 10) for h, n in hours.items())
    got = rows(late.late_rows(spark, out), "timestamp", "status")
    assert sorted(got, key=str) == sorted(aside, key=str)
    assert {m for m, _ in got} == {_at(5), _at(10), _at(62), _at(100), _at(131), None}


def test_a_stream_of_nulls_alone_has_no_hours(spark, tmp_path):
    _write(spark, tmp_path / "in", [(None, 1), (None, 2)], LOG)
    finish(late.stream_hourly_accounted(_stream(spark, tmp_path / "in", LOG), str(tmp_path / "out")))
    assert rows(late.accounted_hours(spark, str(tmp_path / "out"))) == []
    assert rows(late.row_accounts(spark, str(tmp_path / "out"))) == [(2, 0, 0, 2)]


def _numbers(spark, n, seed=5):
    pick = random.Random(seed)
    data = [(None if i % 50 == 0 else float("nan") if i % 51 == 0 else pick.expovariate(1.0) * 100, pick.randrange(7), i % 5) for i in range(n)]
    return spark.createDataFrame(data, "x DOUBLE, y INT, part INT"), data


def test_merged_states_are_those_of_the_whole(spark):
    df, data = _numbers(spark, 40_000)
    merged = sketches.merge(sketches.sketch(df, ["x", "y"], "part"))
    found = {r["column"]: r for r in sketches.sketched_profile(merged).collect()}
    whole = {r["column"]: r for r in sketches.sketched_profile(sketches.sketch(df, ["x", "y"])).collect()}
    values = sorted(v for v, _, _ in data if v is not None and v == v)
    mean = sum(values) / len(values)
    x = found["x"]
    assert (x["n"], x["missing"], x["min"], x["max"]) == (len(values), len(data) - len(values), values[0], values[-1])
    assert x["mean"] == pytest.approx(mean) and x["std"] == pytest.approx(whole["x"]["std"])
    assert x["std"] == pytest.approx((sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5)
    for r in (x, whole["x"]):
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            rank = sum(v <= r[q] for v in values) / len(values)
            assert abs(rank - p) <= 3 * sketches.RANK_ERROR
        assert abs(r["n_distinct"] / len(set(values)) - 1) <= 4 * sketches.DISTINCT_ERROR
    assert found["y"]["n_distinct"] == 7


def test_refined_quantiles_are_exact_and_missed_brackets_widen(spark, monkeypatch):
    df, _ = _numbers(spark, 20_000)
    clean = df.select(F.nanvl("x", F.lit(None).cast("double")).alias("x"), "y")
    want = quantiles.exact_quantiles(clean, ["x", "y"], [0.1, 0.5, 0.99])
    states = sketches.sketch(df, ["x", "y"])
    assert sketches.refine(df, states, [0.1, 0.5, 0.99]) == want
    monkeypatch.setattr(sketches, "RANK_ERROR", 1e-7)  # brackets that enclose nothing at first
    assert sketches.refine(df, states, [0.1, 0.5, 0.99]) == want


def test_sketches_of_no_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "x DOUBLE, y INT")
    for table, missing in ((df, 2), (df.limit(0), 0)):
        states = sketches.merge(sketches.sketch(table, ["x"]))
        got = sketches.sketched_profile(states).first().asDict()
        assert (got["n"], got["missing"], got["n_distinct"]) == (0, missing, 0)
        assert all(got[c] is None for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
        assert sketches.refine(table, states, [0.5]) == {"x": [None]}


def test_a_streamed_profile_is_that_of_all_rows(spark, tmp_path):
    df, data = _numbers(spark, 6_000)
    for k in range(3):
        df.where(F.col("part") % 3 == k).drop("part").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    finish(logs.stream_profile(_stream(spark, tmp_path / "in", "x DOUBLE, y INT"), str(tmp_path / "out"), ["x", "y"]))
    states = versions.published(spark, str(tmp_path / "out"))
    plain = ("column", "n", "missing", "min", "max")
    assert sorted(rows(states, *plain)) == sorted(rows(sketches.sketch(df, ["x", "y"]), *plain))
    values = sorted(v for v, _, _ in data if v is not None and v == v)
    median = {r["column"]: r["q50"] for r in sketches.sketched_profile(states).collect()}["x"]
    assert abs(sum(v <= median for v in values) / len(values) - 0.5) <= 3 * sketches.RANK_ERROR
