import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import report
from tidemark.functions import session
from tidemark.streaming import ingest, logs, monitor
from tidemark.streaming.keyed import drain
from tidemark.streaming.tables import append_to, finish, latest, refresh_to

START = datetime.datetime(2025, 3, 1)
LOG = "timestamp TIMESTAMP_NTZ, status INT"


def _write(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def _at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def test_hours_close_with_the_watermark_and_late_rows_are_dropped(spark, tmp_path):
    _write(spark, tmp_path / "in", [(_at(m), 200) for m in (1, 30, 59, 61, 100)], LOG)
    _write(spark, tmp_path / "in", [(_at(m), 200) for m in (75, 130)], LOG)
    # By now the hour that minute 5 belongs to has been emitted.
    _write(spark, tmp_path / "in", [(_at(m), 200) for m in (5, 200)], LOG)
    finish(append_to(logs.stream_hourly(_stream(spark, tmp_path / "in", LOG)), str(tmp_path / "out")))
    got = rows(spark.read.parquet(str(tmp_path / "out" / "data")).orderBy("hour"))
    assert got == [(_at(0), 3), (_at(60), 3), (_at(120), 1)]


def test_sliding_rate_equals_the_batch_answer(spark, tmp_path):
    data = [(_at(m / 2), 500 if m % 7 == 0 else 200) for m in range(200)]
    _write(spark, tmp_path / "in", data[:120], LOG)
    _write(spark, tmp_path / "in", data[120:], LOG)
    stream = _stream(spark, tmp_path / "in", LOG)
    rate = logs.stream_error_rate(stream, F.col("status") == 500, "4 minutes", "2 minutes", delay="3 minutes")
    finish(append_to(rate, str(tmp_path / "out")))
    got = {r["window_start"]: (r["total"], r["errors"]) for r in
           spark.read.parquet(str(tmp_path / "out" / "data")).collect()}
    closed = _at(199 / 2) - datetime.timedelta(minutes=3)
    want = {}
    for start in range(-2, 100, 2):
        inside = [s for t, s in data if _at(start) <= t < _at(start + 4)]
        if inside and _at(start + 4) <= closed:
            want[_at(start)] = (len(inside), inside.count(500))
    assert got == want


def test_summary_adds_up_over_batches(spark, tmp_path):
    _write(spark, tmp_path / "in", [(_at(1), 500), (_at(2), 200)], LOG)
    _write(spark, tmp_path / "in", [(_at(3), 200), (_at(4), 503)], LOG)
    summary = logs.stream_log_summary(_stream(spark, tmp_path / "in", LOG), F.col("status") >= 500)
    finish(refresh_to(summary, str(tmp_path / "out")))
    assert rows(latest(spark, str(tmp_path / "out")), "total", "errors", "error_share") == [(4, 2, 0.5)]


SALES = "region STRING, quantity INT, unit_price DOUBLE, discount DOUBLE"


@pytest.mark.parametrize("trigger", [{"availableNow": True}, {"once": True}, {"processingTime": "1 second"}])
def test_every_trigger_ends_with_the_same_report(spark, tmp_path, trigger):
    data = [("Seoul", 2, 10.0, 0.0), ("Busan", 1, 50.0, 0.1), ("Seoul", 3, 20.0, 0.0), ("Daegu", 1, None, 0.0)]
    _write(spark, tmp_path / "in", data[:2], SALES)
    _write(spark, tmp_path / "in", data[2:], SALES)
    stream = spark.readStream.schema(SALES).parquet(str(tmp_path / "in"))
    query = logs.refresh_report(stream, "region", str(tmp_path / "out"), trigger)
    if "processingTime" in trigger:
        query.processAllAvailable()
        query.stop()
    else:
        finish(query)
    batch = report.sales_report(
        report.fold_sales(spark.createDataFrame(data, SALES), "region"), "region")
    assert rows(logs.current_report(spark, str(tmp_path / "out"), "region").orderBy("rank")) == rows(batch.orderBy("rank"))


ITEMS = "item INT, fails INT"


def _tries(items, attempt):
    return items.assign(ok=items["fails"] < attempt, answer=items["item"] * 10)


def _outcomes(spark, path):
    ok, dead = ingest.ingested(spark, path), ingest.dead_letters(spark, path)
    return sorted(rows(ok, "item", "attempt", "answer")), sorted(rows(dead, "item", "attempt"))


def test_retries_happen_in_the_stream_then_dead_letters(spark, tmp_path):
    for low in (0, 30):
        _write(spark, tmp_path / "in", [(i, i % 5) for i in range(low, low + 30)], ITEMS)
    path = str(tmp_path / "out")
    drain(ingest.ingest(_stream(spark, tmp_path / "in", ITEMS), _tries, "answer LONG", path, wait_ms=0, slots=3), 120)
    ok, dead = _outcomes(spark, path)
    assert ok == [(i, i % 5 + 1, 10 * i) for i in range(60) if i % 5 < 3]
    assert dead == [(i, 3) for i in range(60) if i % 5 >= 3]


def test_a_source_that_fails_restarts_and_recovers(spark, tmp_path):
    for low in (0, 20, 40):
        _write(spark, tmp_path / "in", [(i, i % 2) for i in range(low, low + 20)], ITEMS)
    down, path = tmp_path / "down", str(tmp_path / "out")
    down.touch()

    def fetch(items, attempt):
        return items.assign(ok=(items["fails"] == 0) | (not os.path.exists(down)), answer=items["item"])

    def start():
        return ingest.ingest(_stream(spark, tmp_path / "in", ITEMS), fetch, "answer LONG", path, max_attempts=20, wait_ms=50, slots=2)

    query = start()
    until = time.monotonic() + 120
    while not (query.lastProgress and query.lastProgress.batchId >= 4) and time.monotonic() < until:
        time.sleep(0.2)
    assert query.lastProgress.stateOperators[0].numRowsTotal > 0  # odd items wait
    query.stop()
    assert {r[0] for r in rows(ingest.ingested(spark, path), "item")} <= set(range(0, 60, 2))
    down.unlink()
    _write(spark, tmp_path / "in", [(i, 0) for i in range(60, 70)], ITEMS)
    drain(start(), 120)
    ok, dead = _outcomes(spark, path)
    assert [r[0] for r in ok] == list(range(70)) and not dead  # every item once
    assert all((attempt > 1) == (item < 60 and item % 2 == 1) for item, attempt, _ in ok)


def test_an_intake_without_failures_has_no_dead_letters(spark, tmp_path):
    _write(spark, tmp_path / "in", [(1, 0), (1, 0), (None, 0)], ITEMS)
    path = str(tmp_path / "out")
    drain(ingest.ingest(_stream(spark, tmp_path / "in", ITEMS), _tries, "answer LONG", path, slots=2), 120)
    assert (ingest.ingested(spark, path).count(), ingest.dead_letters(spark, path).count()) == (3, 0)


KEYED = "line LONG, key STRING, status INT"


def _keyed_monitor(spark, tmp_path, n=5, threshold=0.3, cooldown=4):
    return monitor.stream_monitor_by_key(
        _stream(spark, tmp_path / "in", KEYED), str(tmp_path / "out"), F.col("status") == 500, ["line"], ["key"], [], n, threshold, cooldown)


def _plain_alerts(log, n=5, threshold=0.3, cooldown=4):
    seen, last, fired = {}, {}, []
    for line, key, status in log:
        window = seen.setdefault(key, [])
        window.append(status == 500)
        if len(window) >= n and sum(window[-n:]) / n > threshold and len(window) - last.get(key, -cooldown) >= cooldown:
            last[key] = len(window)
            fired.append((line, key, sum(window[-n:])))
    return sorted(fired)


def test_keyed_monitor_goes_on_after_restarts(spark, tmp_path):
    rng, log = random.Random(4), []
    keys = ["a", "a", "a", "b", None, "c"]
    for k in range(5):
        part = [(100 * k + i, rng.choice(keys), 500 if rng.random() < 0.35 else 200) for i in range(rng.choice([3, 60]))]
        log += part
        _write(spark, tmp_path / "in", part, KEYED)
        finish(_keyed_monitor(spark, tmp_path), 120)  # each batch is a query of its own
    got = rows(spark.read.parquet(str(tmp_path / "out" / "alerts")), "line", "key", "window_errors")
    assert sorted(got) == _plain_alerts(log) and len(got) > 5


def test_keyed_state_written_follows_the_keys_of_the_batch(spark, tmp_path):
    _write(spark, tmp_path / "in", [(i, f"k{i % 500}", 200) for i in range(3000)], KEYED)
    _write(spark, tmp_path / "in", [(3000 + i, "k7", 500) for i in range(10)], KEYED)
    query = _keyed_monitor(spark, tmp_path)
    finish(query, 120)
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    totals = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.numInputRows]
    assert updated[1] <= 2 < 500 <= updated[0] and totals[1] >= 500
    assert rows(spark.read.parquet(str(tmp_path / "out" / "alerts")), "line") == [(3001,), (3005,), (3009,)]


def test_quiet_keys_are_forgotten(spark, tmp_path):
    _write(spark, tmp_path / "in", [(i, f"k{i}", 200) for i in range(20)], KEYED)
    query = monitor.stream_monitor_by_key(
        _stream(spark, tmp_path / "in", KEYED), str(tmp_path / "out"), F.col("status") == 500, ["line"], ["key"],
        idle_ms=1, trigger={"processingTime": "0 seconds"})
    drain(query, 120)  # ends when no state is left
    assert query.lastProgress.stateOperators[0].numRowsTotal == 0


def _files(path):
    return sum(len(names) for _, _, names in os.walk(path))


def test_storage_stays_flat_over_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root = session.shared_dir(spark).removeprefix("file:")
    counts = []
    schema = "line LONG, key STRING, status INT"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for k in range(8):
        _write(spark, tmp_path / "in", [(100 * k + i, f"k{i % 3}", 500 if i % 4 == 0 else 200) for i in range(60)], schema)
        finish(monitor.stream_monitor(stream, str(tmp_path / "out"), F.col("status") == 500, ["line"], ["key"], n=5, threshold=0.3, cooldown=4))
        finish(logs.refresh_report(
            stream.selectExpr("key AS region", "1 AS quantity", "2.0 AS unit_price", "0.0 AS discount"), "region", str(tmp_path / "report")))
        counts.append((_files(root), _files(tmp_path / "out" / "state"), len(os.listdir(tmp_path / "report" / "data"))))
    assert len({c[0] for c in counts[1:]}) == 1 and len({c[1] for c in counts[2:]}) == 1
    assert counts[-1][2] == 2
