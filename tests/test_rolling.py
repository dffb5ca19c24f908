import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import rolling
from tidemark.streaming import monitor
from tidemark.streaming.tables import finish

N, THRESHOLD, COOLDOWN = 7, 0.3, 11


def _log(seed, count, keys):
    """Rows (key, seq, path, status): quiet stretches with bursts of errors, one key holding many rows."""
    rng = random.Random(seed)
    out, burst = [], 0
    for i in range(count):
        burst = max(0, burst - 1) or (rng.randint(5, 40) if rng.random() < 0.02 else 0)
        status = 500 if rng.random() < (0.6 if burst else 0.08) else 200
        out.append((keys[0] if rng.random() < 0.4 else rng.choice(keys), i, f"/p{rng.randint(0, 4)}", status))
    return out


def _expected(log):
    """The monitor as one would write it for a single list: (key, seq) -> rate, and the alerts."""
    seen, last, rates, alerts = defaultdict(list), {}, {}, []
    for key, seq, path, status in log:
        window = seen[key]
        window.append((seq, path, status == 500))
        recent = window[-N:]
        rates[seq] = (len(recent), sum(e for *_, e in recent))
        full = len(recent) == N
        place = len(window)
        if full and sum(e for *_, e in recent) / N > THRESHOLD and place - last.get(key, -COOLDOWN) >= COOLDOWN:
            last[key] = place
            alerts.append((seq, Counter(p for _, p, e in recent if e)))
    return rates, alerts


SCHEMA = "key STRING, seq INT, path STRING, status INT"
KEYS = ["a", "b", None, "c"]


@pytest.mark.parametrize("chunk_rows,block_rows", [(6, 11), (7, 13), (50, 64), (1000, 1000)])
def test_rates_and_alerts_match_a_plain_scan(spark, chunk_rows, block_rows):
    log = _log(chunk_rows, 1500, KEYS)
    want_rates, want_alerts = _expected(log)
    df = spark.createDataFrame(log, SCHEMA).repartition(5)
    rates = rolling.rolling_error_rate(
        df, F.col("status") == 500, ["seq"], N, ["key"], ["path"], chunk_rows)
    got = {r["seq"]: (r["window_rows"], r["window_errors"]) for r in rates.collect()}
    assert got == want_rates
    alerts = rolling.rolling_alerts(rates, N, THRESHOLD, COOLDOWN, ["key"], block_rows)
    assert sorted(r[0] for r in rows(alerts, "seq")) == [seq for seq, _ in want_alerts]

    snapshot = rolling.alert_snapshot(alerts, rates, "path", N, 2, ["key"])
    by_alert = defaultdict(list)
    for r in snapshot.join(alerts.select(F.col("rn").alias("alert_rn"), "seq"), "alert_rn").collect():
        by_alert[r["seq"]].append((r["place"], r["path"], r["errors"]))
    for seq, counts in want_alerts:
        best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
        assert sorted(by_alert[seq]) == [(i, p, c) for i, (p, c) in enumerate(best, 1)]


def test_one_stream_without_keys(spark):
    log = [("a", *rest) for _, *rest in _log(9, 1200, ["a"])]
    want_rates, want_alerts = _expected(log)
    rates = rolling.rolling_error_rate(
        spark.createDataFrame(log, SCHEMA), F.col("status") == 500, ["seq"], N, chunk_rows=31)
    assert {r["seq"]: (r["window_rows"], r["window_errors"]) for r in rates.collect()} == want_rates
    alerts = rolling.rolling_alerts(rates, N, THRESHOLD, COOLDOWN, block_rows=17)
    assert sorted(r[0] for r in rows(alerts, "seq")) == [seq for seq, _ in want_alerts]


def test_windows_and_cool_downs_beyond_a_chunk_or_block(spark):
    df = spark.range(1000).withColumnRenamed("id", "seq")
    rates = rolling.rolling_error_rate(df, F.col("seq") % 2 == 0, ["seq"], 300, chunk_rows=5)
    got = {r["seq"]: r["window_errors"] for r in rates.collect()}
    assert got == {s: sum(1 for x in range(max(0, s - 299), s + 1) if x % 2 == 0) for s in range(1000)}
    alerts = rolling.rolling_alerts(rates, 300, 0.4, 350, block_rows=7)
    assert sorted(r[0] for r in rows(alerts, "seq")) == [299, 649, 999]


def test_handing_on_agrees_with_walking():
    rng = random.Random(5)
    for _ in range(400):
        cooldown = rng.randint(1, 12)
        block = rng.randint(cooldown, 40)
        places = np.array(sorted(rng.sample(range(block), rng.randint(1, block))))
        starts, exits = rolling._transfer(places, places, cooldown, block)
        for state in range(cooldown + 1):
            free = state
            for p in places:
                if p >= free:
                    free = p + cooldown
            want = max(0, free - block) if free != state else 0
            assert exits[int(np.searchsorted(starts, state))] == want


def _walked(blocks, block_rows):
    """Entry states by walking the blocks one after the other."""
    key, free, entries = None, 0, {}
    for block, first_key, last_key, starts, exits in blocks:
        entries[block] = max(0, free - block * block_rows) if first_key == key else 0
        free = (block + 1) * block_rows + exits[int(np.searchsorted(starts, entries[block]))]
        key = last_key
    return entries


@pytest.mark.parametrize("seed,count", [(1, 1000), (2, 1), (3, 2), (4, 37)])
def test_entries_of_many_blocks_equal_a_walk(spark, monkeypatch, seed, count):
    rng, block_rows, cooldown = random.Random(seed), 20, 17
    blocks, block, key = [], 1000, "k0"
    for _ in range(count):
        block += 1 if rng.random() < 0.9 else rng.randint(2, 40)
        places = np.array(sorted(rng.sample(range(block_rows), rng.randint(1, 6))))
        first = key if rng.random() < 0.9 else f"k{block}"
        key = first if rng.random() < 0.8 else f"k{block}-end"
        spaced = places if key == first else np.append(places, places[-1] + cooldown + 1)
        starts, exits = rolling._transfer(places, spaced[:len(places)], cooldown, block_rows)
        blocks.append((block, first, key, [int(s) for s in starts], [int(x) for x in exits]))
    compose, sizes = rolling._compose, spark.sparkContext.accumulator(0)

    def at_most_two(rows):
        inner = compose(rows)

        def checked(pdf):
            if len(pdf) > 2:
                sizes.add(1)
            return inner(pdf)

        return checked

    monkeypatch.setattr(rolling, "_compose", at_most_two)
    steps = spark.createDataFrame(blocks, "block LONG, first_key STRING, last_key STRING, starts ARRAY<LONG>, exits ARRAY<LONG>")
    assert dict(rows(rolling.block_entries(steps, block_rows))) == _walked(blocks, block_rows)
    assert sizes.value == 0


@pytest.mark.parametrize("keys,quiet", [(["key"], 0), (["key"], 350), ([], 0), ([], 350)])
def test_stream_in_several_batches_equals_one_scan(spark, tmp_path, keys, quiet):
    log = _log(21, 900, KEYS if keys else ["a"])
    log = [(*row[:3], 200) if i < quiet else row for i, row in enumerate(log)]
    _, want = _expected(log)
    assert want
    source = tmp_path / "in"
    for start in range(0, 900, 300):
        spark.createDataFrame(log[start:start + 300], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = str(tmp_path / "out")
    finish(monitor.stream_monitor(
        stream, out, F.col("status") == 500, ["seq"], keys, ["path"], N, THRESHOLD, COOLDOWN, chunk_rows=40))
    assert sorted(r[0] for r in rows(monitor.monitor_alerts(spark, out), "seq")) == [seq for seq, _ in want]
