"""Streaming forms over the files of events and lineitem."""

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import fresh_dir
from tidemark.operators.sketches import sketched_profile
from tidemark.plans.monitoring import THRESHOLD, USER_COOLDOWN, USER_ROWS, USER_THRESHOLD, alerts_sql
from tidemark.plans.registry import query
from tidemark.plans.reports import LOG_BY_TYPE
from tidemark.plans.tables import Tables, is_error, priced_events, sales_lines
from tidemark.sources.readers import read_log_stream
from tidemark.streaming import ingest, late, logs, monitor
from tidemark.streaming.keyed import drain
from tidemark.streaming.tables import append_to, finish, latest, refresh_to
from tidemark.streaming.versions import published


def _events(t: Tables) -> DataFrame:
    return read_log_stream(t.spark, t.stream_path("events"), t.events.schema)


@query("stream_log_summary", """
    SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors,
           count(*) FILTER (event_type = 'error') / count(*) AS error_share FROM events""")
def stream_log_summary(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "summary")
    finish(refresh_to(logs.stream_log_summary(_events(t), is_error()), path))
    return latest(t.spark, path)


@query("stream_log_by_type", LOG_BY_TYPE)
def stream_log_by_type(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "bytype")
    finish(refresh_to(logs.stream_log_by(priced_events(_events(t)), "event_type", "cents"), path))
    return latest(t.spark, path)


@query("stream_hourly", """
    SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1
    HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR
           <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""")
def stream_hourly(t: Tables) -> DataFrame:
    """Hours that the watermark has closed."""
    path = fresh_dir(t.spark, "hourly")
    finish(append_to(logs.stream_hourly(_events(t), "ts"), path))
    return t.spark.read.parquet(f"{path}/data")


@query("stream_error_rate", """
    SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, count(*) AS total,
           count(*) FILTER (event_type = 'error') AS errors,
           count(*) FILTER (event_type = 'error') / count(*) AS error_rate
    FROM (SELECT event_type, unnest(generate_series(
              date_trunc('minute', ts) - INTERVAL 9 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE))
              AS window_start FROM events)
    GROUP BY 1
    HAVING window_start + INTERVAL 10 MINUTE
           <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""")
def stream_error_rate(t: Tables) -> DataFrame:
    """Ten-minute windows that the watermark has closed."""
    path = fresh_dir(t.spark, "rate")
    finish(append_to(logs.stream_error_rate(_events(t), is_error(), ts="ts"), path))
    return t.spark.read.parquet(f"{path}/data")


@query("stream_monitor", f"""
    {alerts_sql(300, THRESHOLD, 300)}
    SELECT event_id, ts, error_rate, window_errors FROM alerts""")
def stream_monitor(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "monitor")
    finish(monitor.stream_monitor(_events(t), path, is_error(), ["ts", "event_id"], threshold=THRESHOLD))
    return monitor.monitor_alerts(t.spark, path).select("event_id", "ts", "error_rate", "window_errors")


@query("stream_monitor_by_user", f"""
    {alerts_sql(USER_ROWS, USER_THRESHOLD, USER_COOLDOWN, 'user_id')}
    SELECT event_id, user_id, ts, error_rate, window_errors FROM alerts""")
def stream_monitor_by_user(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "monitor-by-user")
    finish(monitor.stream_monitor_by_key(
        _events(t), path, is_error(), ["ts", "event_id"], ["user_id"], n=USER_ROWS, threshold=USER_THRESHOLD, cooldown=USER_COOLDOWN))
    return t.spark.read.parquet(f"{path}/alerts")


@query("refresh_report", """
    SELECT row_number() OVER (ORDER BY total DESC) AS rank, g AS "group", n AS "count",
           cast(price_sum AS double) / n AS avg_price, cast(total AS double) AS total,
           round(cast(total AS double) / cast(max(total) OVER () AS double) * 100, 1) AS share_pct
    FROM (SELECT l_returnflag AS g, count(*) AS n, sum(cast(l_extendedprice AS decimal(12,2))) AS price_sum,
                 sum(cast(l_quantity AS integer) * cast(l_extendedprice AS decimal(12,2))
                     * (1 - cast(l_discount AS decimal(4,2)))) AS total
          FROM lineitem GROUP BY 1)""")
def refresh_report(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "report")
    lines = read_log_stream(t.spark, t.stream_path("lineitem"), t.lineitem.schema)
    finish(logs.refresh_report(sales_lines(lines, "l_returnflag"), "l_returnflag", path))
    return logs.current_report(t.spark, path, "l_returnflag")


@query("stream_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS missing, round(avg({c}), 6) AS mean,
           round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice")))
def stream_profile(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "profile")
    lines = read_log_stream(t.spark, t.stream_path("lineitem"), t.lineitem.schema)
    finish(logs.stream_profile(lines, path, ["l_quantity", "l_extendedprice"]))
    found = sketched_profile(published(t.spark, path), []).drop("n_distinct")
    return found.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("stream_hourly_accounted", """
    SELECT date_trunc('hour', ts) AS hour, count(*) AS n, date_trunc('hour', min(ts)) + INTERVAL 1 HOUR
           <= (SELECT date_trunc('millisecond', max(ts) - INTERVAL 10 MINUTE) FROM events) AS closed,
           (SELECT count(*) FROM events) AS all_rows, (SELECT count(*) FROM events WHERE ts IS NULL) AS set_aside
    FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def stream_hourly_accounted(t: Tables) -> DataFrame:
    """Every hour with its rows, beside the accounts of the whole stream."""
    path = fresh_dir(t.spark, "accounted")
    finish(late.stream_hourly_accounted(_events(t), path, "ts"))
    accounts = late.row_accounts(t.spark, path).select(
        F.col("rows").alias("all_rows"), (F.col("late") + F.col("untimed")).alias("set_aside"))
    kind = dict(t.events.dtypes)["ts"]
    return late.accounted_hours(t.spark, path, kind).crossJoin(F.broadcast(accounts))  # one row


def parse_event(items: pd.DataFrame, attempt: int) -> pd.DataFrame:
    """Errors below 60 parse from the second attempt on, larger ones never do."""
    k = items["props"].map(lambda p: json.loads(p).get("k") if p else None)
    ok = ((items["event_type"] != "error") | ((attempt > 1) & (items["value"] < 60))) & k.notna()
    return items.assign(k=k.where(ok).astype("Int32"), ok=ok)


@query("ingest", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN 1 WHEN value < 60 THEN 2 ELSE 3 END AS attempt,
           CASE WHEN event_type <> 'error' OR value < 60 THEN 'ok' ELSE 'dead' END AS outcome,
           CASE WHEN event_type <> 'error' OR value < 60 THEN cast(json_extract(props, '$.k') AS integer) END AS k
    FROM events""")
def ingest_events(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "ingest")
    drain(ingest.ingest(_events(t).select("event_id", "event_type", "value", "props"), parse_event, "k INT", path, wait_ms=0, slots=16))
    columns = ["event_id", "attempt"]
    return (
        ingest.ingested(t.spark, path).select(*columns, F.lit("ok").alias("outcome"), "k")
        .unionByName(ingest.dead_letters(t.spark, path).select(*columns, F.lit("dead").alias("outcome"), "k"))
    )
