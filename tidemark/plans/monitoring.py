"""Rolling error rate, alerts and snapshots, in batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import rolling
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, is_error

# One event in five is an error, so the alarm is set at a quarter above that.
THRESHOLD = 0.24
USER_ROWS, USER_THRESHOLD, USER_COOLDOWN = 20, 0.35, 10


def _rates_sql(n: int, key: str = "") -> str:
    by = f"PARTITION BY {key} " if key else ""
    lead = f"{key}, " if key else ""
    return f"""
        SELECT *, window_errors / window_rows AS error_rate FROM (
            SELECT event_id, user_id, ts, event_type = 'error' AS is_error,
                   row_number() OVER (ORDER BY {lead}ts, event_id) AS rn,
                   count(*) OVER w AS window_rows,
                   cast(sum((event_type = 'error')::integer) OVER w AS bigint) AS window_errors
            FROM events
            WINDOW w AS ({by}ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))"""


def alerts_sql(n: int, threshold: float, cooldown: int, key: str = "") -> str:
    k = key or "0"
    return f"""
        WITH RECURSIVE rates AS ({_rates_sql(n, key)}),
        breaches AS (SELECT {k} AS k, rn FROM rates WHERE window_rows = {n} AND error_rate > {threshold}),
        onward AS (SELECT b.k, b.rn, min(c.rn) AS next_rn
                   FROM breaches b LEFT JOIN breaches c ON c.k = b.k AND c.rn >= b.rn + {cooldown}
                   GROUP BY ALL),
        fired AS (SELECT k, min(rn) AS rn FROM breaches GROUP BY k
                  UNION ALL
                  SELECT f.k, o.next_rn FROM fired f JOIN onward o ON o.k = f.k AND o.rn = f.rn
                  WHERE o.next_rn IS NOT NULL),
        alerts AS (SELECT rates.* FROM rates JOIN fired ON rates.rn = fired.rn)"""


_COLUMNS = "event_id, user_id, ts, is_error, rn, window_rows, window_errors, error_rate"


def rates(t: Tables) -> DataFrame:
    return rolling.rolling_error_rate(t.events, is_error(), ["ts", "event_id"], keep=["user_id"])


def user_rates(t: Tables) -> DataFrame:
    return rolling.rolling_error_rate(t.events, is_error(), ["ts", "event_id"], USER_ROWS, ["user_id"])


@query("rolling_error_rate", f"SELECT {_COLUMNS} FROM ({_rates_sql(300)})")
def rolling_error_rate(t: Tables) -> DataFrame:
    return rates(t)


@query("rolling_error_rate_by_user", f"SELECT {_COLUMNS} FROM ({_rates_sql(USER_ROWS, 'user_id')})")
def rolling_error_rate_by_user(t: Tables) -> DataFrame:
    return user_rates(t)


@query("rolling_alerts", f"{alerts_sql(300, THRESHOLD, 300)} SELECT {_COLUMNS} FROM alerts")
def rolling_alerts(t: Tables) -> DataFrame:
    return rolling.rolling_alerts(rates(t), threshold=THRESHOLD)


@query("rolling_alerts_by_user", f"""
    {alerts_sql(USER_ROWS, USER_THRESHOLD, USER_COOLDOWN, 'user_id')} SELECT {_COLUMNS} FROM alerts""")
def rolling_alerts_by_user(t: Tables) -> DataFrame:
    return rolling.rolling_alerts(user_rates(t), USER_ROWS, USER_THRESHOLD, USER_COOLDOWN, ["user_id"])


@query("alert_snapshot", f"""
    {alerts_sql(300, THRESHOLD, 300)}
    SELECT alert_rn, path, errors, place FROM (
        SELECT *, row_number() OVER (PARTITION BY alert_rn ORDER BY errors DESC, path) AS place FROM (
            SELECT a.rn AS alert_rn, '/user/' || r.user_id AS path, count(*) AS errors
            FROM alerts a JOIN rates r ON r.rn BETWEEN a.rn - 299 AND a.rn AND r.is_error
            GROUP BY ALL))
    WHERE place <= 3""")
def alert_snapshot(t: Tables) -> DataFrame:
    seen = rates(t).withColumn("path", F.concat(F.lit("/user/"), F.col("user_id").cast("string")))
    return rolling.alert_snapshot(rolling.rolling_alerts(seen, threshold=THRESHOLD), seen, "path")
