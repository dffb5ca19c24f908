"""Statistical tests over orders and events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import stats
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, user_habits


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, p) for c, p in places.items()})


def _simpson(density: str, upper: str, steps: int = 4000) -> str:
    """Integral of ``density`` (in x) from 0 to ``upper``."""
    return f"""(SELECT sum(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * ({density}))
                       * {upper} / {steps} / 3
                FROM (SELECT i, i * {upper} / {steps} AS x FROM range({steps + 1}) AS r(i)))"""


def _normal_two_sided(z: str) -> str:
    return f"1 - 2 * {_simpson('exp(-x * x / 2) / sqrt(2 * pi())', f'abs({z})')}"


_T_DENSITY = """exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())
                * pow(1 + x * x / dof, -(dof + 1) / 2)"""


def _t_sql(welch: bool) -> str:
    spread, dof = ("v1 / n1 + v2 / n2", """pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1)
                   + pow(v2 / n2, 2) / (n2 - 1))""") if welch else (
        "((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)", "cast(n1 + n2 - 2 AS double)")
    return f"""
        WITH m AS (
            SELECT count(*) FILTER (o_orderstatus = 'F') AS n1, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m1,
                   var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v1,
                   count(*) FILTER (o_orderstatus = 'O') AS n2, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m2,
                   var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS v2
            FROM orders),
        s AS (SELECT *, (m1 - m2) / sqrt({spread}) AS t, {dof} AS dof FROM m)
        SELECT n1, round(m1, 4) AS mean1, round(v1, 1) AS var1, n2, round(m2, 4) AS mean2, round(v2, 1) AS var2,
               round(t, 8) AS t, round(dof, 4) AS dof,
               round(1 - 2 * {_simpson(_T_DENSITY, 'abs(t)')}, 8) AS p_value
        FROM s"""


def _t(t: Tables, welch: bool) -> DataFrame:
    result = stats.t_test(t.orders, "o_totalprice", "o_orderstatus", "F", "O", welch)
    return _rounded(result, mean1=4, var1=1, mean2=4, var2=1, t=8, dof=4, p_value=8)


@query("t_test", _t_sql(True))
def t_test(t: Tables) -> DataFrame:
    return _t(t, True)


@query("t_test_pooled", _t_sql(False))
def t_test_pooled(t: Tables) -> DataFrame:
    return _t(t, False)


@query("group_means", """
    SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1""")
def group_means(t: Tables) -> DataFrame:
    return _rounded(stats.group_means(t.orders, "o_totalprice", "o_orderstatus"), mean=4)


_CELLS = """
    SELECT sum(n) AS n, sum(CASE WHEN {yates} THEN pow(abs(n - e) - least(0.5, abs(n - e)), 2) ELSE pow(n - e, 2)
           END / e) AS statistic, min(e) AS min_expected
    FROM (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e
          FROM (SELECT {a} AS a, {b} AS b, count(*) AS n FROM orders GROUP BY ALL))"""


@query("chi_square", f"""
    SELECT cast(n AS bigint) AS n, round(statistic, 6) AS statistic, 8 AS dof,
           round(min_expected, 6) AS min_expected, min_expected >= 5 AS reliable,
           round(exp(-statistic / 2) * (1 + statistic / 2 + pow(statistic / 2, 2) / 2
                                        + pow(statistic / 2, 3) / 6), 8) AS p_value
    FROM ({_CELLS.format(yates='false', a='o_orderstatus', b='o_orderpriority')})""")
def chi_square(t: Tables) -> DataFrame:
    result = stats.chi_square(t.orders, "o_orderstatus", "o_orderpriority")
    return _rounded(result, statistic=6, min_expected=6, p_value=8).withColumn("dof", F.col("dof").cast("int"))


@query("chi_square_2x2", f"""
    SELECT cast(n AS bigint) AS n, round(statistic, 6) AS statistic, 1 AS dof,
           round(min_expected, 6) AS min_expected, min_expected >= 5 AS reliable,
           round({_normal_two_sided('sqrt(statistic)')}, 8) AS p_value
    FROM ({_CELLS.format(yates='true', a="o_orderstatus = 'F'", b="o_orderpriority = '1-URGENT'")})""")
def chi_square_2x2(t: Tables) -> DataFrame:
    flags = t.orders.select(
        (F.col("o_orderstatus") == "F").alias("finished"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    result = stats.chi_square(flags, "finished", "urgent")
    return _rounded(result, statistic=6, min_expected=6, p_value=8).withColumn("dof", F.col("dof").cast("int"))


@query("expected_min", f"""
    SELECT cast(n AS bigint) AS n, round(min_expected, 6) AS min_expected
    FROM ({_CELLS.format(yates='false', a='o_orderstatus', b='o_orderpriority')})""")
def expected_min(t: Tables) -> DataFrame:
    return _rounded(stats.expected_min(t.orders, "o_orderstatus", "o_orderpriority"), min_expected=6)


@query("fisher_exact", """
    WITH u AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') >= 13 AS buys,
                      count(*) FILTER (event_type = 'click') >= 13 AS clicks FROM events GROUP BY 1),
    c AS (SELECT count(*) FILTER (buys AND clicks) AS a, count(*) FILTER (buys AND NOT clicks) AS b,
                 count(*) FILTER (NOT buys AND clicks) AS c, count(*) FILTER (NOT buys AND NOT clicks) AS d FROM u),
    p AS (SELECT k, lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1)
                    - lgamma(a + b + c + d + 1) - lgamma(k + 1) - lgamma(a + b - k + 1)
                    - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) AS log_p, a
          FROM c, range(0, 1000000) AS r(k)
          WHERE k >= a - d AND k <= a + b AND k <= a + c)
    SELECT c.a AS "both", c.b AS only_a, c.c AS only_b, c.d AS neither,
           round((SELECT sum(exp(log_p)) FROM p WHERE log_p <= (SELECT log_p FROM p WHERE k = a) + 1e-7), 8)
           AS p_value
    FROM c""")
def fisher_exact(t: Tables) -> DataFrame:
    return _rounded(stats.fisher_exact(user_habits(t.events), F.col("buys"), F.col("clicks")), p_value=8)


_RANKS = """
    WITH r AS (
        SELECT o_orderstatus AS g, rank() OVER (ORDER BY o_totalprice)
               + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2 AS r,
               count(*) OVER (PARTITION BY o_totalprice) AS t
        FROM orders WHERE {where}),
    s AS (SELECT count(*) FILTER (g = 'F') AS n1, count(*) FILTER (g <> 'F') AS n2,
                 sum(r) FILTER (g = 'F') AS rank_sum, sum(cast(t AS double) * t - 1) AS ties FROM r),
    u AS (SELECT *, rank_sum - n1 * (n1 + 1) / 2 AS u, n1 + n2 AS n FROM s)"""


@query("mann_whitney", f"""
    {_RANKS.format(where="o_orderstatus IN ('F', 'O')")},
    z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
                    / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))) AS z FROM u)
    SELECT n1, n2, u, round(z, 8) AS z, round({_normal_two_sided('z')}, 8) AS p_value FROM z""")
def mann_whitney(t: Tables) -> DataFrame:
    result = stats.mann_whitney(t.orders, "o_totalprice", "o_orderstatus", "F", "O")
    return _rounded(result, z=8, p_value=8)


@query("roc_auc", f"""
    {_RANKS.format(where='true')}
    SELECT n1 AS positives, n2 AS negatives, round(u / (n1 * n2), 10) AS auc FROM u""")
def roc_auc(t: Tables) -> DataFrame:
    labelled = t.orders.select("o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("finished"))
    return _rounded(stats.roc_auc(labelled, "o_totalprice", "finished"), auc=10)
