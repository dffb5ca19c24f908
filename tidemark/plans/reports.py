"""Sales reports, log aggregates and profiles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sum
from tidemark.functions.session import stored
from tidemark.operators import logs, profile, report, sketches
from tidemark.plans.registry import query
from tidemark.plans.tables import (
    Tables, is_error, priced_events, sales_by_region, sales_by_type, sales_lines,
)

_AMOUNT = """cast(l_quantity AS integer) * cast(l_extendedprice AS decimal(12,2))
             * (1 - cast(l_discount AS decimal(4,2)))"""
_TOTALS = f"""
    SELECT {{group}} AS g, count(*) AS orders, count(l_extendedprice) AS priced,
           sum(cast(l_extendedprice AS decimal(12,2))) AS price_sum, sum({_AMOUNT}) AS total
    FROM lineitem {{joins}} GROUP BY 1"""
_BY_TYPE = _TOTALS.format(group="p_type", joins="JOIN part ON l_partkey = p_partkey")
_BY_REGION = _TOTALS.format(
    group="r_name",
    joins="""JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
)
_REPORT = """
    SELECT row_number() OVER (ORDER BY total DESC, g) AS rank, g AS "group", orders AS "count",
           cast(price_sum AS double) / priced AS avg_price, cast(total AS double) AS total,
           round(cast(total AS double) / cast(max(total) OVER () AS double) * 100, 1) AS share_pct
    FROM ({totals})"""
_KPIS = """
    SELECT cast(sum(total) AS double) AS grand_total, cast(sum(orders) AS bigint) AS orders,
           cast(sum(total) AS double) / sum(orders) AS mean_per_order, count(*) AS groups,
           first(g ORDER BY total DESC, g) AS top_group
    FROM ({totals})"""


@query("sales_report_by_type", _REPORT.format(totals=_BY_TYPE))
def sales_report_by_type(t: Tables) -> DataFrame:
    return report.sales_report(sales_by_type(t), "p_type")


@query("sales_report_by_region", _REPORT.format(totals=_BY_REGION))
def sales_report_by_region(t: Tables) -> DataFrame:
    return report.sales_report(sales_by_region(t), "r_name")


@query("report_rows", f"""
    SELECT rank, "group", format('{{:,}}', "count") AS "count",
           format('{{:,}}', cast(round(avg_price) AS bigint)) AS avg_price,
           format('{{:,}}', cast(round(total) AS bigint)) AS total,
           printf('%.1f%%', share_pct) AS bar
    FROM ({_REPORT.format(totals=_BY_REGION)})""")
def report_rows(t: Tables) -> DataFrame:
    return report.report_rows(report.sales_report(sales_by_region(t), "r_name"))


@query("sales_kpis", _KPIS.format(totals=_BY_TYPE))
def sales_kpis(t: Tables) -> DataFrame:
    return report.sales_kpis(sales_by_type(t), "p_type")


@query("kpi_rows", f"""
    WITH k AS ({_KPIS.format(totals=_BY_REGION)})
    SELECT '총매출' AS label, format('{{:,}}', cast(round(grand_total) AS bigint)) AS value FROM k
    UNION ALL SELECT '주문 건수', format('{{:,}}', orders) FROM k
    UNION ALL SELECT '건당 평균매출', format('{{:,}}', cast(round(mean_per_order) AS bigint)) FROM k
    UNION ALL SELECT '매출 1위', top_group FROM k""")
def kpi_rows(t: Tables) -> DataFrame:
    return report.kpi_rows(report.sales_kpis(sales_by_region(t), "r_name"))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("pivot_revenue", f"""
    SELECT l_returnflag, {", ".join(
        f"cast(sum({_AMOUNT}) FILTER (p_type = '{p}') AS double) AS {p}" for p in _TYPES[:-1])},
           cast(sum({_AMOUNT}) FILTER (p_type NOT IN {_TYPES[:-1]}) AS double) AS other
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def pivot_revenue(t: Tables) -> DataFrame:
    lines = sales_lines(t.lineitem, "l_returnflag", F.col("l_partkey").alias("p_partkey"))
    folded = report.fold_sales(lines, "l_returnflag", "p_partkey").join(
        t.part.select("p_partkey", "p_type"), "p_partkey")
    return report.pivot_revenue(folded, "l_returnflag", "p_type", _TYPES[:-1])


@query("merge_stats", """
    SELECT o_orderkey, o_orderpriority, o_totalprice, priority_orders, priority_mean,
           o_totalprice / priority_mean AS relative_price
    FROM orders JOIN (
        SELECT o_orderpriority, count(*) AS priority_orders,
               cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) / count(*) AS priority_mean
        FROM orders GROUP BY 1) USING (o_orderpriority)""")
def merge_stats(t: Tables) -> DataFrame:
    stats = {
        "priority_orders": F.count("*"),
        "priority_mean": exact_sum("o_totalprice", 2) / F.count("*"),
    }
    return report.merge_stats(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], stats
    ).withColumn("relative_price", F.col("o_totalprice") / F.col("priority_mean"))


@query("log_summary", """
    SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors,
           count(*) FILTER (event_type = 'error') / count(*) AS error_share FROM events""")
def log_summary(t: Tables) -> DataFrame:
    return logs.log_summary(t.events, is_error())


LOG_BY_TYPE = """
    SELECT event_type, count(*) AS n, cast(sum(cast(value AS decimal(12,2))) * 100 AS bigint) AS total_size
    FROM events GROUP BY 1"""


@query("log_by_type", LOG_BY_TYPE)
def log_by_type(t: Tables) -> DataFrame:
    return logs.log_by(priced_events(t.events), "event_type", "cents")


@query("status_classes", """
    SELECT cast(floor(200 + 100 * (k // 25)) // 100 AS integer) AS status_class, count(*) AS n
    FROM (SELECT cast(json_extract(props, '$.k') AS integer) AS k FROM events) GROUP BY 1""")
def status_classes(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return logs.status_classes(t.events.select((200 + 100 * F.floor(k / 25) + k % 25).alias("status")))


@query("partial_then_final", """
    SELECT user_id, count(*) AS n, cast(sum(cents) AS bigint) AS total, min(cents) AS smallest, max(cents) AS largest
    FROM (SELECT user_id, cast(cast(value AS decimal(12,2)) * 100 AS bigint) AS cents FROM events) GROUP BY 1""")
def partial_then_final(t: Tables) -> DataFrame:
    return logs.partial_then_final(priced_events(t.events), "user_id", "cents", ["event_id"])


@query("hourly_traffic", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_traffic(t: Tables) -> DataFrame:
    return logs.hourly_traffic(t.events, "ts")


_AMOUNT_BY_TYPE = """
    SELECT event_type, count(*) AS n, cast(sum(amount) AS double) AS total,
           cast(sum(amount) AS double) / count(*) AS mean {extra}
    FROM (SELECT event_type, cast(value AS decimal(12,2)) AS amount FROM events)
    WHERE amount > 100 GROUP BY 1"""


@query("amount_by_type", _AMOUNT_BY_TYPE.format(extra=""))
def amount_by_type(t: Tables) -> DataFrame:
    return logs.amount_by_type(t.events, "value", above=100)


@query("parity", _AMOUNT_BY_TYPE.format(extra=", 0 AS differing_rows"))
def parity(t: Tables) -> DataFrame:
    return logs.parity(t.events, "value", above=100).withColumn(
        "differing_rows", F.col("differing_rows").cast("int"))


@query("profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS missing,
           round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
           quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
           quantile_cont({c}, 0.75) AS q75, max({c}) AS max
    FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def profile_lineitem(t: Tables) -> DataFrame:
    return profile.profile(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], plain_table=True).withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6)})


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount")


def _places(column: str) -> int:
    """Decimals compared: means of small two-place numbers lie on a rounding edge at six."""
    return 6 if column == "l_extendedprice" else 8


@query("profile_merged", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS missing, round(avg({c}), {_places(c)}) AS mean,
           round(stddev_samp({c}), {_places(c)}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25,
           quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
    FROM lineitem""" for c in _PROFILED))
def profile_merged(t: Tables) -> DataFrame:
    """Sketched per return flag, merged, and the quartiles refined to exact ones."""
    parts = stored(sketches.sketch(t.lineitem, _PROFILED, "l_returnflag"))
    whole = stored(sketches.merge(parts))
    exact = sketches.refine(t.lineitem, whole, [0.25, 0.5, 0.75])
    quartiles = t.spark.createDataFrame([(c, *qs) for c, qs in exact.items()], "column STRING, q25 DOUBLE, q50 DOUBLE, q75 DOUBLE")
    small = F.col("column") != "l_extendedprice"
    plain = sketches.sketched_profile(whole, []).withColumns({
        c: F.when(small, F.round(c, 8)).otherwise(F.round(c, 6)) for c in ("mean", "std")})
    return plain.drop("n_distinct").join(F.broadcast(quartiles), "column")  # one row per profiled column


@query("profile_sketched", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, true AS q25_close, true AS q50_close, true AS q75_close, true AS distinct_close
    FROM lineitem""" for c in _PROFILED))
def profile_sketched(t: Tables) -> DataFrame:
    """The sketched quartiles' true ranks and the distinct estimate, against their bounds with room for rare misses."""
    found = sketches.sketched_profile(sketches.merge(stored(sketches.sketch(t.lineitem, _PROFILED, "l_returnflag"))))
    lines = t.lineitem.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in _PROFILED])).alias("v")).select("v.*")
    # Folded by value first: a value's rows are combined before they move.
    counted = lines.where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("rows")).join(
        F.broadcast(found), "column")
    def close(q: str, p: float) -> Column:
        below = F.sum(F.when(F.col("value") < F.col(q), F.col("rows")).otherwise(0)) / F.first("n")
        upto = F.sum(F.when(F.col("value") <= F.col(q), F.col("rows")).otherwise(0)) / F.first("n")
        room = 3 * sketches.RANK_ERROR
        return ((below <= p + room) & (upto >= p - room)).alias(f"{q}_close")
    distinct = F.abs(F.first("n_distinct") / F.count("*") - 1) <= 4 * sketches.DISTINCT_ERROR
    return counted.groupBy("column").agg(
        F.first("n").alias("n"), close("q25", 0.25), close("q50", 0.5), close("q75", 0.75), distinct.alias("distinct_close"))


@query("rate_by", """
    SELECT lang, count(quality) AS n, cast(sum(quality) AS bigint) AS positives,
           sum(quality) / count(quality) AS rate
    FROM labels JOIN documents USING (doc_id) GROUP BY 1""")
def rate_by(t: Tables) -> DataFrame:
    labelled = t.labels.select("doc_id", "quality").join(t.documents.select("doc_id", "lang"), "doc_id")
    return profile.rate_by(labelled, "lang", "quality")
