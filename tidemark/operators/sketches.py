"""Column profiles as mergeable states.

A state is one row per column with counts, moments, extremes and two binary sketches:
KLL for quantiles, HLL for distinct values. States of partitions, days or micro-batches
merge into the state of all rows, so a profile of 100 TB is kept up to date by one scan
of what is new. A state's size does not depend on the rows behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import BracketMissed, quantiles_between

#: KLL's size parameter, and the rank error that 99 of 100 of its answers stay below at that size.
KLL_SIZE, RANK_ERROR = 2048, 0.0014
#: log2 of HLL's registers; its relative standard error is about 1.04 / sqrt(2^12).
HLL_BITS, DISTINCT_ERROR = 12, 0.017

_STATE = ("column", "n", "missing", "mean", "m2", "min", "max", "kll", "hll")


def _number(column: str) -> Column:
    """The column as a double; NaN counts as missing and -0.0 as 0.0."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)


def sketch(df: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """The state of each numeric column, per ``by`` if given; one scan, combined before its shuffle.

    An empty table has states with n = 0 and null moments (none at all per ``by``).
    """
    states = [
        F.struct(
            F.lit(c).alias("column"), F.count(_number(c)).alias("n"), F.count_if(_number(c).isNull()).alias("missing"),
            F.avg(_number(c)).alias("mean"), (F.var_pop(_number(c)) * F.count(_number(c))).alias("m2"),
            F.min(_number(c)).alias("min"), F.max(_number(c)).alias("max"),
            F.kll_sketch_agg_double(_number(c), F.lit(KLL_SIZE)).alias("kll"),
            F.hll_sketch_agg(_number(c).cast("string"), F.lit(HLL_BITS)).alias("hll"),
        )
        for c in columns
    ]
    rows = df.groupBy(*by).agg(F.array(*states).alias("states"))
    return rows.select(*by, F.explode("states").alias("s")).select(*by, "s.*")


def merge(states: DataFrame, *by: str) -> DataFrame:
    """States of parts as the states of the whole, per ``by`` if given."""
    n, mean = F.col("n"), F.col("mean")
    whole = states.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"),
        F.try_divide(F.sum(n * mean), F.sum("n")).alias("mean"),
        # Within the parts, and between the parts' means.
        (F.sum("m2") + F.sum(n * mean * mean) - F.try_divide(F.sum(n * mean) * F.sum(n * mean), F.sum("n"))).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("kll", F.lit(KLL_SIZE)).alias("kll"), F.hll_union_agg("hll").alias("hll"),
    )
    return whole.withColumn("m2", F.greatest("m2", F.lit(0.0)))


def sketched_profile(states: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, gaps, mean, deviation, extremes, quantiles and distinct values per column.

    Quantiles are values of the column whose rank is within ``RANK_ERROR`` of what was
    asked; ``n_distinct`` is an estimate. A column without values has null answers.
    """
    quantiles = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("kll", F.lit(float(p)))).alias(f"q{round(p * 100):02d}")
        for p in probs
    ]
    return states.select(
        *[c for c in states.columns if c not in _STATE], "column", "n", "missing", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
        "min", *quantiles, "max", F.hll_sketch_estimate("hll").alias("n_distinct"),
    )


def refine(df: DataFrame, states: DataFrame, probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of the rows behind ``states``, one list per column.

    The sketches bracket each quantile, so only the values between two sketched ones are
    put in order. A bracket that misses (sketches err beyond their bound now and then) is
    widened until it holds. ``df`` should be a columnar table: it is read twice.
    """
    margin = 2 * RANK_ERROR
    probs = [float(p) for p in probs]
    while True:
        cuts = [min(1.0, max(0.0, p + side)) for p in probs for side in (-margin, margin)]
        ends = F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(cut)) for cut in cuts])
        found = {r["column"]: r for r in states.where("n > 0").select("column", "n", "min", "max", ends.alias("cuts")).collect()}
        brackets = {
            c: (r["n"], [r["min"] if cut == 0 else r["max"] if cut == 1 else v for cut, v in zip(cuts, r["cuts"])])
            for c, r in found.items()
        }
        columns = [r["column"] for r in states.select("column").collect()]
        try:
            exact = quantiles_between(df.select(*[_number(c).alias(c) for c in brackets]), brackets, probs) if brackets else {}
        except BracketMissed:
            margin *= 8
            continue
        return {c: exact.get(c, [None] * len(probs)) for c in columns}
