"""Two-sample and contingency tests, and ROC-AUC.

Each test is reduced by Spark to a few sums; only the finished statistic goes
through a p-value function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import pvalues
from tidemark.operators.ordering import running_totals


def group_means(df: DataFrame, value: str, group: str) -> DataFrame:
    """Rows and mean per group."""
    return df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def t_test(df: DataFrame, value: str, group: str, first, second, welch: bool = True) -> DataFrame:
    """Two-sided t-test between two groups: Welch's, or Student's with pooled variance.

    The statistic and p are null if a group has fewer than two values or both are constant.
    """
    def moments(level, tag: str) -> list[Column]:
        x = F.when(F.col(group) == level, F.col(value).cast("double"))
        return [F.count(x).alias(f"n{tag}"), F.avg(x).alias(f"mean{tag}"), F.var_samp(x).alias(f"var{tag}")]

    sums = df.agg(*moments(first, "1"), *moments(second, "2"))
    n1, n2, v1, v2 = F.col("n1"), F.col("n2"), F.col("var1"), F.col("var2")
    if welch:
        s1, s2 = F.try_divide(v1, n1), F.try_divide(v2, n2)
        spread = s1 + s2
        dof = F.try_divide(spread * spread, F.try_divide(s1 * s1, n1 - 1) + F.try_divide(s2 * s2, n2 - 1))
    else:
        dof = (n1 + n2 - 2).cast("double")
        spread = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, dof) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2))
    return (
        sums.withColumn("t", F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(spread)))
        .withColumn("dof", dof)
        .withColumn("p_value", pvalues.p_t("t", "dof"))
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per pair of levels, with both margins and the number of cells in each."""
    by_a, by_b = Window.partitionBy(a), Window.partitionBy(b)
    return (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b).agg(F.count("*").alias("n"))
        .select(
            a, b, "n",
            F.sum("n").over(by_a).alias("margin_a"), F.count("*").over(by_a).alias("cells_a"),
            F.sum("n").over(by_b).alias("margin_b"), F.count("*").over(by_b).alias("cells_b"),
        )
    )


def chi_square(df: DataFrame, a: str, b: str, yates: bool = True, least_expected: float = 5) -> DataFrame:
    """Chi-square test of independence; Yates's correction applies to 2x2 tables.

    ``reliable`` is false when the smallest expected count is below ``least_expected``.
    Cells with no rows need no row of their own: the statistic is N (sum O^2/(R C) - 1).
    """
    n, ra, cb = F.col("n"), F.col("margin_a"), F.col("margin_b")
    sums = contingency(df, a, b).agg(
        F.sum("n").alias("n"),
        F.round(F.sum(1 / F.col("cells_a"))).cast("bigint").alias("rows_a"),
        F.round(F.sum(1 / F.col("cells_b"))).cast("bigint").alias("rows_b"),
        F.sum(n.cast("double") * n / (ra.cast("double") * cb)).alias("_fit"),
        F.min("margin_a").alias("_least_a"), F.min("margin_b").alias("_least_b"),
        # For 2x2 tables: |O - E| is the same in all four cells.
        F.max(n.cast("double")).alias("_o"),
        F.max_by(ra.cast("double") * cb, n).alias("_rc"),
        F.sum(1 / (ra * F.col("cells_a"))).alias("_inv_a"),
        F.sum(1 / (cb * F.col("cells_b"))).alias("_inv_b"),
    )
    total = F.col("n").cast("double")
    gap = F.abs(F.col("_o") - F.col("_rc") / total)
    corrected = F.pow(gap - F.least(F.lit(0.5), gap), F.lit(2)) * total * F.col("_inv_a") * F.col("_inv_b")
    plain = total * (F.col("_fit") - 1)
    two_by_two = (F.col("rows_a") == 2) & (F.col("rows_b") == 2)
    return (
        sums.withColumn("statistic", F.when(two_by_two & F.lit(yates), corrected).otherwise(plain))
        .withColumn("dof", (F.col("rows_a") - 1) * (F.col("rows_b") - 1))
        .withColumn("min_expected", F.col("_least_a") / total * F.col("_least_b"))
        .select(
            "n", "statistic", "dof", "min_expected",
            (F.col("min_expected") >= least_expected).alias("reliable"),
            pvalues.p_chi2("statistic", F.col("dof").cast("double")).alias("p_value"),
        )
    )


def expected_min(df: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest expected cell count of the table ``a`` x ``b``."""
    return contingency(df, a, b).agg(
        F.sum("n").alias("n"),
        (F.min("margin_a") / F.sum("n") * F.min("margin_b")).alias("min_expected"),
    )


def fisher_exact(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Two-sided Fisher exact test of two yes/no conditions: the four counts and p."""
    a, b = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    cells = df.agg(
        F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("only_a"),
        F.count_if(~a & b).alias("only_b"), F.count_if(~a & ~b).alias("neither"),
    )
    return cells.withColumn("p_value", pvalues.p_fisher("both", "only_a", "only_b", "neither"))


def _rank_sums(df: DataFrame, value: str, in_first: Column, in_second: Column) -> DataFrame:
    """Sizes, rank sum of the first group (ties share their mean rank) and tie term.

    Only distinct values are ordered, not rows. ``rank_sum2`` is twice the rank sum,
    which is whole, so it adds up exactly.
    """
    counts = (
        df.where(F.col(value).isNotNull() & (in_first | in_second))
        .groupBy(F.col(value).alias("value"))
        .agg(F.count("*").alias("t"), F.count_if(in_first).alias("k"))
    )
    whole = "decimal(19,0)"
    t = F.col("t").cast("double")
    return (
        running_totals(counts, [F.col("value")], ["t"])
        .withColumn("mid2", (2 * F.col("t_before") + F.col("t") + 1).cast(whole))
        .agg(
            F.sum("k").alias("n1"), F.sum(F.col("t") - F.col("k")).alias("n2"),
            F.sum(F.col("mid2") * F.col("k").cast(whole)).cast("decimal(38,0)").alias("rank_sum2"),
            F.sum(t * t * t - t).alias("ties"),
        )
        .withColumn("u1", F.col("rank_sum2").cast("double") / 2
                    - F.col("n1").cast("double") * (F.col("n1") + 1) / 2)
    )


def mann_whitney(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """Two-sided Mann-Whitney U test, normal approximation with tie and continuity correction.

    z and p are null if a group is empty or all values tie.
    """
    ranks = _rank_sums(df, value, F.col(group) == first, F.col(group) == second)
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n, both = n1 + n2, n1 * n2
    sd = F.sqrt(both / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    return (
        ranks.withColumn("u", F.col("u1"))
        .withColumn("z", F.try_divide(F.greatest(F.col("u1"), both - F.col("u1")) - both / 2 - 0.5, sd))
        .select("n1", "n2", "u", "z", pvalues.p_normal_two_sided("z").alias("p_value"))
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve of ``score`` for 0/1 ``label``; null if only one class is there."""
    ranks = _rank_sums(df, score, F.col(label) == 1, F.col(label) == 0)
    return ranks.select(
        F.col("n1").alias("positives"), F.col("n2").alias("negatives"),
        F.try_divide(F.col("u1"), F.col("n1").cast("double") * F.col("n2")).alias("auc"),
    )
