import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.fixtures import COACHING
from tidemark.functions import pvalues
from tidemark.operators import stats


@pytest.fixture(scope="module")
def learners(spark):
    data = [(track, day1 + day2, day1 + day2 == 14) for _, track, _, day1, day2, *_ in COACHING]
    return spark.createDataFrame(data, "track STRING, done INT, finished BOOLEAN")


def test_mann_whitney(learners):
    got = stats.mann_whitney(learners, "done", "track", "major", "non-major").first()
    assert (got["n1"], got["n2"], got["u"], round(got["p_value"], 3)) == (4, 6, 16.5, 0.389)


def test_group_means(learners):
    means = {r["track"]: r["mean"] for r in stats.group_means(learners, "done", "track").collect()}
    assert means["major"] == 10.5 and round(means["non-major"], 1) == 8.8


def test_fisher(learners):
    got = stats.fisher_exact(learners, F.col("track") == "major", F.col("finished")).first()
    assert tuple(got)[:4] == (2, 2, 0, 6) and round(got["p_value"], 3) == 0.133


def test_chi_square_guard(learners):
    got = stats.chi_square(learners, "track", "finished").first()
    assert round(got["p_value"], 3) == 0.259
    assert got["min_expected"] == pytest.approx(0.8) and not got["reliable"]
    plain = stats.chi_square(learners, "track", "finished", yates=False).first()
    assert round(plain["p_value"], 4) == 0.0528
    assert stats.expected_min(learners, "track", "finished").first()["min_expected"] == pytest.approx(0.8)


def test_auc_is_the_share_of_ordered_pairs(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 20), rng.randint(0, 1)) for _ in range(300)]
    got = stats.roc_auc(spark.createDataFrame(data, "s INT, y INT"), "s", "y").first()
    pairs = [(a, b) for (a, x), (b, y) in itertools.product(data, data) if x == 1 and y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert got["auc"] == pytest.approx(want)


def test_t_test_ignores_other_groups_and_gaps(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", None), ("b", 3.0), ("b", 8.0), ("b", 9.0), ("b", 7.0), ("c", 99.0)]
    got = stats.t_test(spark.createDataFrame(data, "g STRING, v DOUBLE"), "v", "g", "a", "b").first()
    a, b = np.array([1, 2, 4.0]), np.array([3, 8, 9, 7.0])
    se = a.var(ddof=1) / 3 + b.var(ddof=1) / 4
    assert got["t"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(se))
    dof = se**2 / ((a.var(ddof=1) / 3) ** 2 / 2 + (b.var(ddof=1) / 4) ** 2 / 3)
    assert got["dof"] == pytest.approx(dof)
    assert got["p_value"] == pytest.approx(1 - 2 * _integral(_t_density(dof), abs(got["t"])), rel=1e-8)


def _integral(density, upper, steps=200_001):
    x = np.linspace(0, upper, steps)
    y = density(x)
    return (x[1] - x[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def _t_density(dof):
    scale = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    return lambda x: scale * (1 + x * x / dof) ** (-(dof + 1) / 2)


@pytest.mark.parametrize("t,dof", [(0.3, 2.5), (1.3, 77.4), (2.2, 10), (4.0, 900)])
def test_t_tail(t, dof):
    assert pvalues.t_two_sided(t, dof) == pytest.approx(1 - 2 * _integral(_t_density(dof), t), rel=1e-8)


@pytest.mark.parametrize("x", [0.1, 1.0, 7.5, 60.0, 700.0])
def test_chi_square_tail_with_even_dof_is_a_short_sum(x):
    want = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(4))
    assert pvalues.chi2_tail(x, 8) == pytest.approx(want, rel=1e-10)


def test_fisher_against_full_enumeration():
    rng = random.Random(3)
    for _ in range(500):
        a, b, c, d = (rng.randint(0, 25) for _ in range(4))
        row, col, n = a + b, a + c, a + b + c + d
        def p(k):
            return math.comb(col, k) * math.comb(n - col, row - k) / math.comb(n, row)
        want = sum(p(k) for k in range(max(0, row + col - n), min(row, col) + 1) if p(k) <= p(a) * (1 + 1e-7))
        assert pvalues.fisher_two_sided(a, b, c, d) == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("dof", [1e8, 1e10, 1e12])
@pytest.mark.parametrize("t", [0.2, 1.959963984540054, 4.0])
def test_t_tail_of_many_degrees_nears_the_normal(t, dof):
    limit = 2 * pvalues.normal_sf(t)
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    assert pvalues.t_two_sided(t, dof) == pytest.approx(limit + t * (t * t + 1) * density / (2 * dof), rel=1e-9)


@pytest.mark.parametrize("n", [10**8, 10**10, 10**12])
def test_fisher_of_large_tables_nears_the_normal(n):
    spread = math.sqrt(n) / 4
    begin = time.perf_counter()
    for z in (0.0, 1.0, 2.5):
        a = n // 4 + round(z * spread)
        got = pvalues.fisher_two_sided(a, n // 2 - a, n // 2 - a, a)
        want = 1.0 if z == 0 else 2 * pvalues.normal_sf((round(z * spread) - 0.5) / spread * math.sqrt(1 - 1 / n))
        assert got == pytest.approx(want, abs=1e-6)
    assert time.perf_counter() - begin < 0.5


def test_fisher_sums_and_integrals_agree(monkeypatch):
    for table in ((9_000_000, 8_995_000, 9_002_000, 9_004_000), (40_000_000, 1_000_000, 39_000_000, 970_000)):
        monkeypatch.setattr(pvalues, "_WIDE", 1e18)
        want = pvalues.fisher_two_sided(*table)
        monkeypatch.setattr(pvalues, "_WIDE", 100.0)
        assert pvalues.fisher_two_sided(*table) == pytest.approx(want, rel=1e-6)


def test_degenerate_input_has_a_null_answer(spark):
    def table(data):
        return spark.createDataFrame(data, "g STRING, v DOUBLE, y INT")

    flat = table([("a", 1.0, 1), ("a", 1.0, 1), ("b", 1.0, 1), ("b", 1.0, 1)])
    assert stats.t_test(flat, "v", "g", "a", "b").first()["p_value"] is None
    assert stats.t_test(flat, "v", "g", "a", "b", welch=False).first()["p_value"] is None
    assert stats.mann_whitney(flat, "v", "g", "a", "b").first()["p_value"] is None
    assert stats.roc_auc(flat, "v", "y").first()["auc"] is None
    single = table([("a", 1.0, 1), ("b", 2.0, 0)])
    assert stats.t_test(single, "v", "g", "a", "b").first()["p_value"] is None
    assert stats.roc_auc(single, "v", "y").first()["auc"] == 0.0
    empty = flat.limit(0)
    assert stats.mann_whitney(empty, "v", "g", "a", "b").first()["p_value"] is None
    assert stats.roc_auc(empty, "v", "y").first()["auc"] is None
