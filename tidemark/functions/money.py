"""Sums of money that do not depend on the order of their parts.

Partial sums meet in any order on a cluster, and a retried task may change it.
Amounts are counted in whole units (cents, say) and added as decimals, which is exact
at any size; only the finished sum becomes a DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def units(amount: Column | str, places: int) -> Column:
    """An amount with up to ``places`` decimals as a whole number of its smallest unit."""
    return F.rint(_column(amount).cast("double") * 10**places).cast("decimal(20,0)")


def as_amount(total: Column | str, places: int) -> Column:
    """A sum of units as an amount."""
    return _column(total).cast("double") / 10**places


def exact_sum(amount: Column | str, places: int) -> Column:
    """Aggregate: the sum of amounts that have up to ``places`` decimals."""
    return F.sum(units(amount, places)).cast("double") / 10**places
