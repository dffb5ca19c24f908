"""Equi-join in which missing keys match each other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` without losing rows whose keys are null. No side is hinted:
    adaptive execution picks the strategy from measured sizes and splits hot keys."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matched = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, matched, how).drop(*[f"_right_{k}" for k in keys])
