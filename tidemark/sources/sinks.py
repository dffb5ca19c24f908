"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_BOM = "﻿"


def write_csv(df: DataFrame, path: str, bom: bool = True, one_file: bool = False) -> None:
    """CSV with a header row in each part file.

    ``bom`` puts a byte-order mark before each header so that spreadsheets read
    the text as UTF-8. ``one_file`` is for top-k lists and other short outputs.
    """
    out = df.coalesce(1) if one_file else df
    if bom:
        first, *rest = out.columns
        out = out.toDF(_BOM + first, *rest)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, one folder per value of ``partition_by`` (columns of few values)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
