"""Types, missing values and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from tidemark.operators.quantiles import exact_quantiles

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def normalise_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to ``types``; text that does not parse becomes null."""
    return df.withColumns({
        name: F.nullif(F.trim(F.col(name)), F.lit("")) if kind == "string"
        else F.trim(F.col(name)).try_cast(kind)
        for name, kind in types.items()
    })


def set_where(df: DataFrame, condition: Column, column: str, value) -> DataFrame:
    """Replace ``column`` in the rows that meet ``condition``; a null condition keeps the old value."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def fix_negative(df: DataFrame, *columns: str) -> DataFrame:
    """Negative amounts count as missing."""
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in columns})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells per column and in all (the row whose column is null), as rows
    ``(column, missing)``, from one pass."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column", "missing").rollup("column").agg(F.sum("missing").alias("missing"))


def missing_cells(columns: Sequence[str]) -> Column:
    """Aggregate: missing cells over all of ``columns``."""
    return F.sum(sum((F.col(c).isNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNull().cast("int")))


def impute(
    df: DataFrame, numeric: Sequence[str] = (), category: Sequence[str] = (), unknown: str = "Unknown"
) -> DataFrame:
    """Fill numeric gaps with the column's median and text gaps with ``unknown``. Rows are kept."""
    medians = exact_quantiles(df, numeric, [0.5]) if numeric else {}
    kinds = dict(df.dtypes)
    fills = {c: F.lit(m[0]).cast(kinds[c]) for c, m in medians.items()}
    fills |= {c: F.lit(unknown) for c in category}
    return df.withColumns({c: F.coalesce(F.col(c), fill) for c, fill in fills.items()})


def clip_iqr(df: DataFrame, *columns: str, k: float = 1.5) -> DataFrame:
    """Pull values beyond the quartiles by more than ``k`` interquartile ranges back
    to that bound. Whole-number columns take the rounded bound; gaps stay gaps."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    clipped = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is None:
            continue
        low, high = F.lit(q1 - k * (q3 - q1)), F.lit(q3 + k * (q3 - q1))
        if isinstance(kinds[c], _WHOLE):
            low, high = F.round(low), F.round(high)
        low, high = low.cast(kinds[c]), high.cast(kinds[c])
        clipped[c] = F.when(F.col(c).isNotNull(), F.greatest(low, F.least(high, F.col(c))))
    return df.withColumns(clipped)


def clean_report(raw: DataFrame, clean: DataFrame, columns: Sequence[str], outlier: str) -> DataFrame:
    """Rows, missing cells and largest ``outlier`` value before and after cleaning."""
    def summary(stage: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count("*").alias("n_rows"),
            missing_cells(columns).alias("missing"),
            F.max(outlier).alias("largest"),
        ).select(F.lit(stage).alias("stage"), "*")

    return summary("before", raw).unionByName(summary("after", clean))
