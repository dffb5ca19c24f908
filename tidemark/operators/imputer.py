"""Median imputation as a pipeline stage, with exact medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles


def _value(column: str) -> Column:
    """The column as a double; not-a-number counts as a gap."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


class ExactImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of every input column, whatever the table's size.

    Gaps are nulls and NaN. A column that has only gaps is filled with 0. Output
    columns are doubles, so that the median of whole numbers keeps its half.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ExactImputerModel:
        columns = self.getInputCols()
        medians = exact_quantiles(dataset.select(*[_value(c).alias(c) for c in columns]), columns, [0.5])
        fills = [medians[c][0] or 0.0 for c in columns]
        return ExactImputerModel(inputCols=columns, outputCols=self.getOutputCols(), fills=fills)


class ExactImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills gaps with the medians found; they are saved with the stage's parameters."""

    fills = Param(Params._dummy(), "fills", "what each input column's gaps become", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None,
        fills: Sequence[float] | None = None,
    ) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def getFills(self) -> list[float]:
        return self.getOrDefault(self.fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = zip(self.getInputCols(), self.getOutputCols(), self.getFills())
        return dataset.withColumns({out: F.coalesce(_value(c), F.lit(fill)) for c, out, fill in filled})
