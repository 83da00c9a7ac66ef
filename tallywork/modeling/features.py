"""Preprocessing stages fitted on the training rows only.

Three stages Spark ML lacks: an exact (interpolating) median imputer, a most-frequent imputer for
text, and a scaler with the population standard deviation. Each fits with the library's own
distributed aggregates and keeps one number or word per column; applying a fitted stage is a
projection of built-in expressions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col, one_row_to_long
from tallywork.functions.numeric import finite_or_null
from tallywork.operators.categorical import modes
from tallywork.operators.frequency import category_frequencies, numeric_values
from tallywork.operators.selection import select_quantiles


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Shared plumbing: input and output column lists."""

    def _pairs(self):
        return list(zip(self.getInputCols(), self.getOutputCols()))


class _Fitted(_Columns):
    """A fitted stage; its learned values travel as JSON so that saving needs nothing special."""

    learned = Param(Params._dummy(), "learned", "fitted values per input column (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, learned=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.learned))


def median_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, median`` over the non-missing values."""
    return select_quantiles(numeric_values(df, columns), {"median": 0.5})


def mode_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, mode_value`` over the non-missing values."""
    return modes(category_frequencies(df, columns))


def scale_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, mean, scale``: population standard deviation, 1 for a constant column."""
    aggs = []
    for i, c in enumerate(columns):
        v = finite_or_null(col(c))
        aggs += [F.avg(v).alias(f"__m{i}"), F.stddev_pop(v).alias(f"__s{i}")]
    return one_row_to_long(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"__m{i}").alias("mean"),
                F.when(F.col(f"__s{i}") > 0, F.col(f"__s{i}")).otherwise(F.lit(1.0)).alias("scale"),
            )
            for i, c in enumerate(columns)
        ],
    )


class MedianImputerModel(Model, _Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        medians = self.values()
        return df.withColumns(
            {o: F.coalesce(finite_or_null(col(i)), F.lit(medians.get(i))) for i, o in self._pairs()}
        )


class MedianImputer(Estimator, _Columns):
    """Missing numbers become the exact median of the training rows."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        found = {r["column"]: r["median"] for r in median_table(df, self.getInputCols()).collect()}
        return MedianImputerModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), learned=json.dumps(found)
        )


class ModeImputerModel(Model, _Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        words = self.values()
        return df.withColumns(
            {o: F.coalesce(col(i).cast("string"), F.lit(words.get(i))) for i, o in self._pairs()}
        )


class ModeImputer(Estimator, _Columns):
    """Missing text becomes the most frequent value of the training rows (smallest of a tie)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        found = {r["column"]: r["mode_value"] for r in mode_table(df, self.getInputCols()).collect()}
        return ModeImputerModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), learned=json.dumps(found)
        )


class PopulationScalerModel(Model, _Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = self.values()
        return df.withColumns(
            {o: (col(i) - F.lit(fitted[i][0])) / F.lit(fitted[i][1]) for i, o in self._pairs()}
        )


class PopulationScaler(Estimator, _Columns):
    """Mean 0 and population standard deviation 1."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        found = {r["column"]: [r["mean"], r["scale"]] for r in scale_table(df, self.getInputCols()).collect()}
        return PopulationScalerModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), learned=json.dumps(found)
        )


def preprocessing_stages(numeric: Sequence[str], categorical: Sequence[str], features: str = "features") -> list:
    """Numeric branch (median, scale) and text branch (mode, one-hot) joined into one vector.

    The indexer keeps a slot for unseen values and the encoder drops exactly that slot, so an
    unseen value becomes all zeros while every training category keeps its own position.
    """
    def names(columns, suffix):
        return [f"{c}__{suffix}" for c in columns]

    stages = []
    inputs = []
    if numeric:
        stages += [
            MedianImputer(inputCols=list(numeric), outputCols=names(numeric, "filled")),
            PopulationScaler(inputCols=names(numeric, "filled"), outputCols=names(numeric, "scaled")),
        ]
        inputs += names(numeric, "scaled")
    if categorical:
        stages += [
            ModeImputer(inputCols=list(categorical), outputCols=names(categorical, "filled")),
            StringIndexer(
                inputCols=names(categorical, "filled"), outputCols=names(categorical, "index"),
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=names(categorical, "index"), outputCols=names(categorical, "onehot"), dropLast=True
            ),
        ]
        inputs += names(categorical, "onehot")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features))
    return stages


def class_weight_table(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, weight`` with weight = rows / (classes * class rows)."""
    counts = df.where(col(label).isNotNull()).groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    rows, classes = whole.select("rows").scalar(), whole.select("classes").scalar()
    return counts.select("label", "n", (rows / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row of a 0/1-labelled table.

    The two class counts reach the rows as scalar subqueries: no join, no shuffle of rows.
    """
    counts = df.agg(F.count_if(col(label) == 1).alias("ones"), F.count_if(col(label) == 0).alias("zeros"))
    ones, zeros = counts.select("ones").scalar(), counts.select("zeros").scalar()
    here = F.when(col(label) == 1, ones).otherwise(zeros)
    classes = F.when((ones > 0) & (zeros > 0), F.lit(2.0)).otherwise(F.lit(1.0))
    return df.withColumn(out, (ones + zeros) / (classes * here))
