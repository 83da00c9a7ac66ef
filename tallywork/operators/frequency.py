"""Frequency tables: the shared summary behind most results.

``(column, value, n)`` for numeric columns and ``(column, category, n, positive_n)`` for
categorical ones. Each is one column-pruned scan of the data and one shuffle of *distinct*
values: map-side partial counts collapse a hot value (a zero that fills most rows, say) to one
record per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import col, indicator, unpivot_columns
from tallywork.functions.numeric import finite_or_null


_WHOLE = 1 << 53


def _exact(df: DataFrame, name: str) -> Column:
    """The number as text where a double may not hold all its digits, else NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):  # the short way first: text only beyond 2^53
        return F.when((col(name) > _WHOLE) | (col(name) < -_WHOLE), col(name).cast("string"))
    return F.when(F.lit(isinstance(kind, T.DecimalType) and kind.precision > 15), col(name).cast("string"))


def numeric_frequencies(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    keep_missing: bool = False,
    exact: bool = False,
    keep_ungrouped: bool = False,
) -> DataFrame:
    """``(by..., column, value, n)``: how often each value occurs.

    Rows with a NULL ``by`` are left out unless ``keep_ungrouped``. With ``keep_missing`` the NULL
    value is a row too, so the table also carries the missing counts. ``exact`` adds a column that
    keeps long and decimal numbers apart which share a double.
    """
    pairs = [F.struct(col(c).cast("double").alias("value"), (_exact(df, c) if exact else F.lit(None).cast("string")).alias("exact")).alias(c) for c in columns]
    picked = df.select(*[col(i) for i in by], *pairs)
    long = picked.unpivot([col(i) for i in by], [col(c) for c in columns], "column", "__pair")
    long = long.select(*[col(i) for i in by], "column", finite_or_null(F.col("__pair.value")).alias("value"), F.col("__pair.exact").alias("exact"))
    for name in () if keep_ungrouped else by:
        long = long.where(col(name).isNotNull())
    if not keep_missing:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy(*[col(b) for b in by], "column", "value", *(["exact"] if exact else [])).agg(F.count(F.lit(1)).alias("n"))


def numeric_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, value)``, one row per present number: a narrow scan, nothing aggregated."""
    long = unpivot_columns(df, columns, "double", "value", ids=by)
    return long.withColumn("value", finite_or_null(F.col("value"))).where(F.col("value").isNotNull())


def category_frequencies(
    df: DataFrame, columns: Sequence[str], target: str | None = None, positive: str | None = None
) -> DataFrame:
    """``(column, category, n, positive_n)``; the NULL category is kept, it is the missing count."""
    flag = indicator(col(target), positive) if target is not None else F.lit(0)
    picked = df.select(flag.alias("__flag"), *[col(c).cast("string").alias(c) for c in columns])
    long = picked.unpivot(["__flag"], [col(c) for c in columns], "column", "category")
    return long.groupBy("column", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__flag").cast("bigint").alias("positive_n")
    )
