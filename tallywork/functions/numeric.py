"""Numeric expressions: bias-adjusted moments, guarded ratios, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Division that gives ``default`` instead of failing on a zero denominator."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def adjusted_skewness(column: Column) -> Column:
    """Sample skewness G1; NULL below three values, 0 for a constant column."""
    n = F.count(column).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, F.coalesce(F.skewness(column), F.lit(0.0)) * factor)


def adjusted_kurtosis(column: Column) -> Column:
    """Sample excess kurtosis G2; NULL below four values, 0 for a constant column."""
    n = F.count(column).cast("double")
    factor = F.try_divide(n - 1, (n - 2) * (n - 3))
    adjusted = factor * ((n + 1) * F.kurtosis(column) + 6)
    return F.when(n >= 4, F.coalesce(adjusted, F.lit(0.0)))


def skew_label(skewness: Column, threshold: float = 0.5) -> Column:
    """right / left / even, with strict thresholds."""
    return (
        F.when(skewness > threshold, "right")
        .when(skewness < -threshold, "left")
        .when(skewness.isNotNull(), "even")
    )


def half_even(column: Column, digits: int) -> Column:
    """Presentation rounding: ties go to the even digit."""
    return F.bround(column, digits)


def finite_or_null(column: Column) -> Column:
    """NaN is not a value here: it becomes NULL so counts and sorts ignore it."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
