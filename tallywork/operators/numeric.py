"""Numeric profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col, one_row_to_long, unpivot_columns
from tallywork.functions.numeric import (
    adjusted_kurtosis,
    adjusted_skewness,
    finite_or_null,
    ratio,
    skew_label,
)
from tallywork.operators.frequency import numeric_frequencies, numeric_values
from tallywork.operators.selection import select_quantiles
from tallywork.sources.scratch import materialize

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

# G1 and G2 from sums of powers around the mean; NULL below three (four) values, 0 when constant.
ADJUSTED_SKEWNESS = """
    CASE WHEN count < 3 THEN NULL WHEN m2 = 0 THEN 0D
         ELSE sqrt(count * (count - 1D)) / (count - 2) * (m3 / count) / power(m2 / count, 1.5D) END"""
ADJUSTED_KURTOSIS = """
    CASE WHEN count < 4 THEN NULL WHEN m2 = 0 THEN 0D
         ELSE (count - 1D) / ((count - 2D) * (count - 3D))
              * ((count + 1D) * (count * m4 / (m2 * m2) - 3D) + 6D) END"""


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, count, mean, std, min, max, missing, missing_pct, skewness, kurtosis, zero_pct``.

    One scan and no shuffle beyond one partial record per task.
    """
    picked = df.select(*[finite_or_null(col(c)).alias(c) for c in columns])
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, name in enumerate(columns):
        c = col(name)
        parts = {
            "count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c),
            "skewness": adjusted_skewness(c), "kurtosis": adjusted_kurtosis(c),
            "zero_pct": F.lit(100.0) * F.avg(F.coalesce(c == 0, F.lit(False)).cast("double")),
        }
        aggs.append(F.struct(*[part.alias(key) for key, part in parts.items()]).alias(f"__{i}"))
    structs = []
    for i, name in enumerate(columns):
        s = F.col(f"__{i}")
        gone = F.col("__rows") - s["count"]
        structs.append(
            F.struct(
                F.lit(name).alias("column"),
                *[s[k].alias(k) for k in ("count", "mean", "std", "min", "max")],
                gone.alias("missing"),
                (F.lit(100.0) * ratio(gone, F.col("__rows"), None)).alias("missing_pct"),
                *[s[k].alias(k) for k in ("skewness", "kurtosis", "zero_pct")],
            )
        )
    return one_row_to_long(picked.agg(*aggs), structs)


def with_iqr(table: DataFrame) -> DataFrame:
    return table.withColumn("iqr", F.col("q3") - F.col("q1"))


def quartiles(values: DataFrame, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``(by..., column, q1, median, q3, iqr)`` of a long table of values, or of counted values with ``weight``."""
    return with_iqr(select_quantiles(values, QUARTILES, by, weight))


def fences(quartile_table: DataFrame, width: float = 1.5) -> DataFrame:
    """Add the outlier fences ``low`` and ``high``."""
    return quartile_table.withColumns(
        {"low": F.col("q1") - width * F.col("iqr"), "high": F.col("q3") + width * F.col("iqr")}
    )


def outliers_and_distinct(freq: DataFrame, quartile_table: DataFrame) -> DataFrame:
    """``column, distinct_values, outlier_candidates, low, high`` (values strictly outside the fences)."""
    bounds = fences(quartile_table).select("column", "low", "high")
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return (
        freq.join(F.broadcast(bounds), "column")  # one row per column
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("distinct_values"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outlier_candidates"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
        )
    )


def stored_frequencies(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), keep_missing: bool = False, exact: bool = False
) -> DataFrame:
    """A frequency table written once, for operators that read it several times."""
    return materialize(numeric_frequencies(df, columns, by, keep_missing, exact), "numeric-frequencies")


def numeric_profile(
    df: DataFrame, columns: Sequence[str], freq: DataFrame | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Descriptive fields per numeric column: count, mean, std, min, quartiles, max, iqr, missing,
    distinct values, adjusted skewness and kurtosis, outlier candidates, share of zeros.

    Everything derives from one stored frequency table that includes the missing counts (pass
    ``freq`` to reuse one, and as ``counted`` the stored table it came from, if its values repeat there), so
    the data itself is scanned once. Central moments are summed around the known mean. Distinct long and decimal values are told apart beyond 2^53; the other
    fields are doubles.
    """
    if freq is None:
        freq = stored_frequencies(df, columns, keep_missing=True, exact=True)
    n, value = F.col("n"), F.col("value")
    present = value.isNotNull()
    base = freq.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(present, n)), F.lit(0)).alias("count"),
        F.sum(n * value).alias("__sum"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(value == 0, n)), F.lit(0)).alias("zeros"),
    )
    # A sum of equal values rarely divides back to the value: a constant column is told by its ends.
    constant = F.col("min") == F.col("max")
    mean = F.when(constant, F.col("min")).otherwise(F.try_divide("__sum", F.col("count").cast("double")))
    base = base.withColumn("mean", mean).drop("__sum")
    quartile_table = quartiles(freq if counted is None else counted, weight="n")
    # One row per column in each of these tables.
    known = base.join(F.broadcast(fences(quartile_table)), "column", "left")
    d = value - F.col("mean")
    outside = (value < F.col("low")) | (value > F.col("high"))
    spread = (
        freq.join(F.broadcast(known.select("column", "mean", "low", "high")), "column")
        .groupBy("column")
        .agg(
            F.sum(n * d * d).alias("m2"),
            F.sum(n * d * d * d).alias("m3"),
            F.sum(n * d * d * d * d).alias("m4"),
            F.coalesce(F.sum(F.when(outside, n)), F.lit(0)).alias("outlier_candidates"),
        )
    )
    full = known.join(F.broadcast(spread), "column")
    missing = F.col("rows") - F.col("count")
    return full.select(
        "column",
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.expr("try_divide(m2, count - 1)"))).alias("std"),
        "min", "q1", "median", "q3", "max", "iqr",
        missing.alias("missing"),
        (F.lit(100.0) * ratio(missing, F.col("rows"), None)).alias("missing_pct"),
        "distinct_values",
        F.expr(ADJUSTED_SKEWNESS).alias("skewness"),
        F.expr(ADJUSTED_KURTOSIS).alias("kurtosis"),
        "outlier_candidates",
        (F.lit(100.0) * ratio(F.col("zeros"), F.col("rows"), None)).alias("zero_pct"),
    )


def numeric_hints(profile: DataFrame) -> DataFrame:
    """``column, mean_median_gap, skewness, skew_label, zero_pct, outlier_candidates``."""
    return profile.select(
        "column",
        (F.col("mean") - F.col("median")).alias("mean_median_gap"),
        "skewness",
        skew_label(F.col("skewness")).alias("skew_label"),
        "zero_pct",
        "outlier_candidates",
    )


def numeric_by_group(
    df: DataFrame, columns: Sequence[str], group: str, freq: DataFrame | None = None
) -> DataFrame:
    """``group, column, mean, median`` per group; rows without a group are left out."""
    if freq is None:  # the columns alone, without a shuffle
        narrow = materialize(df.select(col(group), *[col(c) for c in columns]), "numeric-columns")
        freq = numeric_values(narrow, columns, by=(group,)).withColumn("n", F.lit(1))
    freq = freq.where(col(group).isNotNull())
    means = freq.groupBy(col(group), F.col("column")).agg(
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean")
    )
    medians = select_quantiles(freq, {"median": 0.5}, by=(group,), weight="n")
    return means.join(medians, [group, "column"]).select(
        col(group).alias("group"), "column", "mean", "median"
    )


def outlier_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str], width: float = 1.5) -> DataFrame:
    """``keys..., column, value`` of the values strictly outside the fences of their column."""
    bounds = fences(quartiles(numeric_values(df, columns)), width).select("column", "low", "high")
    long = unpivot_columns(df, columns, "double", "value", ids=keys)
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return long.join(F.broadcast(bounds), "column").where(outside).drop("low", "high")  # one row per column
