"""Welch's two-sample t-test for several value columns in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col, one_row_to_long
from tallywork.functions.numeric import finite_or_null
from tallywork.functions.tails import student_t_p_value


def welch_t_tests(
    df: DataFrame, values: Sequence[str], group: str, high: str, low: str, alpha: float = 0.05
) -> DataFrame:
    """One row per value column: group sizes, means, standard deviations, mean difference,
    ``t_statistic``, ``dof``, two-sided ``p_value``, ``cohens_d``, ``alpha``, ``is_significant``.

    Conditional aggregates: one partial record per task, no shuffle of rows.
    """
    rows = df.where(col(group).isin(high, low)).select(
        (col(group) == F.lit(high)).alias("__high"), *[finite_or_null(col(v)).alias(v) for v in values]
    )
    aggs = []
    for i, name in enumerate(values):
        for side, test in (("high", F.col("__high")), ("low", ~F.col("__high"))):
            v = F.when(test, col(name))
            aggs += [
                F.count(v).alias(f"__{i}_{side}_n"),
                F.avg(v).alias(f"__{i}_{side}_mean"),
                F.var_samp(v).alias(f"__{i}_{side}_var"),
            ]
    structs = []
    for i, name in enumerate(values):
        structs.append(
            F.struct(
                F.lit(name).alias("column"),
                *[F.col(f"__{i}_{side}_{k}").alias(f"{side}_{k}") for k in ("n", "mean", "var") for side in ("high", "low")],
            )
        )
    long = one_row_to_long(rows.agg(*aggs), structs)

    share_high = F.try_divide(F.col("high_var"), F.col("high_n").cast("double"))
    share_low = F.try_divide(F.col("low_var"), F.col("low_n").cast("double"))
    difference = F.col("high_mean") - F.col("low_mean")
    spread = share_high + share_low
    dof = F.try_divide(
        spread * spread,
        F.try_divide(share_high * share_high, F.col("high_n") - F.lit(1.0))
        + F.try_divide(share_low * share_low, F.col("low_n") - F.lit(1.0)),
    )
    return (
        long.withColumns(
            {
                "mean_difference": difference,
                "t_statistic": F.try_divide(difference, F.sqrt(spread)),
                "dof": dof,
                "cohens_d": F.try_divide(difference, F.sqrt((F.col("high_var") + F.col("low_var")) / 2)),
                "high_std": F.sqrt("high_var"),
                "low_std": F.sqrt("low_var"),
            }
        )
        .withColumn("p_value", student_t_p_value(F.col("t_statistic"), F.col("dof")))
        .select(
            "column", "high_n", "low_n", "high_mean", "low_mean", "high_std", "low_std", "mean_difference",
            "t_statistic", "dof", "p_value", "cohens_d",
            F.lit(float(alpha)).alias("alpha"), (F.col("p_value") < alpha).alias("is_significant"),
        )
    )
