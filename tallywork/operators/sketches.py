"""Stored sketches: approximate distinct counts and quantiles that merge, so a new part of the data costs one scan of that part.

These are the opt-in approximate forms of the exact counts and quantiles elsewhere. A part (a day, say) and column
keep a HyperLogLog sketch of 4,096 registers and a KLL quantile sketch with k = 200, a few kilobytes each.
Errors, at 99 %: distinct counts within 4 %, quantiles within 0.02 of the asked rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.operators.frequency import numeric_values
from tallywork.operators.numeric import QUARTILES
from tallywork.operators.selection import order_key

REGISTERS = 12  # log2 of the registers of a distinct count
KLL_K = 200
DISTINCT_ERROR, RANK_ERROR = 0.04, 0.02


def build_sketches(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """``part, column, n, distinct_sketch, quantile_sketch``: one row per part and column, from one narrow scan.

    Rows without a part and missing values are left out. Numbers are told apart as doubles.
    """
    values = numeric_values(df, columns, by=(part,)).where(col(part).isNotNull())
    return values.groupBy(col(part).cast("string").alias("part"), "column").agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(order_key(F.col("value")), REGISTERS).alias("distinct_sketch"),
        F.kll_sketch_agg_double("value", KLL_K).alias("quantile_sketch"),
    )


def add_parts(df: DataFrame, columns: Sequence[str], part: str, path: str) -> str:
    """Write the sketches of the parts in ``df`` beside those stored at ``path``; a part that is there already is replaced."""
    found = build_sketches(df, columns, part)
    found.write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def merge_sketches(sketches: DataFrame, probabilities: Mapping[str, float] = QUARTILES, parts: Sequence[str] | None = None) -> DataFrame:
    """``column, n, distinct_values, <names>`` over all (or the named) parts: one small aggregate over stored rows."""
    chosen = sketches if parts is None else sketches.where(F.col("part").cast("string").isin(*parts))
    merged = chosen.groupBy("column").agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("quantile_sketch").alias("q")
    )
    names = [F.kll_sketch_get_quantile_double("q", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
    return merged.select("column", "n", F.hll_sketch_estimate("d").alias("distinct_values"), *names)
