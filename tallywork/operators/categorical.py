"""Categorical profiles and top-n levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.functions.numeric import ratio
from tallywork.operators.frequency import category_frequencies
from tallywork.sources.scratch import materialize


def column_totals(freq: DataFrame, sparse_share: float = 0.01) -> DataFrame:
    """``column, rows, valid, missing, distinct_values, mode_value`` from a category table.

    The mode is the smallest of the most frequent categories; a plain reducible aggregate, so a
    column with very many categories does not pile up in one task.
    """
    valid = F.col("category").isNotNull()
    best = F.min(F.when(valid, F.struct((-F.col("n")).alias("minus_n"), F.col("category"))))
    return freq.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), F.lit(0)).alias("missing"),
        F.count(F.when(valid, F.lit(1))).alias("distinct_values"),
        best["category"].alias("mode_value"),
    )


def top_levels(freq: DataFrame, n: int) -> DataFrame:
    """``column, category, n, level_rank``: the ``n`` most frequent categories of each column.

    Ties go to the smaller category. The rank filter lets Spark keep only ``n`` rows per column
    in every task before the shuffle, so no task sorts a whole column.
    """
    # Missing comes last and is dropped after the ranking: a filter before it would travel down
    # into the scan and keep this branch from sharing the frequency table with others.
    order = Window.partitionBy("column").orderBy(
        F.col("category").isNull(), F.col("n").desc(), F.col("category").asc()
    )
    ranked = freq.withColumn("level_rank", F.row_number().over(order))
    return ranked.where((F.col("level_rank") <= n) & F.col("category").isNotNull())


def value_counts(freq: DataFrame, n: int, with_positive: bool = True) -> DataFrame:
    """``column, category, n, pct, positive_n, positive_pct`` of the top categories.

    ``pct`` is relative to non-missing rows; ``positive_pct`` is the rate within the category.
    """
    totals = column_totals(freq).select("column", "valid")
    top = top_levels(freq, n).join(F.broadcast(totals), "column")  # one row per column
    out = [
        F.col("column"), F.col("category"), F.col("n"), F.col("level_rank").cast("bigint").alias("level_rank"),
        (F.lit(100.0) * ratio(F.col("n"), F.col("valid"), None)).alias("pct"),
    ]
    if with_positive:
        out += [F.col("positive_n"), (F.lit(100.0) * ratio(F.col("positive_n"), F.col("n"))).alias("positive_pct")]
    return top.select(*out)


def sparse_categories(freq: DataFrame, share: float = 0.01) -> DataFrame:
    """``column, sparse_count``: categories whose share of non-missing rows is strictly below ``share``."""
    totals = column_totals(freq).select("column", "valid")
    rare = F.col("category").isNotNull() & (ratio(F.col("n"), F.col("valid"), None) < share)
    return (
        freq.join(F.broadcast(totals), "column")  # one row per column
        .groupBy("column")
        .agg(F.count(F.when(rare, F.lit(1))).alias("sparse_count"))
    )


def modes(freq: DataFrame) -> DataFrame:
    """``column, mode_value``."""
    return column_totals(freq).select("column", "mode_value")


def categorical_columns(freq: DataFrame, share: float = 0.01) -> DataFrame:
    """``column, distinct_values, mode_value, missing, sparse_count``."""
    totals = column_totals(freq).select("column", "distinct_values", "mode_value", "missing")
    return totals.join(F.broadcast(sparse_categories(freq, share)), "column")


def categorical_profile(
    df: DataFrame, columns: Sequence[str], target: str, positive: str, top_n: int = 10, share: float = 0.01
) -> dict[str, DataFrame]:
    """``{"columns": per column, "categories": per top category}`` from one stored frequency table."""
    freq = materialize(category_frequencies(df, columns, target, positive), "category-frequencies")
    return {"columns": categorical_columns(freq, share), "categories": value_counts(freq, top_n)}


def positive_rates(freq: DataFrame) -> DataFrame:
    """``column, category, n, positive_n, positive_pct`` for every category."""
    return freq.where(F.col("category").isNotNull()).select(
        "column", "category", "n", "positive_n",
        (F.lit(100.0) * ratio(F.col("positive_n"), F.col("n"))).alias("positive_pct"),
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """``category, n, pct, imbalance_ratio``; ``pct`` is relative to all rows, NULL labels included."""
    counts = df.groupBy(col(target).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(
        F.sum("n").alias("rows"),
        F.max(F.when(F.col("category").isNotNull(), F.col("n"))).alias("most"),
        F.min(F.when(F.col("category").isNotNull(), F.col("n"))).alias("least"),
    )
    return counts.where(F.col("category").isNotNull()).select(
        F.col("category").cast("string").alias("category"),
        "n",
        (F.lit(100.0) * ratio(F.col("n"), whole.select("rows").scalar(), None)).alias("pct"),
        ratio(whole.select("most").scalar(), whole.select("least").scalar(), None).alias("imbalance_ratio"),
    )


def top_categories(df: DataFrame, column: str, n: int) -> DataFrame:
    """``category, n`` of the most frequent values, ties to the smaller; a per-task top-n."""
    counts = df.where(col(column).isNotNull()).groupBy(col(column).alias("category"))
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("category").asc()).limit(n)


def rows_in_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` most frequent (semi-join with an ``n``-row list)."""
    top = top_categories(df, column, n).select(F.col("category").alias("__top"))
    return df.join(F.broadcast(top), col(column) == F.col("__top"), "left_semi")


def recode_top(
    df: DataFrame,
    column: str,
    n: int = 10,
    other: str = "Other",
    null_to_other: bool = True,
    always: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Keep the ``n`` most frequent values and turn the rest into ``other``.

    The column is capped only when it has more than ``n`` values (or ``always``). With
    ``null_to_other`` a capped column also sends NULL to ``other``. The broadcast list has at most
    ``n + 1`` rows.
    """
    out = out or column
    counts = df.where(col(column).isNotNull()).groupBy(col(column).alias("__top"))
    ranked = (
        counts.agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.col("__n").desc(), F.col("__top").asc())
        .limit(n + 1)
    )
    size = ranked.agg(F.count(F.lit(1)).alias("k")).scalar()
    top = ranked.orderBy(F.col("__n").desc(), F.col("__top").asc()).limit(n).select("__top")
    capped = F.lit(True) if always else size > n
    value = col(column)
    to_other = F.col("__top").isNull() & (F.lit(null_to_other) | value.isNotNull())
    recoded = F.when(F.col("__capped") & to_other, F.lit(other)).otherwise(value)
    return (
        df.withColumn("__capped", capped)
        .join(F.broadcast(top), value == F.col("__top"), "left")
        .withColumn(out, recoded)
        .drop("__top", "__capped")
    )
