"""Contingency tables and the chi-square independence test, many row columns at once.

Cells stay long: ``(column, level, label, n)``, one row per *observed* pair. The data is reduced
to (column, category, label) counts in one scan and one shuffle; capping to the most frequent
levels happens on those counts, never on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.functions.numeric import ratio
from tallywork.functions.tails import chi_square_p_value
from tallywork.operators.categorical import top_levels
from tallywork.sources.scratch import materialize


def label_frequencies(df: DataFrame, rows: Sequence[str], label: str, unlabelled: bool = False) -> DataFrame:
    """``column, category, label, n`` for every pair, NULL categories included, NULL labels only on demand."""
    picked = (df if unlabelled else df.where(col(label).isNotNull())).select(
        col(label).cast("string").alias("__label"), *[col(c).cast("string").alias(c) for c in rows]
    )
    long = picked.unpivot(["__label"], [col(c) for c in rows], "column", "category")
    return long.groupBy("column", "category", F.col("__label").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def cap_levels(
    pairs: DataFrame, top_n: int, uncapped: Sequence[str] = (), other: str = "Other", null_to_other: bool = False
) -> DataFrame:
    """Cells ``column, level, label, n`` with at most ``top_n`` levels plus ``other`` per column.

    A column is capped only when it has more than ``top_n`` levels and is not listed in
    ``uncapped``. NULL categories drop out, except that ``null_to_other`` sends them to ``other``
    in the columns that are capped (the chart rule; the test rule drops them). Rows with a NULL
    label take part in the ranking and are dropped from the cells.
    """
    sums = pairs.groupBy("column", "category").agg(F.sum("n").alias("n"))
    # At most top_n + 1 rows per column, which also tells whether the column needs a cap.
    leading = top_levels(sums, top_n + 1).select(
        "column",
        F.col("category").alias("__kept"),
        F.col("level_rank").alias("__rank"),
    )
    full = leading.groupBy("column").agg(
        (F.max("__rank") > top_n).alias("__over"),
    )
    capped = F.col("__over") & ~F.col("column").isin(*uncapped) if uncapped else F.col("__over")
    kept = leading.where(F.col("__rank") <= top_n).drop("__rank")
    joined = (
        pairs.join(F.broadcast(full), "column")
        .join(
            F.broadcast(kept.withColumnRenamed("column", "__column")),
            (F.col("column") == F.col("__column")) & (F.col("category") == F.col("__kept")),
            "left",
        )
    )
    outside = F.col("__kept").isNull() & (F.lit(null_to_other) | F.col("category").isNotNull())
    level = F.when(capped & outside, F.lit(other)).otherwise(F.col("category"))
    return (
        joined.select("column", level.alias("level"), "label", "n")
        .where(F.col("level").isNotNull() & F.col("label").isNotNull())
        .groupBy("column", "level", "label")
        .agg(F.sum("n").alias("n"))
    )


def crosstab(
    df: DataFrame,
    rows: Sequence[str],
    label: str,
    top_n: int | None = None,
    uncapped: Sequence[str] = (),
    null_to_other: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Observed cells ``column, level, label, n``; without ``top_n`` every level is kept.

    The chart rule (``null_to_other``) ranks levels over all rows, the test rule over labelled ones. ``pairs`` are stored
    :func:`label_frequencies`, unlabelled rows included, that hold the columns asked for; then the data is not read.
    """
    unlabelled = null_to_other and top_n is not None
    stored = pairs is not None
    if stored:
        pairs = pairs.where(F.col("column").isin(*rows) & (F.lit(unlabelled) | F.col("label").isNotNull()))
    else:
        pairs = label_frequencies(df, rows, label, unlabelled)
    if top_n is not None:
        # Read several times below: store the counts, so the data is scanned once.
        pairs = pairs if stored else materialize(pairs, "label-frequencies")
        return cap_levels(pairs, top_n, uncapped, null_to_other=null_to_other)
    return pairs.where(F.col("category").isNotNull()).select("column", F.col("category").alias("level"), "label", "n")


def _margins(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    by_level = cells.groupBy("column", "level").agg(F.sum("n").alias("level_n"))
    by_label = cells.groupBy("column", "label").agg(F.sum("n").alias("label_n"))
    whole = cells.groupBy("column").agg(F.sum("n").alias("total_n"))
    return by_level, by_label, whole


def dense(cells: DataFrame) -> DataFrame:
    """All cells ``column, level, label, n, expected``, unobserved pairs as 0.

    The grid is an equi-join of the two margins of each column: levels (at most top_n + 1 when
    capped) by labels, which is the size of the table asked for.
    """
    by_level, by_label, whole = _margins(cells)
    grid = by_level.join(by_label, "column").join(F.broadcast(whole), "column")  # one total per column
    filled = grid.join(cells, ["column", "level", "label"], "left")
    return filled.select(
        "column", "level", "label",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        (F.col("level_n").cast("double") * F.col("label_n") / F.col("total_n")).alias("expected"),
    )


def row_shares(cells: DataFrame) -> DataFrame:
    """``column, level, label, n, level_n, share``: each level's rows split over the labels."""
    full = dense(cells).drop("expected")
    by_level = cells.groupBy("column", "level").agg(F.sum("n").alias("level_n"))
    return full.join(by_level, ["column", "level"]).withColumn("share", ratio(F.col("n"), F.col("level_n")))


def small_cells(by_level: DataFrame, by_label: DataFrame, whole: DataFrame, least: int = 5) -> DataFrame:
    """``column, small_expected_cells``: cells whose expected count is below ``least``, without building any.

    For a level, these are its labels with label_n < least * total / level_n, a prefix of the labels by size. Levels and
    labels are counted by their sizes, of which a column has at most about the square root of twice its rows; sorted
    together, a running count of labels gives every level size its prefix. Whole numbers decide ties.
    """
    bound = F.expr(f"({least} * total_n - 1) div level_n + 1")  # least size that is not small
    levels = by_level.join(F.broadcast(whole), "column")  # one total per column
    levels = levels.select("column", bound.alias("at"), F.lit(0).alias("labels"), F.lit(1).alias("levels"))
    labels = by_label.select("column", F.col("label_n").alias("at"), F.lit(1).alias("labels"), F.lit(0).alias("levels"))
    sizes = levels.unionByName(labels).groupBy("column", "at").agg(F.sum("labels").alias("labels"), F.sum("levels").alias("levels"))
    below = Window.partitionBy("column").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counted = sizes.withColumn("__below", F.coalesce(F.sum("labels").over(below), F.lit(0)))
    return counted.groupBy("column").agg(F.sum(F.col("levels") * F.col("__below")).alias("small_expected_cells"))


def chi_square(cells: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row per column: ``column, n, levels, labels, dof, chi2, p_value, cramers_v,
    small_expected_cells, is_significant``.

    A 2x2 table gets Yates' correction. Unobserved cells contribute their expected count, so the
    statistic needs observed cells and margins only.
    """
    by_level, by_label, whole = _margins(cells)
    level_stats = by_level.groupBy("column").agg(
        F.count(F.lit(1)).alias("levels"), F.sum(1 / F.col("level_n").cast("double")).alias("level_inverse")
    )
    label_stats = by_label.groupBy("column").agg(
        F.count(F.lit(1)).alias("labels"), F.sum(1 / F.col("label_n").cast("double")).alias("label_inverse")
    )
    expected = F.col("level_n").cast("double") * F.col("label_n") / F.col("total_n")
    gap = F.col("n") - expected
    observed = (
        cells.join(by_level, ["column", "level"])
        .join(by_label, ["column", "label"])
        .join(F.broadcast(whole), "column")  # one total per column
        .groupBy("column")
        .agg(
            F.sum(gap * gap / expected).alias("seen"),
            F.sum(expected).alias("seen_expected"),
            F.max(F.abs(gap)).alias("gap"),
            F.count(F.lit(1)).alias("cells"),
            F.first("total_n").alias("total_n"),
        )
    )
    small = small_cells(by_level, by_label, whole)
    # Every table joined below has one row per tested column.
    stats = (
        observed.join(F.broadcast(level_stats), "column")
        .join(F.broadcast(label_stats), "column")
        .join(F.broadcast(small), "column")
    )
    total = F.col("total_n").cast("double")
    dof = (F.col("levels") - 1) * (F.col("labels") - 1)
    unseen = F.when(F.col("cells") < F.col("levels") * F.col("labels"), total - F.col("seen_expected")).otherwise(0.0)
    shrunk = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    yates = shrunk * shrunk * total * F.col("level_inverse") * F.col("label_inverse")
    statistic = F.when(dof == 0, F.lit(0.0)).when(dof == 1, yates).otherwise(F.col("seen") + unseen)
    tested = stats.select(
        "column", F.col("total_n").alias("n"), "levels", "labels", dof.alias("dof"), statistic.alias("chi2"),
        "small_expected_cells",
    )
    smaller_side = F.least(F.col("levels"), F.col("labels")) - 1
    strength = F.coalesce(F.sqrt(ratio(F.col("chi2"), F.col("n") * smaller_side, None)), F.lit(0.0))
    return tested.withColumns(
        {"p_value": chi_square_p_value(F.col("chi2"), F.col("dof")), "cramers_v": strength}
    ).withColumn("is_significant", F.col("p_value") < alpha)


def chi_square_tests(
    df: DataFrame, rows: Sequence[str], label: str, top_n: int = 10, alpha: float = 0.05, pairs: DataFrame | None = None
) -> DataFrame:
    """Chi-square tests of several columns against one label in one job (row side capped)."""
    return chi_square(crosstab(df, rows, label, top_n=top_n, pairs=pairs), alpha)
