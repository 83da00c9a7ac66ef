"""The numbers behind each chart. Every function returns a table ready to draw."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col, unpivot_columns
from tallywork.functions.numeric import finite_or_null, ratio
from tallywork.operators.categorical import target_distribution
from tallywork.operators.contingency import crosstab, row_shares
from tallywork.operators.correlation import matrix_cells, pearson_pairs
from tallywork.operators.frequency import numeric_values
from tallywork.operators.numeric import fences, quartiles
from tallywork.operators.split import fixed_sample
from tallywork.sources.scratch import materialize

GRID_POINTS = 200
# A Gaussian further than this many bandwidths away underflows to exactly 0 in double precision.
KERNEL_REACH = 39.0
TERMS = 24  # of the expansion of a kernel around its cell


def class_bars(df: DataFrame, target: str) -> DataFrame:
    """``category, n, pct``, most frequent class first."""
    counts = target_distribution(df, target).select("category", "n", "pct")
    return counts.orderBy(F.col("n").desc(), F.col("category").asc())


def _grouped_values(df: DataFrame, column: str, group: str | None) -> DataFrame:
    """``group, column, value, n`` of the rows that have both, each counted once: two narrow columns, stored without a shuffle."""
    label = col(group).cast("string") if group is not None else F.lit("all")
    rows = df.select(label.alias("group"), F.lit(column).alias("column"), finite_or_null(col(column)).cast("double").alias("value"))
    rows = materialize(rows.where(F.col("value").isNotNull() & F.col("group").isNotNull()), "chart-values")
    return rows.withColumn("n", F.lit(1))


def counted_values(freq: DataFrame, column: str, group: str | None = None) -> DataFrame:
    """``group, column, value, n`` from a stored frequency table: what the charts of a column need instead of its rows."""
    label = col(group).cast("string") if group is not None else F.lit("all")
    own = freq.where(F.col("column") == F.lit(column)).select(label.alias("group"), "column", "value", "n")
    return own.where(F.col("value").isNotNull() & F.col("group").isNotNull())


def bin_edges(values: DataFrame) -> DataFrame:
    """One row ``low, high, n, width, bins`` from ``(column, value, n)`` of one column: the
    automatic rule for histogram bins.

    The width is the smaller of the Freedman-Diaconis and Sturges widths, or Sturges when the
    interquartile range is 0; a constant column gets one bin of width 1 around its value.
    """
    span = values.groupBy("column").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n")
    )
    both = span.join(F.broadcast(quartiles(values, weight="n")), "column")  # one row
    n = F.col("n").cast("double")
    extent = F.col("high") - F.col("low")
    sturges = extent / (F.log2(n) + 1)
    robust = 2 * F.col("iqr") / F.cbrt(n)
    width = F.when(extent == 0, F.lit(1.0)).when(robust > 0, F.least(robust, sturges)).otherwise(sturges)
    flat = F.when(extent == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return both.select(
        (F.col("low") - flat).alias("low"),
        (F.col("high") + flat).alias("high"),
        "n",
        F.when(extent == 0, F.lit(1)).otherwise(F.ceil(extent / width)).cast("bigint").alias("bins"),
    ).withColumn("width", (F.col("high") - F.col("low")) / F.col("bins"))


def _count_up(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), n - 1)


def histogram(df: DataFrame, column: str, group: str | None = None, values: DataFrame | None = None) -> DataFrame:
    """``group, bin, bin_low, bin_high, n`` on common bins, empty bins included.

    The column is stored once (or its :func:`counted_values` are passed); edges and bins both come from it, and only
    counts per bin are shuffled. The bin rule reaches the rows as scalar subqueries, so nothing is joined.
    """
    if values is None:
        values = _grouped_values(df, column, group)
    edges = materialize(bin_edges(values), "edges")
    low, width, bins = (edges.select(c).scalar() for c in ("low", "width", "bins"))
    rows = values.withColumn("at", F.least(F.floor((F.col("value") - low) / width).cast("bigint"), bins - 1))
    # The quotient can miss an edge by one unit in the last place; the edges themselves decide.
    too_high = F.col("value") < low + F.col("at") * width
    too_low = (F.col("value") >= low + (F.col("at") + 1) * width) & (F.col("at") < bins - 1)
    placed = F.when(too_high, F.col("at") - 1).when(too_low, F.col("at") + 1).otherwise(F.col("at"))
    counted = rows.groupBy("group", placed.alias("bin")).agg(F.sum("n").alias("n"))
    groups = counted.groupBy("group").agg(F.count(F.lit(1)).alias("__used"))
    # Generate bins in two steps so that no single row holds a long array.
    block = F.lit(4096).cast("bigint")
    blocks = groups.select("group", bins.alias("bins"), F.explode(_count_up(F.ceil(bins / block))).alias("block"))
    grid = blocks.select(
        "group", F.explode(_count_up(F.least(block, F.col("bins") - F.col("block") * block))).alias("__i"), "block"
    ).select("group", (F.col("block") * block + F.col("__i")).alias("bin"))
    return grid.join(counted, ["group", "bin"], "left").select(
        "group", "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def density_curve(
    df: DataFrame, column: str, group: str | None = None, points: int = GRID_POINTS, values: DataFrame | None = None
) -> DataFrame:
    """``group, point, x, density``: Gaussian kernel estimate on a common grid over the data range.

    Bandwidth per group is std * n^(-1/5). A fast Gauss transform: values are summed into the first TERMS moments of
    cells sqrt(2) bandwidths wide, and only cells meet grid points, so the work is linear in values plus cells times
    the points within reach. A cell leaves out less than 1e-14 of a kernel's height for each of its values. Values may
    be passed as :func:`counted_values`.
    """
    if values is None:
        values = _grouped_values(df, column, group)
    span = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    gap = (high - low) / F.lit(float(points - 1))
    # a row per group in both, stored, so that Spark knows how many there are
    means = values.groupBy("group").agg(F.sum("n").alias("rows"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"))
    means = materialize(means.where("least < most").select("group", "rows", "mean"), "means")
    away = F.col("value") - F.col("mean")
    spread = values.join(means, "group").groupBy("group", "rows").agg(F.sum(F.col("n") * away * away).alias("m2"))
    widths = spread.withColumn("h", F.sqrt(F.col("m2") / (F.col("rows") - 1)) * F.pow(F.col("rows").cast("double"), F.lit(-0.2)))
    widths = materialize(widths.where(F.col("h") > 0).select("group", "rows", "h", (F.col("h") * math.sqrt(2.0)).alias("cell")), "bandwidths")
    placed = values.join(widths, "group").withColumn("at", F.floor((F.col("value") - low) / F.col("cell")))
    centre = low + (F.col("at") + 0.5) * F.col("cell")
    away = placed.withColumn("s", (F.col("value") - centre) / F.col("cell"))
    moments = away.groupBy("group", "rows", "h", "cell", "at").agg(F.array(*[F.sum(F.col("n") * F.pow("s", F.lit(float(k)))) for k in range(TERMS)]).alias("m"))
    reach = F.lit(KERNEL_REACH) * F.col("h") + F.col("cell") / 2
    first = F.greatest(F.lit(0), F.ceil((centre - reach - low) / gap)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((centre + reach - low) / gap)).cast("int")
    met = moments.withColumns({"__first": first, "__last": last}).where(F.col("__first") <= F.col("__last"))
    met = met.withColumn("point", F.explode(F.sequence("__first", "__last")))
    met = met.withColumn("t", (low + F.col("point") * gap - centre) / F.col("cell"))
    summed = met.select("group", "point", (_hermite_sum(F.col("t"), F.col("m")) / (F.col("rows") * F.col("h"))).alias("part")).groupBy("group", "point").agg(F.sum("part").alias("__sum"))
    grid = widths.select("group", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return grid.join(summed, ["group", "point"], "left").select(
        "group",
        F.col("point").cast("bigint").alias("point"),
        (low + F.col("point") * gap).alias("x"),
        (F.greatest(F.coalesce("__sum", F.lit(0.0)), F.lit(0.0)) / F.sqrt(F.lit(2.0) * F.pi())).alias("density"),
    )


def _hermite_sum(t: Column, moments: Column) -> Column:
    """Sum over k of moments[k] * h_k(t) / k! with the Hermite functions h_k, each from the two before it."""
    start = F.struct(F.lit(0.0).alias("before"), F.exp(-t * t).alias("now"), F.lit(0.0).alias("total"))

    def step(state: Column, k: Column) -> Column:
        return F.struct(
            state["now"].alias("before"),
            ((2 * t * state["now"] - 2 * state["before"]) / (k + 1)).alias("now"),
            (state["total"] + F.element_at(moments, k + 1) * state["now"]).alias("total"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(TERMS - 1)), start, step, lambda state: state["total"])


def _box_table(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    by = tuple(k for k in keys if k != "column")
    bounds = fences(quartiles(values, by=by, weight="n"))
    # one row per column, or per group: then stored, so that Spark knows how many there are
    bounds = materialize(bounds, "fences") if by else F.broadcast(bounds)
    inside = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    return (
        values.join(bounds, list(keys))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("fliers"),
        )
    )


def box_stats(df: DataFrame, column: str, group: str, values: DataFrame | None = None) -> DataFrame:
    """``group, n, q1, median, q3, whisker_low, whisker_high, fliers`` per group, from rows or from :func:`counted_values`."""
    return _box_table(_grouped_values(df, column, group) if values is None else values, ("group", "column")).drop("column")


def log_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form ``column, value`` of log(1 + x)."""
    return unpivot_columns(df, columns, "double", "value").select("column", F.log1p("value").alias("value"))


def log_box_stats(df: DataFrame, columns: Sequence[str], freq: DataFrame | None = None) -> DataFrame:
    """Box statistics of log(1 + x) for several columns; ``freq`` is a stored frequency table that has them."""
    if freq is not None:
        logs = freq.where(F.col("column").isin(*columns)).select("column", finite_or_null(F.log1p("value")).alias("value"), "n")
        return _box_table(logs.where(F.col("value").isNotNull()), ("column",))
    logs = materialize(df.select(*[F.log1p(col(c).cast("double")).alias(c) for c in columns]), "chart-values")
    return _box_table(numeric_values(logs, columns).withColumn("n", F.lit(1)), ("column",))


def stacked_shares(
    df: DataFrame, columns: Sequence[str], target: str, top_n: int = 10, uncapped: Sequence[str] = (), pairs: DataFrame | None = None
) -> DataFrame:
    """``column, level, label, n, level_n, share``: target shares per category.

    Capped columns send NULL to Other; elsewhere NULL rows drop out.
    """
    return row_shares(crosstab(df, columns, target, top_n=top_n, uncapped=uncapped, null_to_other=True, pairs=pairs))


def positive_rate_bars(
    df: DataFrame, columns: Sequence[str], target: str, positive: str, top_n: int = 10, pairs: DataFrame | None = None
) -> DataFrame:
    """``column, level, n, positive_rate, rate_rank``, sorted from the highest rate down.

    At most ``top_n`` levels and the rest per column are ranked, ties by level.
    """
    cells = crosstab(df, columns, target, top_n=top_n, null_to_other=True, pairs=pairs)
    hits = F.sum(F.when(F.col("label") == F.lit(positive), F.col("n")).otherwise(0))
    by_rate = Window.partitionBy("column").orderBy(F.col("positive_rate").desc(), F.col("level").asc())
    return (
        cells.groupBy("column", "level")
        .agg(F.sum("n").alias("n"), hits.alias("__hits"))
        .select("column", "level", "n", ratio(F.col("__hits"), F.col("n")).alias("positive_rate"))
        .withColumn("rate_rank", F.row_number().over(by_rate).cast("bigint"))
        .orderBy("column", "rate_rank")
    )


def heatmap(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_a, column_b, r`` for every cell of the Pearson matrix."""
    return matrix_cells(pearson_pairs(df, columns))


def scatter_points(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], n: int = 5000, seed: int = 42, ties: Sequence[str] = ()
) -> DataFrame:
    """At most ``n`` random rows with the plotted and hover columns."""
    return fixed_sample(df, key, n, seed, ties).select(*[col(c) for c in columns])
