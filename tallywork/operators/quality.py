"""Data-quality tables: sizes, missing values, ranges, reconciliation of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import col, one_row_to_long
from tallywork.functions.numeric import ratio
from tallywork.operators.clean import duplicate_count, row_digests
from tallywork.sources.scratch import SHORT_METHODS, materialize, settings


def shape(df: DataFrame) -> DataFrame:
    """``row_count, column_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint")
    )


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, missing, missing_pct`` (share of all rows), one scan for all columns."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(col(c)).alias(f"__{i}") for i, c in enumerate(columns)]
    gone = [F.col("__rows") - F.col(f"__{i}") for i in range(len(columns))]
    return one_row_to_long(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                gone[i].alias("missing"),
                (F.lit(100.0) * ratio(gone[i], F.col("__rows"), None)).alias("missing_pct"),
            )
            for i, c in enumerate(columns)
        ],
    )


def column_types(df: DataFrame) -> DataFrame:
    """``column, type, position`` from the schema (no data is read)."""
    rows = [(name, kind, i) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "column string, type string, position bigint")


def _fact(name: str, item: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("__fact"), F.lit(item).alias("item"), value.alias("value"))


def _size_and_gaps(df: DataFrame, columns: Sequence[str], rates: Sequence[str] = ()) -> DataFrame:
    """``__fact, item, value`` rows for sizes and missing values, from one aggregate."""
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(col(c)).alias(f"__{i}") for i, c in enumerate(columns)])
    gap = {c: (F.col("__rows") - F.col(f"__{i}")).cast("double") for i, c in enumerate(columns)}
    facts = [
        _fact("rows", "", F.col("__rows").cast("double")),
        _fact("columns", "", F.lit(float(len(df.columns)))),
        *[_fact("missing", c, gap[c]) for c in columns],
        *[_fact("missing_pct", c, F.lit(100.0) * ratio(gap[c], F.col("__rows"), None)) for c in rates],
    ]
    return one.select(F.inline(F.array(*facts)))


def overview(df: DataFrame, key_missing: Sequence[str] = (), copies: DataFrame | None = None) -> DataFrame:
    """``item, metric, value``: sizes, duplicates (``copies``, if they are counted already), missing counts, missing rates of key columns."""
    facts = _size_and_gaps(df, df.columns, key_missing).select(
        F.when(F.col("item") == "", F.lit("table")).otherwise(F.col("item")).alias("item"),
        F.col("__fact").alias("metric"),
        "value",
    )
    copies = (duplicate_count(df) if copies is None else copies).select(
        F.lit("table").alias("item"),
        F.lit("duplicate_rows").alias("metric"),
        F.col("duplicate_rows").cast("double").alias("value"),
    )
    return facts.unionByName(copies)


def overview_report(df: DataFrame, key: Sequence[str], key_missing: Sequence[str] = (), n: int = 5) -> DataFrame:
    """``part, item, metric, number, text``: the facts of :func:`overview`, the columns' types, and a preview of ``n`` rows.

    A previewed row is named by its place in key order and has one entry for each column that is not NULL.
    """
    facts = overview(df, key_missing).select(F.lit("facts").alias("part"), "item", "metric", F.col("value").alias("number"), F.lit(None).cast("string").alias("text"))
    types = column_types(df).select(
        F.lit("types").alias("part"), F.col("column").alias("item"), F.lit("type").alias("metric"), F.col("position").cast("double").alias("number"), F.col("type").alias("text")
    )
    place = F.row_number().over(Window.orderBy(*[col(k) for k in key])).cast("string")  # over the n rows of the preview
    first = df.orderBy(*[col(k) for k in key]).limit(n).withColumn("__place", place)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    cells = [
        F.struct(
            F.lit(c).alias("metric"),
            (col(c) if c in numeric else F.lit(None)).cast("double").alias("number"),
            (F.lit(None) if c in numeric else col(c)).cast("string").alias("text"),
        )
        for c in df.columns
    ]
    preview = first.select(F.lit("preview").alias("part"), F.col("__place").alias("item"), F.inline(F.array(*cells))).where("number IS NOT NULL OR text IS NOT NULL")
    return facts.unionByName(types).unionByName(preview)


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, min, max`` sanity table."""
    one = df.agg(
        *[f(col(c).cast("double")).alias(f"__{t}{i}") for i, c in enumerate(columns)
          for t, f in (("lo", F.min), ("hi", F.max))]
    )
    return one_row_to_long(
        one,
        [
            F.struct(F.lit(c).alias("column"), F.col(f"__lo{i}").alias("min"), F.col(f"__hi{i}").alias("max"))
            for i, c in enumerate(columns)
        ],
    )


def _facts(df: DataFrame, key_missing: Sequence[str], target: str) -> DataFrame:
    """``check_name, item, value`` facts about one table, from one scan.

    Equal rows, told by two 64-bit hashes, are counted with their label and their gaps; what is stored is one row a label.
    """
    names = {c: f"__gap{i}" for i, c in enumerate(key_missing)}
    label = col(target).cast("string").alias("__label")
    rows = df.select(*row_digests(df), label, *[col(c).isNull().alias(gap) for c, gap in names.items()])
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__copies"))
    n = F.col("__copies")
    by_label = rows.groupBy("__label").agg(
        F.sum(n).alias("__rows"),
        F.count(F.lit(1)).alias("__distinct"),
        *[F.sum(F.when(F.col(gap), n).otherwise(0)).alias(gap) for gap in names.values()],
    )
    with settings(df.sparkSession, **SHORT_METHODS):
        by_label = materialize(by_label, "label-facts")
    whole = by_label.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in by_label.columns if c != "__label"])
    told = [("rows", "", F.col("__rows")), ("columns", "", F.lit(len(df.columns)).cast("bigint"))]
    told += [("missing", c, F.col(gap)) for c, gap in names.items()]
    distinct = F.col("__distinct")
    if isinstance(df.schema[target].dataType, (T.FloatType, T.DoubleType)):  # 0.0 and -0.0 are two labels of equal rows
        distinct = duplicate_count(df).select("distinct_rows").scalar()
    told += [("distinct_rows", "", distinct)]
    facts = [F.struct(F.lit(name).alias("check_name"), F.lit(item).alias("item"), value.alias("value")) for name, item, value in told]
    labels = by_label.where(F.col("__label").isNotNull()).select(F.lit("category").alias("check_name"), F.col("__label").alias("item"), F.col("__rows").alias("value"))
    return whole.select(F.inline(F.array(*facts))).unionByName(labels)


def reconcile(left: DataFrame, right: DataFrame, key_missing: Sequence[str], target: str) -> DataFrame:
    """``check_name, item, left_value, right_value, matches`` for two versions of a table.

    Facts of both sides meet in a full outer join, so a category only one side has is reported
    with a count of 0 on the other. Sorted by check and item.
    """
    a = _facts(left, key_missing, target).withColumnRenamed("value", "left_value")
    b = _facts(right, key_missing, target).withColumnRenamed("value", "right_value")
    both = a.join(b, ["check_name", "item"], "full_outer")
    return both.select(
        "check_name",
        "item",
        F.coalesce("left_value", F.lit(0)).alias("left_value"),
        F.coalesce("right_value", F.lit(0)).alias("right_value"),
    ).withColumn("matches", F.col("left_value") == F.col("right_value")).orderBy("check_name", "item")
