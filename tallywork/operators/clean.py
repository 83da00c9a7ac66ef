"""Format cleaning and row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import col
from tallywork.functions.text import clean_label, strip
from tallywork.sources.delimited import require_numeric
from tallywork.sources.scratch import SHORT_METHODS, materialize, settings

# Repeated rows are told by a list of as many hashes at most (16 MB of numbers); beyond, all rows are moved.
MOST_REPEATED = 2_000_000


def text_columns(df: DataFrame) -> list[str]:
    """Names of the string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalise_text(df: DataFrame, target: str | None = None) -> DataFrame:
    """Strip every string column; the target also loses trailing dots. One projection."""
    strings = set(text_columns(df))
    out = []
    for name in df.columns:
        if name == target:
            out.append(clean_label(col(name)).alias(name))
        elif name in strings:
            out.append(strip(col(name)).alias(name))
        else:
            out.append(col(name))
    return df.select(*out)


def is_normal(df: DataFrame, target: str | None = None) -> bool:
    """Whether :func:`normalise_text` changes nothing: one scan of the texts, up to the first that it changes."""
    texts = df.select(*[col(c) for c in text_columns(df)])
    if not texts.columns:
        return True
    both = texts.select(F.struct("*").alias("__old"), *[col(c) for c in texts.columns])
    new = normalise_text(both, target)
    changed = F.lit(False)
    for c in texts.columns:
        changed = changed | ~col(c).eqNullSafe(F.col("__old").getField(c))
    with settings(df.sparkSession, **SHORT_METHODS):
        return new.where(changed).isEmpty()


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicates (NULL equals NULL).

    Copies collapse in the map-side partial aggregate, so a row repeated a billion times reaches
    the shuffle once per task.
    """
    return df.dropDuplicates()


def clean(df: DataFrame, target: str, numeric: Sequence[str] = ()) -> DataFrame:
    """Normalise the text, then drop duplicates. Missing values stay missing."""
    return distinct_rows(require_numeric(normalise_text(df, target), numeric))


def clean_scan(df: DataFrame, target: str, numeric: Sequence[str] = (), as_is: bool = False) -> DataFrame:
    """The rows of :func:`clean` for a table that is a scan, without moving rows that occur once; with ``as_is``, ``df`` itself where
    it is clean already.

    A row whose hash no other row has is distinct. Only hashes are shuffled to find the others, and only these
    are compared whole.
    """
    rows = require_numeric(normalise_text(df, target), numeric)
    counts = rows.select(row_digests(rows)[0].alias("__digest")).groupBy("__digest").agg(F.count(F.lit(1)).alias("__copies"))
    with settings(df.sparkSession, **SHORT_METHODS):
        repeated = materialize(counts.where("__copies > 1").select("__digest"), "repeated-hashes")
        known = repeated.limit(MOST_REPEATED + 1).count()
    if known == 0:
        return df if as_is and is_normal(df, target) else rows
    if known > MOST_REPEATED:
        return distinct_rows(rows)
    marked = rows.withColumn("__digest", row_digests(rows)[0])
    once = marked.join(F.broadcast(repeated), "__digest", "left_anti").drop("__digest")
    again = marked.join(F.broadcast(repeated), "__digest", "left_semi").drop("__digest")
    return once.unionByName(distinct_rows(again))


def clean_counts(raw: DataFrame, target: str, cleaned: DataFrame | None = None, copies: DataFrame | None = None) -> DataFrame:
    """``rows_before, rows_after, rows_removed, raw_duplicates`` of :func:`clean`.

    ``raw_duplicates`` counts copies before the text is normalised, ``rows_removed`` after. Where the result of :func:`clean`
    is stored, pass it as ``cleaned``: its rows are those after. ``copies`` is :func:`duplicate_count` of ``raw``.
    """
    before = (duplicate_count(raw) if copies is None else copies).select(
        F.col("row_count").alias("rows_before"), F.col("distinct_rows").alias("raw_distinct")
    )
    if cleaned is None:
        after = _rows_and_distinct(normalise_text(raw, target), "rows_normalised", "rows_after")
    else:
        after = cleaned.agg(F.count(F.lit(1)).alias("rows_after"))
    rows = before.select("rows_before", (F.col("rows_before") - F.col("raw_distinct")).alias("raw_duplicates"))
    return rows.select(
        "rows_before",
        after.select("rows_after").scalar().alias("rows_after"),
        "raw_duplicates",
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        "raw_duplicates",
    )


def row_digests(df: DataFrame) -> list[Column]:
    """``__digest1, __digest2``: two 64-bit hashes of a row."""
    values = [col(c) for c in df.columns]
    gaps = F.array(*[v.isNull() for v in values])
    return [F.xxhash64(F.lit(seed), gaps, *values).alias(f"__digest{seed}") for seed in (1, 2)]


def _rows_and_distinct(df: DataFrame, rows: str, distinct: str) -> DataFrame:
    # Counts need no values: rows are told apart by two 64-bit hashes, so no text is shuffled.
    copies = df.select(*row_digests(df)).groupBy("__digest1", "__digest2").agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).cast("bigint").alias(rows),
        F.count(F.lit(1)).alias(distinct),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``row_count, distinct_rows, duplicate_rows`` over all (or the named) columns."""
    picked = df.select(*[col(c) for c in columns]) if columns else df
    return _rows_and_distinct(picked, "row_count", "distinct_rows").withColumn(
        "duplicate_rows", F.col("row_count") - F.col("distinct_rows")
    )


def unexpected_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values of ``column`` outside the allowed set, with their counts."""
    return (
        df.where(col(column).isNotNull() & ~col(column).isin(*allowed))
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def equal_rows(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one group."""
    return df.where(col(column) == F.lit(value))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns of the rows in which none of them is NULL."""
    return df.select(*[col(c) for c in columns]).na.drop("any")


def outside_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows strictly below ``low`` or strictly above ``high``."""
    return df.where((col(column) < F.lit(low)) | (col(column) > F.lit(high)))


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Preview: the first ``n`` rows in key order (a per-task top-n, no full sort)."""
    return df.orderBy(*[col(c) for c in order_by]).limit(n)
