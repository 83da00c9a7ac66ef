"""Comparison of two tables row by row, without a key and without a sort: order-free digests of multisets.

Every row has a digest. The leading digits put it into a range, and sums of the remaining digits tell, with
the row counts, whether a range holds the same rows the same number of times on both sides. Only ranges
that differ are compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.sources.scratch import materialize

DIGITS = 2  # hexadecimal digits of a digest that name its range: 256 ranges


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of the columns' texts; lengths keep values apart, a dash stands for NULL."""
    texts = [col(c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _digits(digest: Column, start: int) -> Column:
    """Twelve hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, start, 12), 16, 10).cast("decimal(38,0)")


def _digested(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    rows = df.select(*[col(c) for c in columns], row_digest(columns).alias("__digest"))
    return rows.withColumn("range", F.substring("__digest", 1, digits))


def range_digests(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """``range, rows, digest_a, digest_b``: at most 16 ** digits rows, one partial record per task and range."""
    return _digested(df, columns, digits).groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_digits(F.col("__digest"), digits + 1)).alias("digest_a"),
        F.sum(_digits(F.col("__digest"), digits + 13)).alias("digest_b"),
    )


def compare_ranges(left: DataFrame, right: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """``range, left_rows, right_rows, matches``: equal counts of different rows do not match."""
    sides = [range_digests(df, columns, digits) for df in (left, right)]
    a, b = (df.select("range", F.struct("rows", "digest_a", "digest_b").alias(f"__{i}")) for i, df in enumerate(sides))
    both = a.join(b, "range", "full_outer")
    return both.select(
        "range",
        F.coalesce(F.col("__0.rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.col("__1.rows"), F.lit(0)).alias("right_rows"),
        F.col("__0").eqNullSafe(F.col("__1")).alias("matches"),
    )


def differing_rows(
    left: DataFrame, right: DataFrame, columns: Sequence[str], digits: int = DIGITS, ranges: DataFrame | None = None
) -> DataFrame:
    """Rows that one side holds more often: ``columns..., left_n, right_n``.

    Only rows of ranges that do not match (``ranges`` from :func:`compare_ranges`, computed if not
    given) are shuffled, counted per task first.
    """
    known = compare_ranges(left, right, columns, digits) if ranges is None else ranges
    wrong = F.broadcast(materialize(known.where(~F.col("matches")).select("range"), "ranges"))  # 16 ** digits names at most
    out = None
    for df, own in ((left, "left_n"), (right, "right_n")):
        here = _digested(df, columns, digits).join(wrong, "range", "left_semi")
        counts = {n: F.lit(1) if n == own else F.lit(0) for n in ("left_n", "right_n")}
        part = here.select(*[col(c) for c in columns], "__digest", *[v.alias(n) for n, v in counts.items()])
        out = part if out is None else out.unionByName(part)
    summed = out.groupBy("__digest", *[col(c) for c in columns]).agg(F.sum("left_n").alias("left_n"), F.sum("right_n").alias("right_n"))
    return summed.where("left_n <> right_n").drop("__digest")
