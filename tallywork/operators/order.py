"""Ranks and running sums without a global sort: distributed prefix sums over frequency tables.

A frequency table holds each value once per column. Its rows are put into buckets by the leading bits of
their order-preserving keys, and buckets with too many values are cut further down by the bits that follow, so the
bucket of a value is an expression of the value, whatever the skew of the raw rows. Bucket totals are small,
and only the inside of one bucket is ever sorted by one task.

Broadcast here: the names of buckets that are cut further, at most one per ``ROWS_PER_BUCKET`` rows of the frequency
table and level. They are stored first, so every branch of a plan cuts at the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.operators.selection import BITS, with_order_key
from tallywork.sources.scratch import materialize

ROWS_PER_BUCKET = 250_000


def with_buckets(freq: DataFrame, most: int | None = None) -> DataFrame:
    """Add ``bucket``, non-decreasing in ``value`` within each column, with about ``most`` rows or fewer each.

    A bucket is named by the key it begins with, so buckets cut at different depths keep the order of their values.
    """
    most = most or ROWS_PER_BUCKET
    shift = 64 - BITS[0]
    out = with_order_key(freq)
    out = out.withColumn("bucket", F.shiftleft(F.shiftright("__key", shift), shift))
    for bits in BITS[1:]:
        full = out.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most)
        full = materialize(full.select("column", "bucket", F.lit(True).alias("__full")), "full-buckets")
        if full.isEmpty():
            break
        shift -= bits
        finer = F.shiftleft(F.shiftright("__key", shift), shift)
        out = out.join(F.broadcast(full), ["column", "bucket"], "left")
        out = out.withColumn("bucket", F.when(F.col("__full"), finer).otherwise(F.col("bucket"))).drop("__full")
    return out.drop("__key")


def _bucket_offsets(bucketed: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per bucket: the sum of each measure before it, inside it, and over the whole column."""
    totals = bucketed.groupBy(*keys, "bucket").agg(*[F.sum(m).alias(f"{m}_here") for m in measures])
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = [*[F.col(k) for k in keys], F.col("bucket")]
    for m in measures:
        here = F.col(f"{m}_here")
        out += [
            here,
            (F.sum(here).over(upto) - here).alias(f"{m}_offset"),
            F.sum(here).over(whole).alias(f"{m}_total"),
        ]
    return totals.select(*out)


def _running(joined: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    inside = (
        Window.partitionBy(*keys, "bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = {
        f"{m}_before": F.col(f"{m}_offset") + F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures
    }
    return joined.withColumns(before).drop(*[f"{m}_{x}" for m in measures for x in ("offset", "here")])


def cumulate(
    freq: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = ("n",), most: int | None = None
) -> DataFrame:
    """Add ``{m}_before`` (sum over smaller values) and ``{m}_total`` to a frequency table.

    The shuffle on (keys, bucket) serves the join with the offsets and the window alike.
    """
    keys = [*by, "column"]
    bucketed = with_buckets(freq, most)
    offsets = _bucket_offsets(bucketed, keys, measures)
    return _running(bucketed.join(offsets, [*keys, "bucket"]), keys, measures)


def average_ranks(freq: DataFrame, by: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """Frequency table with the mid-rank of each value (ties share their mean rank)."""
    ranked = cumulate(freq, by, ("n",), most)
    return ranked.withColumn("rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))
