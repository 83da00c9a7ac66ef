"""Seeded, exact, reproducible row selection by key hash.

A row's place in the random order is the MD5 of its key and the seed, so the choice does not
depend on partitioning, file order or recomputation after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.sources.scratch import materialize

# Hex digits of the hash that name a bucket. A boundary bucket that still holds more than EDGE_ROWS
# rows is cut again by as many further digits.
BUCKET_DIGITS = 4
EDGE_ROWS = 500_000
_DIGITS = 32


def order_hash(key: Sequence[str], seed: int) -> Column:
    """Hex text that orders rows at random for this seed."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def stratified_split(
    df: DataFrame,
    target: str,
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    ties: Sequence[str] = (),
    out: str = "split",
) -> DataFrame:
    """Add ``out`` = 'train' / 'test' with ceil(test_size * n) test rows shared over the classes
    in proportion (largest remainder). Rows without a class are left out.

    Narrow passes over key and class find, per class, the last test row in hash order: counts
    per hash bucket, again inside the bucket the quota ends in while that is large, then an ordering
    of what is left. Placing the rows is then a comparison with that cut point, without any shuffle.
    ``key`` with ``ties`` should identify a row; rows equal in both land on the same side, so only
    then is the quota met to the row. An empty key stands for all columns, which identify a row once
    duplicates are gone.
    """
    key = key or df.columns
    narrow = df.where(col(target).isNotNull()).select(
        col(target).alias("__class"), order_hash(key, seed).alias("__hash"), *[col(t).alias(f"__t_{t}") for t in ties]
    )
    order = ["__hash", *[f"__t_{t}" for t in ties]]
    bucket = F.substring("__hash", 1, BUCKET_DIGITS)
    # At most 16^4 rows per class.
    buckets = materialize(
        narrow.groupBy("__class", bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__here")), "buckets"
    )

    classes = buckets.groupBy("__class").agg(F.sum("__here").alias("__size"))
    whole = classes.agg(F.sum("__size").alias("rows")).scalar()
    wanted_total = F.ceil(whole * F.lit(float(test_size)))
    exact = F.col("__size") * (wanted_total / whole)
    quotas = classes.withColumn("__floor", F.floor(exact)).withColumn("__rest", exact - F.floor(exact))
    spare = wanted_total - quotas.agg(F.sum("__floor")).scalar()
    # One row per class: the ranking that hands out the spare rows is over classes, not rows.
    by_rest = Window.partitionBy(F.lit(0)).orderBy(F.col("__rest").desc(), F.col("__class").asc())
    quotas = quotas.withColumn("__rank", F.row_number().over(by_rest)).select(
        F.col("__class"), (F.col("__floor") + (F.col("__rank") <= spare).cast("int")).alias("__quota")
    )
    upto = Window.partitionBy("__class").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = buckets.join(quotas, "__class").withColumn(
        "__before", F.coalesce(F.sum("__here").over(upto), F.lit(0))
    )
    def boundary(running: DataFrame) -> DataFrame:
        """Per class: the bucket the quota ends in, its rows, and how many of them are test rows."""
        inside = (F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__here") >= F.col("__quota"))
        cut, need = F.col("__bucket").alias("__cut"), (F.col("__quota") - F.col("__before")).alias("__need")
        return materialize(running.where(inside).select("__class", cut, need, "__here"), "cut-buckets")

    ends, digits = boundary(running), BUCKET_DIGITS
    while digits < _DIGITS and not ends.where(F.col("__here") > EDGE_ROWS).isEmpty():
        known = ends.select("__class", "__cut", F.col("__need").alias("__quota"))
        inner = narrow.join(known, "__class").where(F.substring("__hash", 1, digits) == F.col("__cut"))
        digits += BUCKET_DIGITS
        inner = inner.groupBy("__class", "__quota", F.substring("__hash", 1, digits).alias("__bucket")).agg(F.count(F.lit(1)).alias("__here"))
        ends = boundary(inner.withColumn("__before", F.coalesce(F.sum("__here").over(upto), F.lit(0))))

    edge = narrow.join(ends, "__class").where(F.substring("__hash", 1, digits) == F.col("__cut"))
    in_order = Window.partitionBy("__class").orderBy(*order)
    last = edge.withColumn("__place", F.row_number().over(in_order)).where(F.col("__place") == F.col("__need"))
    points = materialize(
        last.select(F.col("__class"), F.struct(*order).alias("__point")), "cut-points"
    )

    here = F.struct(order_hash(key, seed).alias("__hash"), *[col(t).alias(f"__t_{t}") for t in ties])
    placed = df.where(col(target).isNotNull()).join(
        points, col(target) == F.col("__class"), "left"
    )
    side = F.when(here <= F.col("__point"), F.lit("test")).otherwise(F.lit("train"))
    return placed.select(*[col(c) for c in df.columns], side.alias(out))


def fixed_sample(
    df: DataFrame, key: Sequence[str], n: int = 5000, seed: int = 42, ties: Sequence[str] = ()
) -> DataFrame:
    """``n`` rows chosen at random by key hash (all rows when there are fewer).

    Rows whose hash is below a threshold that about n rows fall under are counted and sorted; the
    rest is never moved. An empty key stands for all columns.
    """
    key = key or df.columns
    hashed = df.withColumn("__hash", order_hash(key, seed))
    rows = df.count()
    share = (n + 6 * n**0.5 + 10) / max(rows, 1)
    place = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    while share < 1:
        low = hashed.where(place < share)
        if low.count() >= n:
            return low.orderBy("__hash", *[col(t) for t in ties]).limit(n).drop("__hash")
        share *= 2
    return hashed.orderBy("__hash", *[col(t) for t in ties]).limit(n).drop("__hash")
