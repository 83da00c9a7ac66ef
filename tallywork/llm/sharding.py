"""Shards of near-equal bytes: ranges of a key, cut at splitters drawn from a size-weighted sample."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field, free_names, number_copies, sortable_long
from tallywork.sources.scratch import materialize

OVERHEAD = 8  # bytes a record costs besides its text
SAMPLE_PER_RANGE = 20
_UNIT = float(1 << 32)


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges_per_shard: int = 16,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """Place every row of ``docs``: (doc_id, size, text_crc32, shard, slot).

    Rows are ordered by a digest of their text, then by id, so equal texts lie together and a group of
    copies may run on over several shards. The order is cut into ranges at splitters from a sample in
    which a row's chance follows its size; ranges that turn out to hold over twice their share of
    bytes or rows are cut again. Running byte counts over ranges and inside each range then give every
    row its place, and shard k takes the rows whose middle byte lies in the k-th equal part: no shard
    is further than one record from its share. Slots count from 0 within a shard, without gaps.

    Only ids, sizes and digests are shuffled; one task sorts one range. At most ``SAMPLE_PER_RANGE``
    sampled keys per range reach one task, and one splitter per range the driver. A NULL text counts as
    empty; NULL ids come first; equal rows are placed one after another; an empty table gives no rows;
    other columns are ignored.
    """
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    slim = docs.select(
        field(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("digest"),
    )
    key = F.concat(F.col("digest"), sortable_long(F.col("doc_id")), sortable_long(F.col("copy")))
    rows = materialize(number_copies(slim).withColumn("key", key).drop("digest", "copy"), "shard-rows")
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    pieces = max(shards * ranges_per_shard, math.ceil(count / rows_per_range))
    most_bytes, most_rows = 2 * total / pieces, max(1, 2 * count / pieces)
    splitters = _splitters(rows, F.col("size").cast("double"), float(total), pieces)
    while True:
        ranged = rows.withColumn("range", _range_of(F.col("key"), splitters))
        sums = materialize(
            ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-ranges"
        )
        over = sums.filter(((F.col("bytes") > most_bytes) | (F.col("n") > most_rows)) & (F.col("n") > 1))
        cost = F.col("bytes") / (most_bytes / 2) + F.col("n") / (most_rows / 2)
        overfull = over.agg(F.collect_list("range"), F.sum(cost)).first()
        if not overfull[0]:
            break
        inside = ranged.filter(F.array_contains(F.lit(overfull[0]), F.col("range")))
        weight = F.col("size") / (most_bytes / 2) + F.lit(1 / (most_rows / 2))
        more = sorted({*splitters, *_splitters(inside, weight, overfull[1], math.ceil(overfull[1]) + 1)})
        if len(more) == len(splitters):  # what is left cannot be cut: a record larger than a range
            break
        splitters = more

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("range_start"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_row"),
    )
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    row = F.col("range_row") + F.count(F.lit(1)).over(inside)
    middle = (2 * F.col("start") + F.col("size")) * shards
    placed = materialize(
        ranged.join(F.broadcast(starts), "range")  # one row per range
        .select("doc_id", "size", "text_crc32", start.alias("start"), row.alias("row"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / F.lit(2 * total))).cast("int"))
        .drop("start"),
        "shard-places",
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the records of ``docs`` (ids unique, no columns named shard or slot) as Parquet, one folder per shard, in slot order per file."""
    (own_id,) = free_names(docs.select(*[field(c) for c in docs.columns], F.lit(0).alias("shard"), F.lit(0).alias("slot")), "id")
    places = placed.select(F.col("doc_id").alias(own_id), "shard", "slot")
    rows = docs.join(places, field(id_col).eqNullSafe(F.col(own_id))).drop(own_id)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def _splitters(rows: DataFrame, weight: Column, total: float, pieces: int) -> list[str]:
    """Keys that cut the rows into about ``pieces`` parts of equal weight.

    A row is drawn with a chance proportional to its weight (at most 1) by a hash of its key, and stands
    for its weight over that chance, so the drawn rows' running weights estimate all rows' ones.
    """
    step = total / (pieces * SAMPLE_PER_RANGE)
    chance = F.least(F.lit(1.0), weight / F.lit(step))
    draw = F.shiftrightunsigned(F.xxhash64(F.col("key"), F.lit(pieces)), 32) / F.lit(_UNIT)
    drawn = rows.select("key", weight.alias("weight"), chance.alias("chance"), draw.alias("draw")).filter("draw < chance")
    upto = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    at = F.floor(F.sum(F.col("weight") / F.col("chance")).over(upto) / F.lit(total / pieces))
    marks = drawn.select("key", at.alias("piece")).groupBy("piece").agg(F.min("key").alias("key"))
    return sorted(r[0] for r in marks.select("key").distinct().collect())


def _range_of(key: Column, splitters: list[str]) -> Column:
    """Number of splitters at or below the key, by halving over one constant array."""
    if not splitters:
        return F.lit(0).cast("long")
    edges = F.split(F.lit(",".join(splitters)), ",")
    size = len(splitters)
    steps = [1 << b for b in reversed(range(size.bit_length()))]

    def advance(at: Column, step: Column) -> Column:
        there = at + step
        return F.when((there <= size) & (F.try_element_at(edges, there) <= key), there).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), advance).cast("long")
