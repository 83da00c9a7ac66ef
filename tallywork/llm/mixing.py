"""Mixing sources to target weights: hash-random order per source, running token counts, exact cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field, free_names, number_copies
from tallywork.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most_epochs: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_bucket: int = 2_000,
) -> DataFrame:
    """How much of every row a mix takes: (doc_id, source, digest, size, source_size, target, copies, taken).

    Sources in code point order, NULL last, get ``weights`` in turn. Together they are to give ``share``
    of all words; none gives more than ``most_epochs`` times its own, and what it cannot give is shared
    out again by weight. A source gives whole epochs first; for the rest its rows are ordered by a hash
    and taken up to the exact word, so only the row at the cut is taken in part: ``taken`` counts words
    over all epochs, ``copies`` the epochs that take any of the row.

    The hash order is cut into buckets of about ``rows_per_bucket`` rows, whose sums give the running
    count at each bucket's start; one task sorts one bucket, whatever share of the rows a source holds.
    Only ids, digests and counts are shuffled. The table of sources, one row each, is sorted in one task.
    A NULL text has no words, and a row without words is taken with the epochs it lies in; equal rows
    are told apart by a number; a table without words gives targets of 0; other columns are ignored.
    """
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    slim = docs.select(
        field(id_col).cast("long").alias("doc_id"),
        field(source_col).cast("string").alias("source"),
        F.md5(text).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("copy").cast("string")))
    rows = materialize(number_copies(slim).withColumn("key", key).drop("copy"), "mix-rows")
    sources = materialize(source_targets(rows, weights, share, most_epochs), "mix-sources")

    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / rows_per_bucket))
    placed = (
        rows.withColumnRenamed("source", "_source")
        .join(sources, F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("bucket", F.floor(place * buckets))
        .drop("_source")
    )
    of_source = Window.partitionBy("turn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("turn", "bucket")
        .agg(F.sum("size").alias("_sum"))
        .select("turn", "bucket", F.coalesce(F.sum("_sum").over(of_source), F.lit(0)).alias("start"))
    )
    of_bucket = Window.partitionBy("turn", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(of_bucket), F.lit(0))
    left = F.col("rest") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return (
        placed.join(starts, ["turn", "bucket"])
        .withColumn("before", before)
        .select(
            "doc_id",
            "source",
            "digest",
            "size",
            "source_size",
            "target",
            (F.col("epochs") + (left > 0).cast("int")).cast("int").alias("copies"),
            (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        )
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix_sources` takes them; rows at a cut whole.

    Rows equal in id, source and text are taken as often as they are together, in the form that is
    least over all columns.
    """
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    names = free_names(docs, "key", "id", "of", "digest", "copies", "rows", "copy", "row")
    key, own_id, own_source, digest, copies, rows, copy, row = names
    wanted = mix.groupBy(F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("digest").alias(digest)).agg(
        F.sum("copies").alias(copies), F.count(F.lit(1)).alias(rows)
    )
    wanted = materialize(wanted, "mix-wanted")
    columns = [field(c) for c in docs.columns]
    keyed = docs.withColumn(key, F.md5(F.coalesce(field(text_col).cast("string"), F.lit(""))))
    same = (
        (F.col(key) == F.col(digest))
        & field(id_col).cast("long").eqNullSafe(F.col(own_id))
        & field(source_col).cast("string").eqNullSafe(F.col(own_source))
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(copy)
    taken = wanted.filter(F.col(copies) > 0)
    single = keyed.join(taken.filter(F.col(rows) == 1), same).select(*columns, each).drop(copy)
    repeated = taken.filter(F.col(rows) > 1)
    if repeated.isEmpty():
        return single
    least = F.min(F.struct(*columns)).alias(row)
    forms = keyed.join(repeated, same).groupBy(own_id, own_source, digest, copies).agg(least)
    return single.union(forms.select(f"{row}.*", each).drop(copy))


def source_targets(rows: DataFrame, weights: tuple[int, ...], share: float, most_epochs: int) -> DataFrame:
    """(source, turn, source_rows, source_size, target, epochs, rest) from rows of (source, size).

    With caps c and weights w, the capped sources are those of least c / w; the level that shares the
    rest by weight follows from running sums in that order.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("turn") % len(weights) + 1)
    by_room = Window.orderBy("room", "turn")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(onward)
    leveled = (
        rows.groupBy("source")
        .agg(F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size"))
        .withColumn("turn", turn)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most_epochs)
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("place", F.row_number().over(by_room))
    )
    chosen = F.min(F.when(F.col("level") <= F.col("room"), F.struct("place", "level"))).over(everything)
    target = F.when(F.col("place") < F.col("chosen.place"), F.col("cap").cast("double")).otherwise(F.col("chosen.level") * F.col("weight"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return (
        leveled.withColumn("chosen", chosen)
        .withColumn("target", F.coalesce(target, F.lit(0.0)))
        .withColumn("epochs", epochs)
        .select(
            "source", "turn", "source_rows", "source_size", "target", "epochs",
            F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long").alias("rest"),
        )
    )
