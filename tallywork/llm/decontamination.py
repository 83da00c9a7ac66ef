"""Benchmark decontamination by spaced seeds: masks that ignore some words, verified around every hit."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field, free_names
from tallywork.sources.scratch import materialize

# Words that a mask keeps; a 0 is a word that may differ. Any two places are left out together by one of the six.
MASKS = ("0011101100", "1101100010", "1010000111", "0110011010", "1001011001", "0100110101")
SPAN = len(MASKS[0])
PAD = 2  # words looked at before and after a seed
LEAST_EQUAL = 0.8  # share of a window's words that must be equal
STRETCH = 128  # seeds per stretch of a text
SEEDS_PER_BLOCK = 150_000  # seeds broadcast at once, of under 200 bytes each

_SPLIT = r"[^\p{L}\p{N}]+"


class Layout(NamedTuple):
    """Windows of ``span`` words and ``pad`` more at either end, and the masks over the span."""

    span: int
    pad: int
    masks: tuple[str, ...]

    @property
    def window(self) -> int:
        return self.span + 2 * self.pad


def layout(words: int) -> Layout:
    """The windows of items of so many words: of 14 from ten words on, else the whole item.

    A window counts with at most two words exchanged, a whole item of five to nine words with at most one (so
    one half is kept), a shorter one with none.
    """
    if words >= SPAN:
        return Layout(SPAN, PAD, MASKS)
    half = (words + 1) // 2
    return Layout(words, 0, ("1" * half + "0" * (words - half), "0" * half + "1" * (words - half)) if words > 4 else ("1" * words,))


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Benchmark passages inside documents: (doc_id, digest, item_id, windows, first_word, last_word, most_equal).

    Words are lower-cased runs of letters and digits. At every position of a document and of an item
    the words that a mask keeps are hashed, for each mask; equal hashes are hits. Around a hit a window
    of 14 words (less at an item's edges) is compared word by word, and counts when at least 0.8 of the
    item's words in it are equal at the same places: all but two. As some mask leaves out any two words, every
    window that counts is hit. An item of fewer than 10 words is one window, sought by its halves (up to 4
    words: as a whole). One row per document and item with a counted window: how many places, the first and
    last word that seeds cover, and the largest share of equal words.

    Documents are never shuffled before a hit is verified: the item side is joined by broadcast in
    blocks of at most ``SEEDS_PER_BLOCK`` seeds of fixed size, and a larger benchmark takes more blocks,
    one scan each; so do short items, for each length there is. Equal windows of several items are one seed. Texts are taken in stretches of 128
    seeds, so a very long one is spread over rows. NULL texts are empty and match nothing; a document
    of fewer than 10 words can hold only items that are no longer than itself; rows of the same id and text (``digest``) are one
    document; an empty side gives no rows; other columns are ignored.
    """
    found, held = [], []
    for shape in map(layout, _lengths(items, item_text_col)):
        seeds, windows = _item_seeds(items, item_col, item_text_col, shape)
        blocks = (seeds.agg(F.max("block")).first()[0] or 0) + 1
        places = _doc_seeds(docs, id_col, text_col, shape)
        found += [_verified(places, seeds.filter(F.col("block") == b), shape) for b in range(blocks)]
        held.append(windows)
    hits = reduce(DataFrame.union, found).groupBy("doc_id", "digest", "place", "last", "window").agg(F.max("equal").alias("equal"))
    return (
        hits.join(reduce(DataFrame.union, held), "window")
        .groupBy("doc_id", "digest", "item_id")
        .agg(
            F.count_distinct("place").alias("windows"),
            F.min("place").alias("first_word"),
            F.max("last").alias("last_word"),
            F.round(F.max("equal"), 6).alias("most_equal"),
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` in which :func:`find_leaks` finds nothing."""
    leaks = find_leaks(docs, items, id_col, text_col, **names)
    own_id, own_digest = free_names(docs, "leak_id", "leak_digest")
    leaks = materialize(leaks.select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest)).distinct(), "leak-documents")
    digest = F.xxhash64(F.coalesce(field(text_col).cast("string"), F.lit("")))
    return docs.join(leaks, field(id_col).cast("long").eqNullSafe(F.col(own_id)) & (digest == F.col(own_digest)), "left_anti")


def words_hashed(text: Column) -> Column:
    """64-bit hashes of a text's words."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _SPLIT), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _lengths(items: DataFrame, text_col: str) -> list[int]:
    """Lengths of items that have windows of their own: those below SPAN that there are, and SPAN for all others."""
    short = items.select(F.size(words_hashed(field(text_col))).alias("n")).filter(F.col("n").between(1, SPAN - 1)).distinct()
    return [SPAN, *sorted(r.n for r in short.collect())]


def _padded(hashes: Column, pad: int) -> Column:
    """Hashes between zeros at either end; zero is no word."""
    if not pad:
        return hashes
    zeros = F.array_repeat(F.lit(0).cast("long"), pad)
    return F.concat(zeros, hashes, zeros)


def _with_seed_hashes(placed: DataFrame, array: str, first: Column, shape: Layout) -> DataFrame:
    """Rows with ``hash``, one for each mask: of the words it keeps, from place ``first`` of the array on."""
    # the words become columns first, so that each is read once and the generated code stays short
    names = [f"word_{i}" for i in range(shape.span)]
    placed_words = placed.select("*", *[F.element_at(array, (first + i).cast("int")).alias(n) for i, n in enumerate(names)])
    hashes = F.array(*[F.xxhash64(*[n for n, keep in zip(names, mask, strict=True) if keep == "1"], F.lit(m)) for m, mask in enumerate(shape.masks)])
    return placed_words.select(*placed.columns, F.explode(hashes).alias("hash"))


def _item_seeds(items: DataFrame, item_col: str, text_col: str, shape: Layout) -> tuple[DataFrame, DataFrame]:
    """Seeds (hash, window, words, block) of distinct windows, and which items hold a window."""
    words = words_hashed(field(text_col))
    rows = items.select(field(item_col).cast("long").alias("item_id"), words.alias("w")).distinct()
    rows = rows.filter(F.size("w") >= SPAN if shape.span == SPAN else F.size("w") == shape.span).withColumn("w", _padded(F.col("w"), shape.pad))
    placed = rows.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.size("w") - shape.window + 1)).alias("at"))
    windows = placed.select("item_id", F.slice("w", F.col("at"), F.lit(shape.window)).alias("words")).withColumn("window", F.xxhash64("words"))
    held = materialize(windows.select("item_id", "window").distinct(), "leak-windows")
    distinct = windows.groupBy("window").agg(F.first("words").alias("words"))
    seeds = _with_seed_hashes(distinct, "words", F.lit(shape.pad + 1), shape)
    # row numbers by range of the hash: counted per range, so that no task sees all seeds
    part = F.shiftrightunsigned(F.col("hash"), 52)
    numbered = seeds.withColumn("part", part)
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    number = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("hash", "window")) - 1
    block = F.floor(number / F.lit(SEEDS_PER_BLOCK)).cast("int")
    return materialize(numbered.join(starts, "part").select("hash", "window", "words", block.alias("block")), "leak-seeds"), held


def _doc_seeds(docs: DataFrame, id_col: str, text_col: str, shape: Layout) -> DataFrame:
    """(doc_id, digest, offset, w, at, hash): every place and mask, with its stretch of the text."""
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    words = _padded(words_hashed(text), shape.pad)
    rows = docs.select(field(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), words.alias("w"))
    stretches = F.transform(
        F.sequence(F.lit(0), F.size("w") - shape.window, F.lit(STRETCH)),
        lambda i: F.struct(i.alias("offset"), F.slice("w", i + 1, F.lit(STRETCH - 1 + shape.window)).alias("w")),
    )
    # outer forms: the filter Spark derives from the inner ones would split every text twice
    cut = rows.select("doc_id", "digest", F.inline_outer(F.when(F.size("w") >= shape.window, stretches))).filter(F.col("w").isNotNull())
    placed = cut.select("doc_id", "digest", "offset", "w", F.explode_outer(F.sequence(F.lit(1), F.size("w") - shape.window + 1)).alias("at"))
    return _with_seed_hashes(placed, "w", F.col("at") + shape.pad, shape)


def _verified(places: DataFrame, seeds: DataFrame, shape: Layout) -> DataFrame:
    """Hits whose windows agree: (doc_id, digest, place, last, window, equal)."""
    # either broadcast has at most SEEDS_PER_BLOCK rows, of one number and of 16 at most
    near = places.join(F.broadcast(seeds.select("hash").distinct()), "hash", "left_semi")
    # the lambda ends the generated code here: with the comparison below in it, its loop over all places is too long to be compiled
    window = F.transform(F.slice("w", F.col("at"), F.lit(shape.window)), lambda w: w)
    near = near.select("doc_id", "digest", (F.col("offset") + F.col("at") - 1).alias("place"), window.alias("w"), "hash")
    hits = near.join(F.broadcast(seeds.drop("block")), "hash")
    pairs = [(F.element_at("w", F.lit(i + 1)), F.element_at("words", F.lit(i + 1))) for i in range(shape.window)]
    there = reduce(Column.__add__, [(b != 0).cast("int") for _, b in pairs])
    same = reduce(Column.__add__, [((b != 0) & (a == b)).cast("int") for a, b in pairs])
    hits = hits.select("doc_id", "digest", "place", (F.col("place") + shape.span - 1).alias("last"), "window", (same / there).alias("equal"))
    return hits.filter(F.col("equal") >= LEAST_EQUAL)
