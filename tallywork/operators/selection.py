"""Exact order statistics by multi-pass selection, without moving or sorting the values.

Every double has a 64-bit key that sorts like the number. A pass counts values by the leading bits of
their keys, finds the bins that hold a wanted rank, and the next pass looks only inside these bins, a few
bits further. What is shuffled is one record per task and occupied bin; a bin whose least and greatest
value are equal is settled, so whole-numbered columns need one or two passes and none needs more than four.

Broadcast here: the wanted bins, at most two per probability and column. With ``by`` there are as many
for each group, so then Spark joins the stored bins by their size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.sources.scratch import materialize

BITS = (22, 14, 14, 14)  # of the key, pass by pass; the first bins hold sign, exponent and ten digits
_HALF = -1022  # least exponent of a normal double
_MOST = 1023  # and the greatest
_LARGEST = 1.7976931348623157e308


def order_key(value: Column) -> Column:
    """A signed 64-bit integer in the order of the number: the bits of its size, with its sign. Infinities stand outside.

    Exponent and fraction come from a logarithm, corrected by one where it was rounded; powers of two
    and their quotients are exact.
    """
    whole = F.abs(value)
    size = F.least(whole, F.lit(_LARGEST))
    rough = F.greatest(F.floor(F.log2(size)), F.lit(_HALF)).cast("double")
    up = size >= F.pow(F.lit(2.0), rough + 1)
    down = (size < F.pow(F.lit(2.0), rough)) & (rough > _HALF)
    exponent = rough + F.when(up, 1.0).when(down, -1.0).otherwise(0.0)
    digits = (size / F.pow(F.lit(2.0), exponent) * F.lit(float(1 << 52))).cast("bigint")
    bits = (exponent - F.lit(float(_HALF))).cast("bigint") * F.lit(1 << 52) + digits
    bits = bits + (whole > size).cast("bigint")  # infinity follows the largest number
    return F.when(size == 0, F.lit(0).cast("bigint")).otherwise(F.when(value < 0, -bits).otherwise(bits))


def with_order_key(values: DataFrame) -> DataFrame:
    """Add ``__key``, the :func:`order_key` of ``value``; rows without a value are left out.

    The parts are columns of their own, so each is computed once for a row. As one expression they are repeated inside
    each other, and again in the checks for NULL that Spark puts before a join by the key, which makes code too long to be
    compiled. A key that is never NULL has no such checks.
    """
    value, size, rough, power, turn = (F.col(c) for c in ("value", "__size", "__rough", "__power", "__turn"))
    two, zero = F.lit(2.0), F.lit(0).cast("bigint")
    digits = (size / (power * F.when(turn > 0, 2.0).when(turn < 0, 0.5).otherwise(1.0)) * F.lit(float(1 << 52))).cast("bigint")
    bits = (rough + turn - F.lit(float(_HALF))).cast("bigint") * F.lit(1 << 52) + digits
    steps = {
        "__size": F.least(F.abs(value), F.lit(_LARGEST)),
        "__rough": F.least(F.greatest(F.floor(F.log2(size)), F.lit(_HALF)), F.lit(_MOST)).cast("double"),
        "__power": F.pow(two, rough),
        "__turn": F.when(size >= power * two, 1.0).when((size < power) & (rough > _HALF), -1.0).otherwise(0.0),
        "__bits": F.when(size == 0, zero).otherwise(bits + (F.abs(value) > size).cast("bigint")),
        "__key": F.coalesce(F.when(value < 0, -F.col("__bits")).otherwise(F.col("__bits")), zero),
    }
    out = values.where(value.isNotNull())
    for name, part in steps.items():
        out = out.withColumn(name, part)
    return out.drop(*list(steps)[:-1])


def _ranks(probabilities: Mapping[str, float], total: Column) -> Column:
    """Both ranks of every probability, and where between them it lies, as an array of structs."""
    out = []
    for name, p in probabilities.items():
        place = (total - 1) * F.lit(float(p))
        low = F.floor(place)
        for end, rank in (("lo", low), ("hi", F.least(low + 1, total - 1))):
            out.append(F.struct(F.lit(name).alias("name"), F.lit(end).alias("end"), rank.alias("rank"), (place - low).alias("part")))
    return F.array(*out)


def _bins(keyed: DataFrame, keys: Sequence[str], shift: int, n: Column) -> DataFrame:
    """Count, least and greatest value of every occupied bin of the leading bits."""
    return keyed.groupBy(*[col(k) for k in keys], F.shiftright("__key", shift).alias("__bin")).agg(
        F.sum(n).alias("__n"), F.min("value").alias("__least"), F.max("value").alias("__most")
    )


def _holding(bins: DataFrame, within: Sequence[str], start: Column, ranks: Column, keys: Sequence[str]) -> DataFrame:
    """Bins that hold wanted ranks: keys, bin, values before it, the ranks in it and its ends."""
    window = Window.partitionBy(*[col(k) for k in within]).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumn("__start", start + F.coalesce(F.sum("__n").over(window), F.lit(0)))
    inside = F.filter(ranks, lambda r: (r["rank"] >= F.col("__start")) & (r["rank"] < F.col("__start") + F.col("__n")))
    return placed.withColumn("__wanted", inside).where(F.size("__wanted") > 0).select(
        *[col(k) for k in keys], "__bin", "__start", "__wanted", "__least", "__most"
    )


def select_quantiles(
    values: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``(by..., column, <names>)``.

    ``values`` has ``column``, ``value`` (NULL is left out) and the ``by`` columns, one row per value or,
    with ``weight``, one per distinct value. It is scanned once per pass and never stored.
    """
    keys = [*by, "column"]
    keyed = with_order_key(values)
    for name in by:
        keyed = keyed.where(col(name).isNotNull())
    n = F.lit(1) if weight is None else col(weight)
    shift = 64 - BITS[0]
    bins = _bins(keyed, keys, shift, n)
    total = F.sum("__n").over(Window.partitionBy(*[col(k) for k in keys]))
    first = bins.withColumn("__ranks", _ranks(probabilities, total))
    found = materialize(_holding(first, keys, F.lit(0), F.col("__ranks"), keys), "selection")
    done = [found.where("__least = __most")]
    for bits in BITS[1:]:
        open_ = found.where("__least <> __most")
        if open_.isEmpty():
            break
        outer = open_.select(*[col(k) for k in keys], F.col("__bin").alias("__outer"), F.col("__start").alias("__from"), F.col("__wanted").alias("__ranks"))
        asked = outer.select(*[col(k) for k in keys], "__outer")
        inner = keyed.withColumn("__outer", F.shiftright("__key", shift)).join(asked if by else F.broadcast(asked), [*keys, "__outer"])
        shift -= bits
        bins = _bins(inner, [*keys, "__outer"], shift, n).join(outer if by else F.broadcast(outer), [*keys, "__outer"])
        found = materialize(_holding(bins, [*keys, "__outer"], F.col("__from"), F.col("__ranks"), keys), "selection")
        done.append(found.where("__least = __most"))
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    each = settled.select(*[col(k) for k in keys], F.col("__least").alias("__v"), F.inline("__wanted"))

    def end(name: str, which: str, what: str) -> Column:
        return F.max(F.when((F.col("name") == name) & (F.col("end") == which), F.col(what)))

    aggs = []
    for name in probabilities:
        low, high = end(name, "lo", "__v"), end(name, "hi", "__v")
        aggs.append((low + (high - low) * end(name, "lo", "part")).alias(name))
    return each.groupBy(*[col(k) for k in keys]).agg(*aggs)
