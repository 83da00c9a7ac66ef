"""Pearson and Spearman correlation in long form ``(column_a, column_b, r)``."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col, indicator, one_row_to_long
from tallywork.functions.numeric import finite_or_null
from tallywork.operators.frequency import numeric_frequencies
from tallywork.operators.order import average_ranks
from tallywork.sources.scratch import materialize

# A value filling at least one row in HOT_SHARE is hot; there can be at most HOT_SHARE of them.
HOT_SHARE = 1000


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r as one aggregate expression; NULL for a constant side."""
    both_a = F.when(b.isNotNull(), a)
    both_b = F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_samp(a, b), F.stddev_samp(both_a) * F.stddev_samp(both_b))
    return F.when(r > 1.0, F.lit(1.0)).when(r < -1.0, F.lit(-1.0)).otherwise(r)


def _pair_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = list(combinations(columns, 2))
    one = df.agg(*[pearson(col(a), col(b)).alias(f"__{i}") for i, (a, b) in enumerate(pairs)])
    return one_row_to_long(
        one,
        [
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"__{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ],
    )


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[finite_or_null(col(c)).alias(c) for c in columns])


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the Pearson matrix: all pairs in one aggregate over one scan."""
    return _pair_table(_numbers(df, columns), columns)


def _with_gaps(numbers: DataFrame, columns: Sequence[str]) -> set[str]:
    """Columns with a missing value: one narrow aggregate."""
    one = numbers.agg(F.count(F.lit(1)), *[F.count(col(c)) for c in columns]).first()
    return {c for c, n in zip(columns, one[1:], strict=True) if n < one[0]}


def _pairwise_ranked(numbers: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Spearman r of pairs with missing values, each over its own complete rows, all in one chain of jobs.

    Rows are counted by (pair, a, b); a pair's side is a rank domain of its own, so one frequency table and one prefix sum
    give the ranks of every pair, and two joins by (domain, value) attach them to the counts.
    """
    both = [
        F.when(col(a).isNotNull() & col(b).isNotNull(), F.struct(F.lit(i).alias("pair"), col(a).alias("a"), col(b).alias("b")))
        for i, (a, b) in enumerate(pairs)
    ]
    complete = numbers.select(F.explode(F.array_compact(F.array(*both))).alias("p")).select("p.*")
    joint = materialize(complete.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n")), "joint-frequencies")

    def side(name: str) -> DataFrame:
        return joint.select(F.concat(F.lit(name), F.col("pair").cast("string")).alias("column"), F.col(name).alias("value"), "n")

    freq = side("a").unionByName(side("b")).groupBy("column", "value").agg(F.sum("n").alias("n"))
    ranks = materialize(average_ranks(materialize(freq, "numeric-frequencies")), "ranks")
    ranks = ranks.select(F.substring("column", 1, 1).alias("__side"), F.substring("column", 2, 9).cast("int").alias("pair"), "value", "rank", "n_total")
    for name in ("a", "b"):
        own = ranks.where(F.col("__side") == name).select("pair", F.col("value").alias(name), F.col("rank").alias(f"rank_{name}"), F.col("n_total").alias(f"total_{name}"))
        joint = joint.join(own, ["pair", name])
    x, y = (F.col(f"rank_{s}") - (F.col("total_a") + 1) / 2.0 for s in ("a", "b"))  # the mean of mid-ranks is known
    n = F.col("n")
    r = F.try_divide(F.sum(n * x * y), F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y)))
    found = joint.groupBy("pair").agg(r.alias("r"))
    found = found.withColumn("r", F.when(F.col("r") > 1.0, F.lit(1.0)).when(F.col("r") < -1.0, F.lit(-1.0)).otherwise(F.col("r")))
    names = numbers.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, column_a string, column_b string")
    return F.broadcast(names).join(found, "pair", "left").select("column_a", "column_b", "r")


def _attach_rank(rows: DataFrame, ranks: DataFrame, name: str, spread: str, kinds: set[bool]) -> DataFrame:
    """Replace column ``name`` by the rank of its value; ``kinds`` tells whether hot values and others occur.

    Hot values (at most HOT_SHARE of them, by definition) come from a broadcast list. The rest
    join by value: no remaining key holds more than a thousandth of the rows. Rows already served
    get a NULL key with a spread second key, so they do not gather in one task either. A column of
    hot values alone moves no row.
    """
    found, served = rows, F.lit(False)
    if True in kinds:
        hot = ranks.where("hot").select(F.col("value").alias("__hot"), F.col("rank").alias("__hot_rank"))
        found = found.join(F.broadcast(hot), col(name) == F.col("__hot"), "left")
        served = F.col("__hot_rank").isNotNull()
    if False in kinds:
        # The second key is a hash on both sides: Spark would take a constant out of the join's keys, which would leave the NULLs together.
        own = F.xxhash64(col(name) + F.lit(0.0))
        cold = ranks.where("NOT hot").select(
            F.col("value").alias("__cold"), F.xxhash64(F.col("value") + F.lit(0.0)).alias("__lane"), F.col("rank").alias("__cold_rank")
        )
        lane = F.when(served, F.xxhash64(col(spread))).otherwise(own)
        found = found.withColumn("__key", F.when(~served, col(name))).withColumn("__at", lane)
        found = found.join(cold, (F.col("__key") == F.col("__cold")) & (F.col("__at") == F.col("__lane")), "left")
    ranked = F.coalesce(*[F.col(c) for c in ("__hot_rank", "__cold_rank") if c in found.columns])
    return found.withColumn(name, ranked).drop("__hot", "__hot_rank", "__key", "__at", "__cold", "__lane", "__cold_rank")


def _rank_rows(numbers: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """Rows with every column replaced by its mid-rank.

    The rank tables are written once, so the planner knows their real size: below its broadcast
    threshold the row side is not shuffled at all, above it the join is by value.
    """
    if counted is None:
        freq = numeric_frequencies(numbers, columns)
    else:
        own = counted.where(F.col("column").isin(*columns) & F.col("value").isNotNull())
        freq = own.groupBy("column", "value").agg(F.sum("n").alias("n"))
    ranks = average_ranks(materialize(freq, "numeric-frequencies"))
    ranks = materialize(ranks.withColumn("hot", F.col("n") * HOT_SHARE >= F.col("n_total")), "ranks", partition_by=("column", "hot"))
    kinds = {(r["column"], r["hot"]) for r in ranks.select("column", "hot").distinct().collect()}  # two for a column
    # A row's place in the stored files: it differs from row to row even where all columns have few values.
    ranked = numbers.withColumn("__row", F.monotonically_increasing_id())
    for name in columns:
        own = {hot for column, hot in kinds if column == name}
        if own:  # an empty table has no ranks
            ranked = _attach_rank(ranked, ranks.where(F.col("column") == name), name, "__row", own)
    return ranked.drop("__row")


def spearman_pairs(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """Upper triangle of the Spearman matrix, pairwise complete.

    Columns without missing values share one rank per column. A pair with a missing value is ranked over
    its own complete rows. The narrow columns are stored once, and all passes read them there. ``counted`` is a stored
    frequency table of the columns; a value may have several rows in it.
    """
    numbers = materialize(_numbers(df, columns), "numbers")
    gaps = _with_gaps(numbers, columns)
    whole = [c for c in columns if c not in gaps]
    apart = [p for p in combinations(columns, 2) if gaps.intersection(p)]
    out = _pair_table(_rank_rows(numbers.select(*[col(c) for c in whole]), whole, counted), whole) if len(whole) > 1 else None
    if apart:
        ranked = _pairwise_ranked(numbers, apart)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def matrix_cells(pairs: DataFrame) -> DataFrame:
    """Heat-map cells: both triangles and a diagonal of 1 (NULL when the column is constant)."""
    names = ("column_a", "column_b", "r")
    mirrored = pairs.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "r")
    both = pairs.select(*names).unionByName(mirrored)
    diagonal = both.groupBy("column_a").agg(F.count("r").alias("known")).select(
        "column_a",
        F.col("column_a").alias("column_b"),
        F.when(F.col("known") > 0, F.lit(1.0)).alias("r"),
    )
    return both.unionByName(diagonal)


def top_pairs(pairs: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` pairs with the largest absolute correlation."""
    strongest = [F.abs("r").desc_nulls_last(), F.col("column_a").asc(), F.col("column_b").asc()]
    return pairs.orderBy(*strongest).limit(k)


def largest_gap(left: DataFrame, right: DataFrame) -> DataFrame:
    """``max_gap``: the largest absolute difference between two pair tables."""
    other = right.withColumnRenamed("r", "__other")
    return left.join(other, ["column_a", "column_b"]).agg(F.max(F.abs(F.col("r") - F.col("__other"))).alias("max_gap"))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str, positive: str) -> DataFrame:
    """``column, r``: correlation of each column with the 0/1 target indicator."""
    numbers = df.select(
        indicator(col(target), positive).cast("double").alias("__flag"),
        *[finite_or_null(col(c)).alias(c) for c in columns],
    )
    one = numbers.agg(*[pearson(col(c), F.col("__flag")).alias(f"__{i}") for i, c in enumerate(columns)])
    return one_row_to_long(
        one,
        [F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("r")) for i, c in enumerate(columns)],
    )
