"""Connected components of a link table, by stars that shrink towards the least member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.sources.scratch import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the least node of its component.

    Every round hangs all neighbours of a node on their least one, first the larger, then the smaller
    ones, until nothing moves. The least neighbour comes from an aggregate that is stored and merged back, so
    both sides of the join are plain shuffles and Spark can split a node with very many links. Each round's
    links are stored. Links with a NULL end or between a node and itself are ignored.
    """
    kept = materialize(_ordered(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "component-links")
    state = None
    while True:
        both = kept.union(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = _ordered(both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large, "component-large")
        least = _least(large)
        down = large.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = materialize(_ordered(down.union(least.select("u", F.col("m").alias("v")))), "component-links")
        now = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = kept.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return kept.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _least(links: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of every node, stored."""
    return materialize(links.groupBy("u").agg(F.min("v").alias("m")), "component-least")


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end."""
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
