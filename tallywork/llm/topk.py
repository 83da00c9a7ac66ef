"""Exact top-k search by inner product: postings scattered term by term into dense score arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field
from tallywork.sources.scratch import materialize

LEAST_BLOCK = 4096  # rows scored together in one task, at least, where the table has so many
MOST_BLOCK = 1 << 16  # and at most
_TILE = 64  # queries whose score arrays are held at once
_DENSE = 4  # a posting list over a quarter full is kept as a whole column

_SENT = "block int, side int, row long, vec_id long, v array<long>"
_FOUND = "query long, query_id long, vec_id long, row long, score long"


def quantise(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) for every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """No component is NULL, NaN or infinite."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & plain


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k rows of highest integer inner product for each query: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query itself;
    ties go to the smaller id. Rows are dealt by a hash into blocks. A task keeps one block as posting lists and streams all
    queries past it, keeping the k best of the block for each; a ranking by query merges the blocks. Rows move once and queries
    once per block of at most MOST_BLOCK rows; memory is that of a block, whatever the number of rows and queries.

    Vectors that are NULL or hold a NULL or non-finite component take no part, nor do rows without id. Rows that repeat an id, or an
    id and a vector, are rows of their own: each is a candidate for the others, and each is asked if its id is a query's. Components missing from a shorter vector count
    as 0, so an empty vector scores 0. Scores are 64-bit integers; other columns are ignored, whatever their names. No queries or no rows give no result.
    """
    chosen = vectors.select(field(id_col).cast("long").alias("vec_id"), field(vector_col).alias("v"))
    rows = chosen.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).select("vec_id", quantise(F.col("v")).alias("v"))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "search-rows")
    n, queries = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    if not queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    spread = min(math.ceil(n / LEAST_BLOCK), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = max(1, math.ceil(n / MOST_BLOCK), spread)
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    there = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"), "row", "vec_id", "v")
    asked = rows.filter(F.col("vec_id") % every == 0).select(each.alias("block"), F.lit(1).alias("side"), "row", "vec_id", "v")
    dealt = there.union(asked).repartition(blocks, "block").sortWithinPartitions("block", "side", "vec_id", "row")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _searched(batches, k)

    found = dealt.mapInPandas(search, _FOUND)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searched(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The k best rows of each block for the queries that follow them, block after block."""
    parts, block, here = [], None, None
    for batch in batches:
        keys = batch["block"].to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:], strict=False):
            if keys[a] != block:
                parts, block, here = [], keys[a], None
            some = batch.iloc[a:b]
            rows, asked = some[some["side"] == 0], some[some["side"] == 1]
            if len(rows):
                parts.append((_matrix(rows["v"]), rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)))
            if not len(asked) or not parts:
                continue
            here = here or _Block(parts)
            for start in range(0, len(asked), _TILE):
                yield here.best(asked.iloc[start : start + _TILE], k)


def _matrix(vectors, width: int = 0) -> np.ndarray:
    out = np.zeros((len(vectors), max(width, 1, *(len(v) for v in vectors))), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class _Block:
    """Rows as posting lists, by id."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.width = max(p[0].shape[1] for p in parts)
        rows = np.concatenate([np.pad(p[0], ((0, 0), (0, self.width - p[0].shape[1]))) for p in parts])
        self.ids, self.rows = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        self.most = np.abs(rows).max() if len(rows) else 0
        self.postings = []
        for term in range(self.width):
            at = np.flatnonzero(rows[:, term])
            whole = len(at) * _DENSE > len(rows)
            self.postings.append((slice(None), rows[:, term].copy()) if whole else (at, rows[at, term]))
        self.cast: dict = {}

    def best(self, asked: pd.DataFrame, k: int) -> pd.DataFrame:
        """Scores of all rows, term by term, and of them the k best for each query."""
        tile = _matrix(asked["v"])[:, : self.width]  # further components meet zeros
        most = float(self.most) * float(np.abs(tile).max(initial=0)) * self.width
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64  # exact in either case
        if kind not in self.cast:
            self.cast = {kind: [(at, values.astype(kind)) for at, values in self.postings]}
        scores = np.zeros((len(tile), len(self.ids)), dtype=kind)
        for term, (at, values) in enumerate(self.cast[kind][: tile.shape[1]]):
            asking = np.flatnonzero(tile[:, term])
            if len(asking) and len(values):
                part = np.multiply.outer(tile[asking, term].astype(kind), values)
                if not isinstance(at, slice):
                    scores[np.ix_(asking, at)] += part
                elif len(asking) == len(tile):
                    scores += part
                else:
                    scores[asking] += part
        names, query_ids, out = asked["row"].to_numpy(), asked["vec_id"].to_numpy(), []
        for line, name, query_id in zip(scores, names, query_ids, strict=True):
            keep = np.arange(len(line))
            own = np.flatnonzero(self.rows == name)
            if len(own):
                keep = np.delete(keep, own)
            if len(keep) > k:  # everything above the k-th score, then ties in order of id
                limit = np.partition(line[keep], len(keep) - k)[len(keep) - k]
                above, level = keep[line[keep] > limit], keep[line[keep] == limit]
                keep = np.concatenate([above, level[: k - len(above)]])
            out.append((np.full(len(keep), name), np.full(len(keep), query_id), self.ids[keep], self.rows[keep], line[keep].astype(np.int64)))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query", "query_id", "vec_id", "row", "score"), columns, strict=True)))
