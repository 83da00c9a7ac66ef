"""Approximate nearest neighbours: a forest of random-projection trees and one queue of leaves for all of them.

All nodes of one level of a tree project on the same random direction and split at the median. A query
walks all trees with one priority queue, nearest cells first. The rows of the leaves it takes are
compared exactly. How many leaves it takes is measured: by brute force for a bounded sample of queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field
from tallywork.sources.scratch import materialize

TREES = 8
LEAF = 1024  # rows in a leaf, about
MOST_LEVELS = 13
FIT_ROWS = 1 << 16  # vectors, at most and by hash, whose projections fix the medians; every vector is indexed
ASKED = 128  # sampled queries, by hash, for which brute force measures the search
RECALL = 0.95  # of the sampled queries' neighbours, at least
FIRST = TREES  # leaves after which a query has a bound
BLOCK = 4096  # rows of a leaf that meet in one task; larger leaves are dealt over several
_STREAM = 512  # queries compared with a block at once
_SEED = 11

_PLACED = "row long, least long, v array<double>, leaves array<int>"
_TASK = ["tree", "leaf", "part"]
_FOUND = "query long, row long, least long, score double"


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k rows of largest inner product found for each query: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's own,
    so a repeated id is a candidate for the other rows under it. Ties go to the smaller id. Scores are inner
    products of the original vectors in double precision, added from the first component to the last; a
    shorter vector counts as if filled with zeros. Vectors that are NULL, empty, all zeros or hold a NULL or
    non-finite component take no part, nor do rows without id; other columns are ignored, and no queries or a
    single row give no result.

    Equal vectors are one row of the index with the k + 1 least ids under it, so a vector that fills a third
    of the table is one row. Largest inner product becomes nearest neighbour by a further component that
    brings all rows to one length. Medians come from FIT_ROWS vectors at most; every vector is dealt to a leaf
    of every tree. Trees deepen until a leaf holds about LEAF rows; from 2 ** MOST_LEVELS * LEAF rows on leaves
    grow instead and are compared in blocks. A query takes as many leaves as reach ``recall`` for ASKED
    sampled queries, and more until one tree has given it over k rows.

    A task holds one block of a leaf and streams the queries that ask for it, so neither the number of rows nor
    of queries is bounded by a task's memory. Trees, leaf sizes and the sampled queries are of fixed size.
    """
    chosen = vectors.select(field(id_col).cast("long").alias("vec_id"), field(vector_col).cast("array<double>").alias("v"))
    plain = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    chosen = chosen.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(plain, F.lit(False)))
    chosen = materialize(chosen.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))), "forest-vectors")  # -0.0 becomes 0.0

    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = chosen.withColumn("_place", place).filter(F.col("_place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    row = F.monotonically_increasing_id()
    distinct = materialize(distinct.select(row.alias("row"), F.element_at("ids", 1).alias("least"), "ids", "v"), "forest-rows")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    top = F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x))))
    n, width, largest = distinct.agg(F.count(F.lit(1)), F.max(F.size("v")), top).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    longest = distinct.agg(F.max(length / F.lit(largest * largest))).first()[0] if largest * largest < math.inf else float(width)
    levels = min(MOST_LEVELS, max(0, math.ceil(math.log2(n / LEAF))))
    forest = _Forest(width, levels, largest, longest)

    asking = chosen.filter(F.col("vec_id") % every == 0)
    queries = materialize(asking.select("v").distinct().join(distinct.select("row", "least", "v"), "v").select("row", "least", "v"), "forest-queries")
    forest.fit(distinct, n)
    placed = materialize(distinct.select("row", "least", "v").mapInPandas(forest.place, _PLACED), "forest-leaves")
    forest.count(placed)
    visits = _measured(queries, placed, forest, k, recall)

    # the first leaves give every query a score that rows of the further ones must reach
    queries = queries.withColumn("bound", F.lit(float("-inf")))
    best = materialize(_kept(_searched(queries, placed, forest, visits, k, 0, FIRST), k), "forest-first")
    if visits > FIRST:
        reached = best.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(float("-inf")).alias("bound"))
        queries = queries.drop("bound").join(reached, F.col("row") == F.col("query")).drop("query")
        further = _searched(queries, placed, forest, visits, k, FIRST, None)
        best = materialize(_kept(best.union(further), k), "forest-best")
    each = best.join(distinct.select("row", "ids"), "row").select("query", F.explode("ids").alias("vec_id"), "score", (F.col("row") == F.col("query")).alias("same"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    each = each.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    lists = each.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "same"))).alias("found"))
    lists = lists.join(distinct.select(F.col("row").alias("query"), "v"), "query").select("v", "found")
    # one entry of the query's own id and vector is the query itself
    answers = asking.select(F.col("vec_id").alias("query_id"), "v").join(lists, "v")
    own = F.array_position(F.transform("found", lambda x: x.same & (x.vec_id == F.col("query_id"))), True)
    left = F.slice(F.filter("found", lambda x, i: i + 1 != F.col("own")), 1, k)
    answers = answers.withColumn("own", own).select("query_id", F.posexplode(left).alias("at", "entry"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), "entry.vec_id", "entry.score")


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best rows of each query, once where several trees found them."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "row")
    return found.withColumn("_place", F.dense_rank().over(order)).filter(F.col("_place") <= k + 1).drop("_place").distinct()


class _Forest:
    """Directions by seed, medians by level, and sizes of leaves: all of a size that the constants bound."""

    def __init__(self, width: int, levels: int, largest: float, longest: float):
        self.width, self.levels, self.largest, self.longest = width, levels, largest, longest
        self.leaves = 1 << levels
        self.medians = [np.zeros((TREES, 1 << level)) for level in range(levels)]
        self.sizes = np.zeros((TREES, self.leaves), np.int64)

    def directions(self) -> np.ndarray:
        """(TREES, width + 1, levels): orthogonal inside a tree where the width allows."""
        out = np.empty((TREES, self.width + 1, self.levels))
        for tree in range(TREES):
            drawn = np.random.default_rng([_SEED, tree]).normal(size=(self.width + 1, self.levels))
            out[tree] = np.linalg.qr(drawn)[0] if 0 < self.levels <= self.width + 1 else drawn
        return out

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of largest component 1 with the component that brings all to one length."""
        scaled = vectors / self.largest
        missing = np.sqrt(np.maximum(0, self.longest - (scaled * scaled).sum(axis=1)))
        return np.hstack([scaled, missing[:, None]])

    def fit(self, rows: DataFrame, n: int) -> None:
        """Medians of the sampled rows' projections, one task for each tree."""
        if not self.levels:
            return
        share = min(1.0, 0.95 * FIT_ROWS / n)
        sample = rows if n <= FIT_ROWS else rows.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20)))
        levels, forest = self.levels, self

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ways = forest.directions()
            for batch in batches:
                lifted = forest.lift(matrix(batch["v"], forest.width))
                for tree in range(TREES):
                    yield pd.DataFrame({"tree": tree, "p": list(lifted @ ways[tree])})

        def split(of_tree: pd.DataFrame) -> pd.DataFrame:
            p = np.stack(of_tree["p"].to_list())
            nodes, out = np.zeros(len(p), np.int64), []
            for level in range(levels):
                medians = np.zeros(1 << level)
                order = np.lexsort((p[:, level], nodes))
                edges = np.searchsorted(nodes[order], np.arange((1 << level) + 1))
                for node, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    if b > a:
                        medians[node] = p[order[a + (b - a - 1) // 2], level]
                out.append(medians)
                nodes = 2 * nodes + (p[:, level] > medians[nodes])
            return pd.DataFrame({"tree": of_tree["tree"][:1], "medians": [np.concatenate(out)]})

        projected = sample.select("v").mapInPandas(project, "tree int, p array<double>")
        for tree, medians in projected.groupBy("tree").applyInPandas(split, "tree int, medians array<double>").collect():  # TREES rows
            for level in range(levels):
                self.medians[level][tree] = medians[(1 << level) - 1 : (2 << level) - 1]

    def place(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows with their leaf in every tree."""
        ways = self.directions()
        for batch in batches:
            lifted = self.lift(matrix(batch["v"], self.width))
            leaves = np.zeros((len(batch), TREES), np.int32)
            for tree in range(TREES):
                p = lifted @ ways[tree]
                for level in range(self.levels):
                    leaves[:, tree] = 2 * leaves[:, tree] + (p[:, level] > self.medians[level][tree][leaves[:, tree]])
            yield batch[["row", "least", "v"]].assign(leaves=list(leaves))

    def count(self, placed: DataFrame) -> None:
        each = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
        for tree, leaf, n in each.collect():  # one row for each leaf
            self.sizes[tree, leaf] = n

    def walk(self, projected: np.ndarray) -> Iterator[tuple[int, int]]:
        """Leaves of all trees from one queue, the cell least far from the query first.

        ``projected`` holds the query on every direction, by tree. A cell is as far as the margins by which
        the query lies on the other side of its splits.
        """
        queue = [(0.0, tree, 0, 0) for tree in range(TREES)]
        while queue:
            far, tree, level, node = heapq.heappop(queue)
            while level < self.levels:
                margin = projected[tree, level] - self.medians[level][tree, node]
                near = int(margin > 0)
                heapq.heappush(queue, (far + margin * margin, tree, level + 1, 2 * node + 1 - near))
                level, node = level + 1, 2 * node + near
            yield tree, node

    def asked(self, projected: np.ndarray, visits: int, k: int) -> list[tuple[int, int]]:
        """The first ``visits`` leaves, and further ones until a tree has given over ``k`` rows."""
        out, given = [], np.zeros(TREES, np.int64)
        for tree, leaf in self.walk(projected):
            if len(out) >= visits and given.max() > k:
                break
            if self.sizes[tree, leaf]:
                out.append((tree, leaf))
                given[tree] += self.sizes[tree, leaf]
        return out

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """(queries, TREES, levels); a query's further component is zero."""
        flat = np.hstack([vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 5e-324), np.zeros((len(vectors), 1))])
        flat *= math.sqrt(self.longest) / np.sqrt((flat * flat).sum(axis=1, keepdims=True))
        return np.einsum("qw,twl->qtl", flat, self.directions())


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added component by component from the first on."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def best_rows(asked: np.ndarray, there: np.ndarray, least: np.ndarray, rows: np.ndarray, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the ``keep`` best of the rows and their scores, ties to the least id, then the least row."""
    rough = asked @ there.T
    reach = 1e-12 * there.shape[1] * (np.abs(asked) @ np.abs(there).T)  # more than the order of adding can change
    for q in range(len(asked)):
        near = np.arange(len(rows))
        if len(near) > keep:
            limit = np.partition(rough[q] - reach[q], len(near) - keep)[len(near) - keep]
            near = np.flatnonzero(rough[q] + reach[q] >= limit)
        score = inner(np.broadcast_to(asked[q], (len(near), asked.shape[1])), there[near])
        order = np.lexsort((rows[near], least[near], -score))[:keep]
        yield q, near[order], score[order]


def _searched(queries: DataFrame, placed: DataFrame, forest: _Forest, visits: int, k: int, start: int, stop: int | None) -> DataFrame:
    """(query, row, least, score): per query and leaf, of the leaves it takes from ``start`` to ``stop``, the k + 1 best rows that reach its bound."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), _STREAM):
                some = batch.iloc[begin : begin + _STREAM]
                projected = forest.project(matrix(some["v"], forest.width))
                taken = [forest.asked(p, visits, k)[start:stop] for p in projected]
                at = np.repeat(np.arange(len(some)), [len(t) for t in taken])
                where = np.array([x for t in taken for x in t], np.int32).reshape(-1, 2)
                parts = np.maximum(1, -(-forest.sizes[where[:, 0], where[:, 1]] // BLOCK))
                again = np.repeat(np.arange(len(at)), parts)
                part = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                yield some.iloc[at[again]].assign(tree=where[again, 0], leaf=where[again, 1], part=part.astype(np.int32), side=np.int32(1))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaves = np.stack(batch["leaves"].to_list())
            for tree in range(TREES):
                leaf = leaves[:, tree].astype(np.int32)
                parts = np.maximum(1, -(-forest.sizes[tree, leaf] // BLOCK))
                mixed = (batch["row"].to_numpy(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                part = (mixed.astype(np.int64) % parts).astype(np.int32)
                yield batch[["row", "least", "v"]].assign(bound=0.0, tree=np.int32(tree), leaf=leaf, part=part, side=np.int32(0))

    shape = "row long, least long, v array<double>, bound double, tree int, leaf int, part int, side int"
    sent = placed.mapInPandas(deal, shape).union(queries.mapInPandas(route, shape))
    dealt = sent.repartition(*_TASK).sortWithinPartitions(*_TASK, "side")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, task = [], None
        for batch in batches:
            keys = batch[_TASK].to_numpy()
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:], strict=False):
                here, now = batch.iloc[a:b], tuple(keys[a])
                if now != task:
                    held, task = [], now
                rows, asked = here[here["side"] == 0], here[here["side"] == 1]
                if len(rows):
                    held.append((matrix(rows["v"], forest.width), rows["least"].to_numpy(), rows["row"].to_numpy()))
                if not len(asked) or not held:
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(x) for x in zip(*held, strict=True))]
                there, least, ids = held[0]
                for begin in range(0, len(asked), _STREAM):
                    some = asked.iloc[begin : begin + _STREAM]
                    names, bounds, out = some["row"].to_numpy(), some["bound"].to_numpy(), []
                    for q, best, score in best_rows(matrix(some["v"], forest.width), there, least, ids, k + 1):
                        best, score = best[score >= bounds[q]], score[score >= bounds[q]]
                        out.append((np.full(len(best), names[q]), ids[best], least[best], score))
                    yield pd.DataFrame(dict(zip(("query", "row", "least", "score"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    return dealt.mapInPandas(compare, _FOUND)


def _measured(queries: DataFrame, placed: DataFrame, forest: _Forest, k: int, recall: float) -> int:
    """Leaves to take: the fewest that hold ``recall`` of the nearest rows of the sampled queries."""
    if not forest.levels:
        return 1  # the one leaf holds all rows
    sample = queries.orderBy(F.xxhash64("row", F.lit(_SEED)), "row").limit(ASKED).collect()
    asked, names = matrix([r["v"] for r in sample], forest.width), np.array([r["row"] for r in sample])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            there, ids = matrix(batch["v"], forest.width), batch["row"].to_numpy()
            for q, at, score in best_rows(asked, there, batch["least"].to_numpy(), ids, k + 1):
                yield pd.DataFrame({"query": q, "row": ids[at], "leaves": batch["leaves"].iloc[at].to_numpy(), "score": score})

    found = placed.mapInPandas(exact, "query int, row long, leaves array<int>, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "row"))
    true = found.withColumn("_place", place).filter(F.col("_place") <= k + 1).collect()  # ASKED * (k + 1) rows
    wanted: list[list[np.ndarray]] = [[] for _ in sample]
    for r in true:
        if r["row"] != names[r["query"]]:
            wanted[r["query"]].append(np.array(r["leaves"]))
    needed = []
    for projected, leaves in zip(forest.project(asked), wanted, strict=True):
        order = np.full((TREES, forest.leaves), TREES * forest.leaves)
        visit = 0
        for tree, leaf in forest.walk(projected):  # empty leaves are not taken, so they do not count
            if forest.sizes[tree, leaf]:
                order[tree, leaf] = visit
                visit += 1
        needed += [int(order[np.arange(TREES), at].min()) + 1 for at in leaves]
    needed.sort()
    return needed[min(len(needed), math.ceil(recall * len(needed))) - 1] if needed else 1
