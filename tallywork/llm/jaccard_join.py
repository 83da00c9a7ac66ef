"""N-gram Jaccard join by chosen paths: sets are split on sampled shared tokens until buckets are small.

A set of word shingles samples its tokens by minima under random hash functions, so two sets sample the same
token with a chance equal to their Jaccard similarity. One run splits all sets by one sampled token,
splits buckets that are too large by a further one, and compares what is left in a bucket. Runs are
repeated with other hash functions until a pair at the threshold is met with the wanted recall.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field, free_names
from tallywork.llm.components import components
from tallywork.sources.scratch import materialize

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
RECALL = 0.999  # chance, at least, that a pair exactly at the threshold shares a bucket
DEPTH = 3  # sampled tokens on the longest path
SMALL = 64  # sets in a bucket that is not split further
BLOCK = 256  # sets of a bucket compared together; larger buckets compare block by block
HASHES = 64
_SLACK = 4.4  # standard deviations below the threshold at which a sketch rules a pair out
_CACHED_WORDS = 200_000
_ROWS = 1 << 14  # shingles hashed together
_CODES = 1 << 12  # columns of the comparison matrix held together

_WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(20)
_MULTIPLY = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)

_SETS = "row_key long, doc_id string, set_id string, size int, sketch array<int>"
_GROUPED = "key long, run int, side int, set_id string, size int, n_docs long, leaves array<long>"


def runs_for(recall: float = RECALL, depth: int = DEPTH, threshold: Fraction = THRESHOLD) -> int:
    """Runs after which a pair at the threshold was met at least once, if every path goes to the full depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - float(threshold) ** depth))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of near copies: (doc_id, class_id, n_links, row_key, class_key), one row for each row of ``docs``.

    Two texts are linked when the Jaccard similarity of their sets of five-word shingles is at least
    0.8; words are lower-cased runs of word characters, and a text of one to four words is one shingle. ``n_links``
    counts the other rows a row is linked to, copies included; a class is a connected component of
    links, named by its least doc_id. ``row_key`` is a hash of id and text; ``class_key`` tells classes
    apart even where ids repeat, and is NULL for a row that is a class of its own for want of words.

    Rows of equal sets are one set with a count from the start, so copies are never paired. Buckets of
    over 256 sets are compared block against block in tasks of their own; a pair that meets in several runs
    counts in the first. Sketches rule out pairs far below the threshold, what is left is compared by whole sets; only
    links per set and a star per bucket leave a task, never all pairs of a group. Recall at the threshold is 0.999,
    above it higher; no pair below it is ever linked.

    Texts without words (NULL, empty) link to nothing and are their own class; rows without id take part
    and a class of such rows only has no name; repeated rows are linked copies; an empty table gives no rows; other columns are
    ignored.
    """
    chosen = docs.select(
        field(id_col).cast("long").alias("doc_id"), F.coalesce(field(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    members = chosen.select("row_key", F.col("doc_id").cast("string"), "text").mapInPandas(_sketches, _SETS)
    members = materialize(members.withColumn("doc_id", F.col("doc_id").cast("long")), "join-members")
    sets = materialize(
        members.filter("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.max("size").alias("size"), F.min("sketch").alias("sketch")),
        "join-sets",
    )
    leaves = materialize(_leaves(sets), "join-leaves")
    met = materialize(_buckets(leaves, sets).mapInPandas(_candidates, _GROUPED), "join-candidates")
    links = materialize(_compared(met, sets, chosen), "join-links")

    roots = components(links, "set_id", "other")
    degree = links.groupBy("set_id").agg(F.sum("links").alias("links"))
    linked = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").join(degree, "set_id", "left")
    linked = linked.filter("n_docs > 1 OR links IS NOT NULL").select(
        "set_id", F.coalesce("root", "set_id").alias("root"), "least", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")
    )
    linked = materialize(linked, "join-linked")
    named = linked.groupBy("root").agg(F.min("least").alias("class_id"))
    known = linked.join(named, "root").select(F.col("set_id").alias("_set"), "root", "class_id", "n_links")
    return members.join(known, F.col("set_id") == F.col("_set"), "left").select(
        "doc_id",
        F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "row_key",
        F.coalesce("root", "set_id").alias("class_key"),
    )


def first_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when of every class only the row of least id does.

    Rows without words all stay; rows equal in id and text count as one. Rows without id stand behind those with one.
    """
    found = near_copies(docs, id_col, text_col)
    of_class = F.coalesce("class_key", F.col("row_key").cast("string"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    (key,) = free_names(docs, "row_key")
    keep = found.groupBy(of_class.alias("class")).agg(least.alias("kept")).select(F.col("kept.row_key").alias(key)).distinct()
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.xxhash64(field(id_col).cast("long"), text))
    return keyed.join(keep, key, "left_semi").dropDuplicates([key]).select(*[field(c) for c in docs.columns])


def _leaves(sets: DataFrame) -> DataFrame:
    """(set_id, run, leaf, n): buckets of at least two sets, after splitting those over SMALL again."""
    runs = runs_for()
    tokens = [F.element_at("sketch", F.col("run") * DEPTH + (level + 1)).alias(f"t{level}") for level in range(DEPTH)]
    live = sets.select("set_id", "sketch", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")).select("set_id", "run", *tokens)
    live = live.withColumn("leaf", F.xxhash64("run", "t0"))
    done = []
    for level in range(DEPTH):
        # stored and merged, so that both sides of the join are plain shuffles, whose large keys Spark can split
        counts = materialize(live.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "join-leaf-sizes")
        held = live.join(counts.hint("merge"), "leaf")
        if level < DEPTH - 1:
            held = materialize(held, "join-paths")
            done.append(held.filter(F.col("n") <= SMALL))
            live = held.filter(F.col("n") > SMALL).withColumn("leaf", F.xxhash64("leaf", f"t{level + 1}")).drop("n")
        else:
            done.append(held)
    return reduce(DataFrame.union, [d.select("set_id", "run", "leaf", "n") for d in done])


def _buckets(leaves: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of every bucket with their sketches, dealt by bucket, or by pair of blocks in a large one."""
    paths = leaves.groupBy("set_id").agg(F.collect_list(F.struct("run", "leaf", "n")).alias("paths"))  # a row per run at most
    known = F.map_from_entries(F.transform("paths", lambda p: F.struct(p.run, p.leaf)))
    all_leaves = F.transform(F.sequence(F.lit(0), F.lit(runs_for() - 1)), lambda r: F.coalesce(F.try_element_at(known, r), F.lit(0).cast("long")))
    rows = sets.join(paths, "set_id").withColumn("leaves", all_leaves)
    rows = rows.select("set_id", "size", "n_docs", "sketch", "leaves", F.inline("paths"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit(1)), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = F.xxhash64("leaf", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return rows.select(key.alias("key"), "run", side.alias("side"), "set_id", "size", "n_docs", "leaves", "sketch").repartition("key").sortWithinPartitions("key")


def _compared(met: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(set_id, other, links): per set and bucket, its links' rows and the least set of its component there."""
    needed = sets.join(met.select("set_id").distinct(), "set_id", "left_semi").select("row_key").distinct()
    rows = texts.select("row_key", "text").join(needed, "row_key", "left_semi").select("text")
    shingles = rows.mapInPandas(_whole_sets, "set_id string, shingles binary").dropDuplicates(["set_id"])
    dealt = met.join(shingles, "set_id").repartition("key").sortWithinPartitions("key")
    return dealt.mapInPandas(_links, "set_id string, other string, links long")


class _Words(dict):
    """Word -> hash; forgets all words when it has grown to its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array([words[w] for w in found], dtype=np.uint64)
    n = max(1, len(hashes) - SHINGLE + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(hashes))):
        rolled = (rolled ^ hashes[i : i + n]) * _MIX
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def set_name(shingles: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _ROWS):
        part = shingles[at : at + _ROWS, None] * _MULTIPLY
        part += _ADD
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        names, sizes, sketches = [], [], []
        for text in batch["text"]:
            shingles = shingle_set(text, words)
            names.append(set_name(shingles) if len(shingles) else None)
            sizes.append(len(shingles))
            sketches.append(sketch(shingles) if len(shingles) else None)
        yield pd.DataFrame({"row_key": batch["row_key"], "doc_id": batch["doc_id"], "set_id": names, "size": sizes, "sketch": sketches})


def _whole_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        sets = [shingle_set(t, words) for t in batch["text"]]
        sets = [s for s in sets if len(s)]
        yield pd.DataFrame({"set_id": [set_name(s) for s in sets], "shingles": [s.tobytes() for s in sets]})


def _groups(batches: Iterator[pd.DataFrame], work: Callable[[pd.DataFrame], pd.DataFrame | None]) -> Iterator[pd.DataFrame]:
    """Apply ``work`` to the rows of each key of batches sorted by key; the last key waits for the next batch."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        keys = batch["key"].to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        rest = batch.iloc[edges[-1] :]
        done = [work(batch.iloc[a:b]) for a, b in zip(edges, edges[1:], strict=False) if b - a > 1]
        done = [d for d in done if d is not None]
        if done:
            yield pd.concat(done, ignore_index=True)
    if rest is not None and len(rest) > 1 and (done := work(rest)) is not None:
        yield done


def _pairs_here(group: pd.DataFrame) -> np.ndarray:
    """Which pairs (upper triangle) belong to this group: blocks that face each other, first met in this run."""
    side = group["side"].to_numpy()
    mine = np.triu(np.ones((len(group), len(group)), bool), 1)
    if side.any():
        mine &= side[:, None] != side[None, :]
    run = int(group["run"].iloc[0])
    if run:
        leaves = np.stack(group["leaves"].to_list())[:, :run]
        for r in range(run):
            mine &= ~((leaves[:, None, r] == leaves[None, :, r]) & (leaves[:, r] != 0)[:, None])
    return mine


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    t = float(THRESHOLD)
    agree = math.ceil(HASHES * (t - _SLACK * math.sqrt(t * (1 - t) / HASHES)))

    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        mine, sizes = _pairs_here(group), group["size"].to_numpy(np.int64)
        small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
        mine &= small * THRESHOLD.denominator >= large * THRESHOLD.numerator
        if not mine.any():
            return None
        sketches = np.stack(group["sketch"].to_list())
        same = np.zeros(mine.shape, np.int32)
        for column in sketches.T:
            same += column[:, None] == column[None, :]
        mine &= same >= agree
        part = (mine | mine.T).any(axis=1)
        return group.loc[part].drop(columns="sketch") if part.any() else None

    return _groups(batches, work)


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        mine, sizes = _pairs_here(group), group["size"].to_numpy(np.int64)
        shared = shared_counts([np.frombuffer(b, np.uint64) for b in group["shingles"]])
        union = sizes[:, None] + sizes[None, :] - shared
        mine &= shared * THRESHOLD.denominator >= union * THRESHOLD.numerator
        linked = mine | mine.T
        any_link = linked.any(axis=1)
        if not any_link.any():
            return None
        names = group["set_id"].to_numpy()
        order = np.argsort(names)
        least = np.empty(len(names), np.int64)
        least[order] = np.arange(len(names))
        while True:  # the least set of the component within this group
            lower = np.minimum(least, np.where(linked, least[None, :], len(names)).min(axis=1))
            if (lower == least).all():
                break
            least = lower
        return pd.DataFrame({"set_id": names[any_link], "other": names[order[least]][any_link], "links": (linked @ group["n_docs"].to_numpy(np.int64))[any_link]})

    return _groups(batches, work)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, over columns of a few thousand shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, codes, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1  # others are in no intersection
    column = np.cumsum(often) - 1
    here = often[codes]
    owner, codes = owner[here], column[codes[here]]
    shared = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    for start in range(0, int(often.sum()), _CODES):
        a, b = np.searchsorted(codes, [start, start + _CODES])
        held = np.zeros((len(sets), _CODES), np.float32)
        held[owner[a:b], codes[a:b] - start] = 1
        shared += np.rint(held @ held.T).astype(np.int64)
    return shared
