"""Line dedup: an exact set-similarity join of lines by their words, after which later matches go.

The words of a line are ordered from the rarest to the commonest. Two lines of Jaccard similarity t or
more share a word among the first few of that order (the prefix), so lines meet only at prefix words;
their lengths, the places of the shared word and a mark of all words rule out most meetings, and whole
word sets decide the rest. A mark holds, per bit, whether an odd number of the words falls on it, so two
marks differ in no more bits than the sets differ in words, and long lines do not fill it.

Word sets are not stored: the texts are cut into words again wherever the words are needed.
"""

from __future__ import annotations

import functools
import itertools
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field, free_names
from tallywork.sources.scratch import materialize

NUM, DEN = 4, 5  # similarity at which a line matches
COUNTERS = 1 << 21  # word counters; words that share one rank together, which costs time only
BLOCK = 1 << 14  # uses of a word beyond which lines meet block by block
MOST_AT_ONCE = 16  # candidates of a line and word that the first round keeps; the closest of a line is verified first
BROADCAST_SETS = 2_000_000  # set names a broadcast may hold; more are joined by shuffle
_CACHED = 200_000
_TEXT = 1 << 19  # bytes of text cut into words together
_SETS = 1 << 16  # sets whose words are put in order together
_PART = 1 << 12  # counters packed in one row
_HELD = 1 << 21  # candidates a task gathers before it drops all but the closest

_WORD = r"[\pL\pN_]"
_LONG_LINE = 90  # words from which a line's mark has 128 bits
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse among the 64-bit numbers
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = (1 << 63) - 1  # stands for a NULL id: after all others

_LINES = "doc_key long, doc_id long, line int, n_lines int, set_id long, part int, uses binary"
_WORDS = "set_id long, words binary"
# shape packs a line's size, the word's place in it and the side of a pair of blocks, and sorts by size
_ENTRIES = "key long, shape long, set_id long, mark long, mark2 long, doc long, line int"
_FOUND = "late long, early long, far int, more boolean, key long"


def later_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to remove: (doc_id, doc_key, n_lines, removed), one row per document, ``removed`` counting lines from 1.

    A line's words are the distinct lower-cased runs of letters, digits and low lines. A line goes when an earlier one, in the order
    of doc_id, line and (where these are equal) text, has a word set of Jaccard similarity 0.8 or more, whether or not that one goes
    itself. Lines without words never match. ``doc_key`` is a hash of id and text: rows equal in both are one
    document; documents without id come last. NULL and empty texts are one line without words; an empty
    table gives no rows; other columns are ignored. Words are told apart by 32-bit hashes.

    Equal lines are one set. No group of lines is ever expanded into all its pairs: a task keeps, per
    line and word, the closest earlier candidates, the closest of a line is verified, then the others kept, and only lines that
    this does not settle and that had more see all of theirs in a second round. Words in very many lines are met block by block.
    ``docs`` is read several times: a table that is dear to compute, or not the same each time, has to be stored first.
    """
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(field(id_col).cast("long"), text).alias("doc_key"), field(id_col).cast("long").alias("doc_id"), text.alias("text"))
    stored = materialize(rows.mapInArrow(_lines, _LINES), "line-sets")
    lines = stored.filter("part IS NULL").drop("part", "uses")
    counters = _counters(stored.filter("part IS NOT NULL").select("part", "uses"))
    found = materialize(_met(rows, counters).mapInPandas(_closest(MOST_AT_ONCE), _FOUND), "line-candidates")
    closest = F.min(F.struct("far", "early")).alias("closest")
    best = found.groupBy("late").agg(closest, F.max("more").alias("more"), (F.min("early") != F.max("early")).alias("several"))
    best = materialize(best.select("late", "closest.early", "more", "several"), "line-closest")
    matched = materialize(_verified(best, lines, rows), "line-matches")
    unsettled = best.filter("more OR several").join(matched, "late", "left_anti")
    unsettled = materialize(unsettled, "line-open")
    if not unsettled.isEmpty():  # their other candidates of the first round
        others = found.join(unsettled.select("late", F.col("early").alias("_early")), "late").filter("early != _early")
        matched = materialize(matched.union(_verified(others, lines, rows)), "line-matches")
        unsettled = materialize(unsettled.filter("more").join(matched, "late", "left_anti"), "line-open")
    if not unsettled.isEmpty():  # candidates that the first round did not keep
        asking = unsettled.select(F.col("late").alias("set_id"))
        keys = materialize(found.filter("more").join(unsettled, "late", "left_semi").select("key").distinct(), "line-open-keys")
        near = _entries(rows, counters).join(_bounded(keys), "key", "left_semi")
        near = near.join(asking.withColumn("_asks", F.lit(True)), "set_id", "left").withColumn("asks", F.col("_asks").isNotNull()).drop("_asks")
        near = near.repartition("key").sortWithinPartitions(*_ORDER)
        rest = materialize(near.mapInPandas(_closest(None), _FOUND), "line-candidates")
        matched = matched.union(_verified(rest, lines, rows))

    first = F.min(F.struct("doc", "line", "doc_key")).alias("first")
    slim = lines.withColumn("doc", F.coalesce("doc_id", F.lit(_LAST)))
    sets = slim.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.count(F.lit(1)).alias("n"), first)
    gone = matched.select(F.col("late").alias("set_id"), F.lit(True).alias("gone")).distinct()
    known = sets.join(gone, "set_id", "left").filter("n > 1 OR gone").select(F.col("set_id").alias("_set"), "first", F.coalesce("gone", F.lit(False)).alias("gone"))
    late = F.col("gone") | (F.struct("doc", "line", "doc_key") != F.col("first"))
    marked = slim.join(known, F.col("set_id") == F.col("_set"), "left").withColumn("late", F.coalesce(late, F.lit(False)))
    return marked.groupBy("doc_id", "doc_key").agg(
        F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set(F.when(F.col("late"), F.col("line")))).alias("removed")
    )


def without_later_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of :func:`later_matches` taken out of the text."""
    key, gone = free_names(docs, "doc_key", "removed")
    found = later_matches(docs, id_col, text_col).filter(F.size("removed") > 0).select(F.col("doc_key").alias(key), F.col("removed").alias(gone))
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    keyed = docs.join(found.dropDuplicates([key]), F.xxhash64(field(id_col).cast("long"), text) == F.col(key), "left")
    kept = F.filter(F.split(text, "\n"), lambda _line, i: ~F.array_contains(F.col(gone), i + 1))
    cleaned = F.when(F.col(gone).isNull(), field(text_col)).otherwise(F.array_join(kept, "\n"))
    return keyed.withColumn(text_col, cleaned).select(*[field(c) for c in docs.columns])


class _Sets(NamedTuple):
    """Word sets of the lines of some documents, in order."""

    doc: np.ndarray  # place of the line's document among them
    line: np.ndarray
    set_id: np.ndarray
    size: np.ndarray
    words: np.ndarray  # of all sets, one after the other
    n_lines: np.ndarray  # of every document

    def pick(self, keep: np.ndarray) -> _Sets:
        return _Sets(self.doc[keep], self.line[keep], self.set_id[keep], self.size[keep], self.words[np.repeat(keep, self.size)], self.n_lines)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Sets]]:
    """Documents, so many that their texts hold about ``_TEXT`` bytes, and their word sets."""
    for batch in batches:
        part = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64) // _TEXT
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for start, end in itertools.pairwise(cuts):
            if start < end:
                piece = batch.slice(start, end - start)
                yield piece, _word_sets(piece["text"].to_pylist())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * _MIX
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


@functools.cache
def _values(bits: int) -> np.ndarray:
    """A number per code point below 2 ** bits: that of its lower-case form, 0 if this is no part of a word."""
    points = np.array([c for c in range(min(1 << bits, sys.maxunicode + 1)) if not 0xD800 <= c < 0xE000])
    lower = pc.utf8_lower(pa.array(map(chr, points.tolist())))
    inside = pc.match_substring_regex(lower, _WORD).to_numpy(zero_copy_only=False)
    out = np.zeros(points[-1] + 1, np.uint64)
    out[points] = np.where(inside, _mixed(np.array([ord(c) for c in lower.to_pylist()], np.uint64)) | np.uint64(1), np.uint64(0))
    return out


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """2 ** bits powers of the base and of its inverse."""
    bases = (_BASE, pow(_BASE, -1, 1 << 64))
    return tuple(np.cumprod(np.append(np.uint64(1), np.full((1 << bits) - 1, base, np.uint64))) for base in bases)


def _word_sets(texts: list[str]) -> _Sets:
    """The lines with words; all texts are handled together, as one row of code points."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    chars = np.fromiter(map(len, texts), np.int64, len(texts))
    breaks = np.flatnonzero(points == 10)
    first_line = np.searchsorted(breaks, np.cumsum(chars + 1) - chars - 1)
    n_lines = np.diff(np.append(first_line, len(breaks) + 1))
    values = _values(int(points.max(initial=0)).bit_length())[points]
    inside = values != 0
    starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return _Sets(none, none, none, none, np.zeros(0, np.uint32), n_lines)
    power, inverse = _powers(len(points).bit_length())
    named = _mixed(np.add.reduceat(values * power[: len(values)], starts) * inverse[starts]) >> np.uint64(32)
    of_line = np.repeat(np.arange(len(breaks) + 1, dtype=np.uint64), np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts)))
    pairs = np.sort((of_line << np.uint64(32)) | named)
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    owner, words = (pairs >> np.uint64(32)).astype(np.int64), pairs & np.uint64(0xFFFFFFFF)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    line, size = owner[starts], np.diff(np.append(starts, len(owner)))
    set_id = np.add.reduceat(_mixed(words), starts).view(np.int64)
    doc = np.searchsorted(first_line, line, "right") - 1
    return _Sets(doc, line - first_line[doc] + 1, set_id, size, words.astype(np.uint32), n_lines)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line with words, and one for a document without any; then the task's counters of words, ``_PART`` a row.

    A task counts a set once, however often its line repeats (again only when it has met ``_CACHED`` others since), so a
    line that fills the table does not make its words look common.
    """
    schema = pa.schema([("doc_key", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32()), ("n_lines", pa.int32()), ("set_id", pa.int64()), ("part", pa.int32()), ("uses", pa.binary())])
    total, seen = np.zeros(COUNTERS, np.int64), set()
    for docs, sets in _pieces(batches):
        total += np.bincount(sets.pick(_unseen(sets, seen)).words % COUNTERS, minlength=COUNTERS)
        bare = np.setdiff1d(np.arange(len(docs)), sets.doc)
        rows, none = np.concatenate([sets.doc, bare]), len(bare)
        line = np.concatenate([sets.line, np.zeros(none, np.int64)]).astype(np.int32)
        set_id = pa.concat_arrays([pa.array(sets.set_id), pa.nulls(none, pa.int64())])
        named = [docs["doc_key"].take(pa.array(rows)), docs["doc_id"].take(pa.array(rows)), pa.array(line), pa.array(sets.n_lines[rows].astype(np.int32)), set_id]
        yield pa.RecordBatch.from_arrays([*named, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], schema=schema)
    for part, block in enumerate(np.split(total, COUNTERS // _PART)):
        if block.any():
            yield pa.RecordBatch.from_pylist([{"part": part, "uses": block.astype("<i8").tobytes()}], schema=schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every set with its words; a task repeats a set only when it has met ``_CACHED`` others since."""
    seen: set[int] = set()
    for _docs, sets in _pieces(batches):
        sets = sets.pick(_unseen(sets, seen))
        offsets = np.append(0, np.cumsum(sets.size)).astype(np.int32) * 4
        words = pa.Array.from_buffers(pa.binary(), len(sets.size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(sets.words.astype("<u4").tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(sets.set_id), words], names=["set_id", "words"])


def _unseen(sets: _Sets, seen: set[int]) -> np.ndarray:
    """Which sets to take: those not in ``seen``, which then holds them, each once."""
    if len(seen) >= _CACHED:
        seen.clear()
    names, first = np.unique(sets.set_id, return_index=True)
    keep = np.zeros(len(sets.set_id), bool)
    keep[[i for i, name in zip(first.tolist(), names.tolist(), strict=True) if name not in seen]] = True
    seen.update(names.tolist())
    return keep


def _counters(counted: DataFrame) -> np.ndarray:
    """Sets that use every counter's words; the array has a fixed size."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, "<i8") for b in rows["uses"]], axis=0, dtype=np.int64)
        return pd.DataFrame({"part": rows["part"][:1], "uses": [total.astype("<i8").tobytes()]})

    out = np.zeros(COUNTERS, np.int64)
    for part, uses in counted.groupBy("part").applyInPandas(add, "part int, uses binary").collect():  # at most COUNTERS numbers, packed
        out[part * _PART : (part + 1) * _PART] = np.frombuffer(uses, "<i8")
    return out


_ORDER = ("key", "shape")
_SIZE, _PLACE = 34, 4  # bits below size and place in a shape


def _bounded(stored: DataFrame) -> DataFrame:
    """A broadcast of a stored table of numbers where a count allows it; else the join shuffles."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_SETS else stored


def _met(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """Every set at each of its prefix words, dealt by word and sorted by size."""
    return _entries(rows, counters).repartition("key").sortWithinPartitions(*_ORDER)


def _entries(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """Every set at each of its prefix words."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, seen = shared.value, {}
        for docs, sets in _pieces(batches):
            ids = docs["doc_id"].fill_null(_LAST).to_numpy()[sets.doc]
            keep = np.zeros(len(ids), bool)
            for i, (set_id, *order) in enumerate(zip(sets.set_id.tolist(), ids.tolist(), sets.line.tolist(), strict=True)):
                if set_id not in seen or order < seen[set_id]:  # again when a task meets an earlier line of the set
                    if len(seen) >= _CACHED:
                        seen.clear()
                    seen[set_id] = order
                    keep[i] = True
            sets, ids = sets.pick(keep), ids[keep]
            for at in range(0, len(ids), _SETS):
                some = np.zeros(len(ids), bool)
                some[at : at + _SETS] = True
                yield _prefixes(sets.pick(some), ids[some], uses)

    return rows.mapInArrow(entries, _ENTRIES)


def _prefixes(sets: _Sets, docs: np.ndarray, uses: np.ndarray) -> pa.RecordBatch:
    """At most ``_SETS`` sets at each of their prefix words."""
    size, words = sets.size, sets.words.astype(np.uint64)
    starts = np.cumsum(size) - size
    bits = (words * _MIX) >> np.uint64(57)
    bit = np.uint64(1) << (bits & np.uint64(63))
    mark, mark2 = (np.bitwise_xor.reduceat(np.where(bits >> np.uint64(6) == half, bit, np.uint64(0)), starts) if len(size) else bit for half in (0, 1))
    short = size < _LONG_LINE  # both halves in one
    mark, mark2 = np.where(short, mark ^ mark2, mark), np.where(short, np.uint64(0), mark2)
    # by set, uses (the leading bits as a float) and word
    rank = uses[words % np.uint64(COUNTERS)].astype(np.float32).view(np.uint32).astype(np.uint64) >> np.uint64(15)
    order = np.sort((np.repeat(np.arange(len(size), dtype=np.uint64), size) << np.uint64(48)) | (rank << np.uint64(32)) | words)
    prefix = size - (NUM * size + DEN - 1) // DEN + 1
    place = np.arange(prefix.sum()) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    owner = np.repeat(np.arange(len(size)), prefix)
    words = order[starts[owner] + place] & np.uint64(0xFFFFFFFF)
    used = uses[words % np.uint64(COUNTERS)]
    keep = used > 1  # a word used once is shared by no two lines
    words, used, place, owner = words[keep], used[keep], place[keep], owner[keep]
    # a word of many uses: blocks by set, each meeting every other
    blocks = np.maximum(1, -(-used // BLOCK))
    own = (((sets.set_id[owner].view(np.uint64) * _MIX) >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int64)
    times = np.repeat(np.arange(len(words)), blocks)
    other = np.arange(len(times)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    alone = blocks[times] == 1
    own, words, place, owner = own[times], words[times], place[times], owner[times]
    low, high = np.minimum(own, other).astype(np.uint64), np.maximum(own, other).astype(np.uint64)
    key = ((words * _MIX) ^ (low * np.uint64(0xC2B2AE3D27D4EB4F))) * _MIX ^ (high * np.uint64(0x165667B19E3779F9))
    key = np.where(alone, words, key | np.uint64(1 << 63))  # a word itself is a small number, which takes little room
    shape = (size[owner] << _SIZE) | (place << _PLACE) | (np.sign(other - own) + 1)
    columns = [key.view(np.int64), shape, sets.set_id[owner], mark[owner].view(np.int64), mark2[owner].view(np.int64), docs[owner], sets.line[owner].astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "shape", "set_id", "mark", "mark2", "doc", "line"])


def _closest(most: int | None):
    """Per later line and word the ``most`` closest earlier candidates, or all for lines that ask."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            keys = batch["key"].to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            rest = batch.iloc[last:]
            if last:
                yield from _candidates(batch.iloc[:last], most)
        if rest is not None:
            yield from _candidates(rest, most)

    return work


def _candidates(rows: pd.DataFrame, most: int | None) -> Iterator[pd.DataFrame]:
    # of a set's rows at a word the earliest comes first and stays
    rows = rows.iloc[np.lexsort([rows[c].to_numpy() for c in ("line", "doc", "set_id", "shape", "key")])]
    key, ids = rows["key"].to_numpy(), rows["set_id"].to_numpy()
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
    rows = rows[fresh]
    key, shape, ids, mark, mark2 = (rows[c].to_numpy() for c in ("key", "shape", "set_id", "mark", "mark2"))
    size, place, side = shape >> _SIZE, (shape >> _PLACE) & ((1 << (_SIZE - _PLACE)) - 1), (shape & ((1 << _PLACE) - 1)) - 1
    mark, mark2 = mark.view(np.uint64), mark2.view(np.uint64)
    short = mark ^ mark2  # of half the bits
    # where a line's partners end: at another word, or at lines that are too long
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) if len(key) else key
    room = int(size.max(initial=0)) * DEN // NUM + 1
    stop = np.searchsorted(group * room + size, group * room + size * DEN // NUM, "right")
    order = np.empty(len(rows), np.int64)
    order[np.lexsort((ids, rows["line"].to_numpy(), rows["doc"].to_numpy()))] = np.arange(len(rows))
    asks = rows["asks"].to_numpy() if most is None else None
    # the shorter line of a pair meets the longer one within its still shorter index prefix
    inside = place < size - (2 * NUM * size + NUM + DEN - 1) // (NUM + DEN) + 1
    active = np.flatnonzero(inside)
    crowded = np.zeros(len(rows), bool)  # lines that had more candidates than are kept

    def closest(parts: list[tuple]) -> tuple[np.ndarray, ...]:
        late, early, far = (np.concatenate(x) for x in zip(*parts, strict=True))
        sort = np.lexsort((order[early], far, late))
        late, early, far = late[sort], early[sort], far[sort]
        starts = np.flatnonzero(np.concatenate([[True], late[1:] != late[:-1]]))
        number = np.arange(len(late)) - np.repeat(starts, np.diff(np.append(starts, len(late))))
        kept = number < (most or len(late))
        crowded[late[~kept]] = True
        return late[kept], early[kept], far[kept]

    def table(parts: list[tuple]) -> pd.DataFrame:
        late, early, far = closest(parts)
        return pd.DataFrame({"late": ids[late], "early": ids[early], "far": far.astype(np.int32), "more": crowded[late], "key": key[late]})

    none = np.zeros(0, np.int64)
    parts, held, step = [(none, none, none)], 0, 1
    while len(active):
        active = active[active + step < stop[active]]
        there = active + step
        differ = np.bitwise_count(short[active] ^ short[there])
        near = (differ * np.int64(NUM + DEN) <= size[active] + size[there]) & ((side[active] == 0) | (side[active] != side[there]))
        a, b, d = active[near], there[near], differ[near].astype(np.int64)
        wide = (size[a] >= _LONG_LINE) & (size[b] >= _LONG_LINE)
        d = np.where(wide, np.bitwise_count(mark[a] ^ mark[b]).astype(np.int64) + np.bitwise_count(mark2[a] ^ mark2[b]), d)
        both = size[a] + size[b]
        need = -(-NUM * both // (NUM + DEN))
        reach = 1 + np.minimum(place[a], place[b]) + np.minimum(size[a] - place[a], size[b] - place[b]) - 1
        good = (reach >= need) & (d <= both - 2 * need)
        a, b, d = a[good], b[good], d[good]
        first = order[a] < order[b]
        l, e = np.where(first, b, a), np.where(first, a, b)
        if asks is not None:
            l, e, d = l[asks[l]], e[asks[l]], d[asks[l]]
        parts.append((l, e, d))
        held += len(l)
        if held > _HELD and most:
            parts, held = [closest(parts)], 0
        elif held > _HELD:  # all are wanted: pass them on
            yield table(parts)
            parts, held = [(none, none, none)], 0
        step += 1
    yield table(parts)


def _verified(found: DataFrame, lines: DataFrame, rows: DataFrame) -> DataFrame:
    """Later sets that have a candidate of similarity 0.8 or more."""
    pairs = found.select("late", "early").distinct()
    needed = materialize(pairs.select(F.explode(F.array("late", "early")).alias("set_id")).distinct(), "line-needed")
    # one document that holds the set; where these are too many to tell, all are cut into words
    holders = lines.join(_bounded(needed), "set_id", "left_semi").groupBy("set_id").agg(F.min("doc_key").alias("doc_key"))
    holders = materialize(holders.select("doc_key").distinct(), "line-holders")
    if holders.count() <= BROADCAST_SETS:
        rows = rows.join(F.broadcast(holders), "doc_key", "left_semi")
    words = rows.mapInArrow(_packed, _WORDS).join(_bounded(needed), "set_id", "left_semi").dropDuplicates(["set_id"])
    both = pairs.join(words.select(F.col("set_id").alias("late"), F.col("words").alias("a")), "late").join(
        words.select(F.col("set_id").alias("early"), F.col("words").alias("b")), "early"
    )

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                same = len(np.intersect1d(a, b, assume_unique=True))
                good.append(same * DEN >= NUM * (len(a) + len(b) - same))
            yield batch.loc[np.array(good, bool), ["late"]]

    return both.mapInPandas(check, "late long").distinct()
