"""Trie of conversation prefixes: one ROLLUP over columns of turns aggregates every prefix.

A conversation becomes rows of ``WIDTH`` turns, one column each. ``ROLLUP`` over these columns gives a
group for every prefix inside a row and ``grouping_id`` tells how long it is. Longer conversations go on
in further rows (blocks), which are grouped under the name of the node at which the block before
ended. That name is a running digest, so all blocks roll up in one job, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field, number_copies
from tallywork.sources.scratch import materialize

WIDTH = 8  # turns in a block
HEAD = 4  # a conversation takes fewer turns than this from the one it branches off
SPAN = 20  # conversations that branch off one
STRIDE = 1 << 10  # rows summed together by one window
ENDS = 12  # ids that agree but for so many bits are listed together
_KEY = ("k1", "k2")
_WORD = r"[^\x20\x09-\x0D]+"


def branched(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns of the rebuilt conversations: (conv_id, pos, turn_key, words); one row with NULL ``pos`` for a conversation without turns.

    The turns of a conversation are ordered by turn (NULL first), then role and text. Conversation c takes the first crc32(c) % 4 turns of conversation
    c - c % 20 and goes on with its own turns after as many. ``turn_key`` is a 128-bit digest of role and text, NULLs being empty; ``words``
    counts the words of the text. Rows without conversation id take no part; repeated rows are turns of their own.

    Rows are dealt by ranges of (conversation, turn, role, text) and numbered within a range, so a
    conversation with a third of all rows lies in many ranges and no task holds it whole.
    """
    chosen = conversations.select(
        field(conv_col).cast("long").alias("conv_id"),
        field(turn_col).alias("turn"),
        F.coalesce(field(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(field(text_col).cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    sorted_ = number_copies(chosen).repartitionByRange(*order).sortWithinPartitions(*order)
    turn_key = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256), 1, 32))
    at = F.monotonically_increasing_id()
    placed = sorted_.select("conv_id", turn_key.alias("turn_key"), F.size(F.regexp_extract_all("text", F.lit(_WORD), 0)).cast("long").alias("words"), at.alias("at"))
    turns = materialize(placed.withColumn("part", F.shiftright("at", 33)), "trie-turns")

    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))  # ranges a conversation lies in
    spans = spans.withColumn("before", before)
    spans = materialize(spans, "trie-spans")
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    numbered = turns.join(spans.drop("n"), ["conv_id", "part"]).select("conv_id", "part", pos.alias("pos"), "turn_key", "words")
    numbered = materialize(numbered, "trie-numbered")

    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("own"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD)).cast("long")
    convs = materialize(convs.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % SPAN).alias("base"), taken.alias("taken")), "trie-convs")
    heads = numbered.filter(F.col("pos") < HEAD).select(F.col("conv_id").alias("base"), "pos", "turn_key", "words")
    borrowed = convs.join(heads, "base").filter("pos <= taken").select("conv_id", "pos", "turn_key", "words")
    got = borrowed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("got"))
    shift = convs.join(got, "conv_id", "left").select("conv_id", "own", "taken", F.coalesce("got", F.lit(0)).alias("got"))
    shift = materialize(shift, "trie-shift")
    by_span = spans.select("conv_id", "part").join(shift, "conv_id")  # so that a long conversation's turns meet its shift range by range
    moved = numbered.join(by_span, ["conv_id", "part"]).filter("pos > taken")
    moved = moved.select("conv_id", (F.col("pos") - F.col("taken") + F.col("got")).alias("pos"), "turn_key", "words")
    bare = shift.filter("own <= taken AND got = 0").select("conv_id", F.lit(None).cast("long"), F.lit(None).cast("binary"), F.lit(None).cast("long"))
    return borrowed.union(moved).union(bare)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over turns as :func:`branched` gives them, the root with depth 0 included.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). A node is a distinct sequence of first turns; ``conv_id`` is the
    smallest conversation that starts with it. ``n_leaves`` and ``saved_tokens`` sum over the subtree: leaves count at their smallest
    conversation, and the words a node saves, (n_convs - 1) times those of its last turn, are entered there too; what a
    conversation holds from a depth on is a suffix sum, and a second ROLLUP adds the suffix sums of a node's conversations.

    Nodes are told apart by 128-bit digests. No conversation and no node's list of conversations is gathered: running sums go
    by strides, and the ids that end at a node reach its hash as a sorted stream of short lists, which is read
    by one task as a hash must be. An empty table gives no rows.
    """
    place = "coalesce(pos, 1) - 1"
    rows = turns.withColumn("block", F.expr(f"({place}) div {WIDTH}")).withColumn("slot", F.expr(f"({place}) % {WIDTH}"))
    steps = [F.xxhash64(F.lit(salt), "pos", "turn_key").alias(f"s{salt}") for salt in (1, 2)]
    rows = rows.select("conv_id", "block", "slot", "pos", "turn_key", "words", *steps)
    columns = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{n}{i + 1}") for c, n in (("turn_key", "t"), ("words", "w")) for i in range(WIDTH)]
    own = [F.bit_xor(F.when(F.col("pos").isNotNull(), F.col(f"s{salt}"))).alias(f"s{salt}") for salt in (1, 2)]
    wide = rows.groupBy("conv_id", "block").agg(F.count("pos").cast("int").alias("filled"), *columns, *[F.coalesce(c, F.lit(0)).alias(f"s{i + 1}") for i, c in enumerate(own)])
    wide = materialize(wide, "trie-blocks")
    longest = (wide.agg(F.max("block")).first()[0] or 0) + 1
    keys = _running(wide.select("conv_id", "block", "s1", "s2"), ["s1", "s2"], F.bit_xor, longest)
    wide = wide.join(keys.select("conv_id", "block", F.col("before_s1").alias("k1"), F.col("before_s2").alias("k2")), ["conv_id", "block"])
    wide = materialize(wide, "trie-wide")

    nodes = _rollup(wide, ["count(*) AS n_convs", "min(conv_id) AS conv_id", *[f"max(w{i}) AS w{i}" for i in _slots()]])
    words = F.when(F.col("depth") > 0, F.element_at(F.array(*[F.col(f"w{i}") for i in _slots()]), F.greatest("slot", F.lit(1)))).otherwise(0)
    nodes = materialize(nodes.select("depth", *_KEY, "p1", "p2", "conv_id", "n_convs", words.alias("words")), "trie-nodes")

    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, ["k1", "k2", "depth"], "left").fillna(0, ["n_children"]), "trie-counted")

    sums = _subtrees(nodes, wide, longest)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, ["p1", "p2", "depth"], "left").join(sums, ["k1", "k2", "depth"], "left").join(_ends(wide), ["k1", "k2", "depth"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def _slots() -> range:
    return range(1, WIDTH + 1)


def _rollup(wide: DataFrame, aggregates: list[str]) -> DataFrame:
    """One row per prefix inside a block: its slot, depth, own and parent's name (k1, k2, p1, p2) and the aggregates."""
    turns = ", ".join(f"t{i}" for i in _slots())
    here = wide.sparkSession.sql(
        f"""SELECT block, k1 AS b1, k2 AS b2, {turns}, {WIDTH} - bit_count(grouping_id()) AS slot, {", ".join(aggregates)}
        FROM {{wide}} GROUP BY block, k1, k2, ROLLUP ({turns})""",
        wide=wide,
    )
    last = F.element_at(F.array(*[F.col(f"t{i}") for i in _slots()]), F.greatest("slot", F.lit(1)))
    # a NULL turn that is not left out stands behind the end of a conversation
    here = here.filter(((F.col("slot") > 0) & last.isNotNull()) | ((F.col("slot") == 0) & (F.col("block") == 0)))
    depth = F.col("block") * WIDTH + F.col("slot")

    def step(salt: int, i: int) -> Column:
        return F.when(F.col(f"t{i}").isNotNull(), F.xxhash64(F.lit(salt), (F.col("block") * WIDTH + i).cast("long"), F.col(f"t{i}"))).otherwise(0)

    for salt, name in ((1, "1"), (2, "2")):
        steps = [step(salt, i) for i in _slots()]
        own = reduce(lambda a, b: a.bitwiseXOR(b), steps, F.col(f"b{name}"))
        parent = own.bitwiseXOR(F.when(F.col("slot") > 0, F.element_at(F.array(*steps), F.greatest("slot", F.lit(1)))).otherwise(0))
        here = here.withColumn(f"k{name}", own).withColumn(f"p{name}", parent)
    return here.withColumn("depth", depth.cast("long"))


def _subtrees(nodes: DataFrame, wide: DataFrame, longest: int) -> DataFrame:
    """(k1, k2, depth, n_leaves, saved_tokens) of nodes with either."""
    saved, leaf = (F.col("n_convs") - 1) * F.col("words"), (F.col("n_children") == 0).cast("long")
    entered = nodes.select("conv_id", "depth", saved.alias("saved"), leaf.alias("leaf")).filter("saved > 0 OR leaf > 0")
    entered = entered.withColumn("block", F.expr(f"greatest(depth - 1, 0) div {WIDTH}")).withColumn("slot", F.col("depth") - F.col("block") * WIDTH)
    cells = [
        F.sum(F.when(F.col("slot") == i, F.col(c)).otherwise(0)).alias(f"{c}{i}") for c in ("saved", "leaf") for i in range(WIDTH + 1)
    ]
    cells = entered.groupBy("conv_id", "block").agg(*cells, F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    cells = materialize(cells, "trie-cells")
    # what lies in later blocks is the conversation's total less what lies up to this one
    total = cells.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaf"))
    rows = wide.drop("s1", "s2", *[f"w{i}" for i in _slots()]).join(total, "conv_id").join(cells.drop("saved", "leaf"), ["conv_id", "block"], "left")
    # blocks without entries of their own stand between those that have some
    rows = rows.fillna(0, [f"{c}{i}" for c in ("saved", "leaf") for i in range(WIDTH + 1)])
    here = [reduce(lambda a, b: a + b, [F.col(f"{c}{i}") for i in range(WIDTH + 1)]).alias(c) for c in ("saved", "leaf")]
    run = _running(rows.select("conv_id", "block", *here), ["saved", "leaf"], F.sum, longest)
    rows = rows.join(run, ["conv_id", "block"])
    later = {c: F.col(f"all_{c}") - F.col(f"before_{c}") - F.col(c) for c in ("saved", "leaf")}
    suffix = [(later[c] + reduce(lambda a, b: a + b, [F.col(f"{c}{j}") for j in range(i, WIDTH + 1)])).alias(f"{c}_from{i}") for c in later for i in range(WIDTH + 1)]
    rows = rows.select("block", *_KEY, *[f"t{i}" for i in _slots()], *suffix)
    sums = _rollup(rows, [f"sum({c}_from{i}) AS {c}_from{i}" for c in later for i in range(WIDTH + 1)])
    at = {c: F.element_at(F.array(*[F.col(f"{c}_from{i}") for i in range(WIDTH + 1)]), F.col("slot") + 1) for c in later}
    return sums.select(*_KEY, "depth", at["leaf"].alias("n_leaves"), at["saved"].alias("saved_tokens"))


def _running(rows: DataFrame, values: list[str], add, blocks: int) -> DataFrame:
    """``rows`` (conv_id, block, values) with ``before_x``: x aggregated over the smaller blocks of the conversation.

    Strides of blocks are aggregated first and run up in the same way, so no window sees more than STRIDE rows.
    """
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    if blocks <= STRIDE:
        over = earlier.partitionBy("conv_id")
        return rows.select("*", *[F.coalesce(add(v).over(over), F.lit(0)).alias(f"before_{v}") for v in values])
    coarse = rows.groupBy("conv_id", F.expr(f"block div {STRIDE}").alias("block")).agg(*[add(v).alias(v) for v in values])
    coarse = _running(coarse, values, add, -(-blocks // STRIDE)).select("conv_id", F.col("block").alias("_stride"), *[F.col(f"before_{v}").alias(f"_{v}") for v in values])
    over = earlier.partitionBy("conv_id", "_stride")
    near = rows.withColumn("_stride", F.expr(f"block div {STRIDE}"))
    near = near.select("*", *[F.coalesce(add(v).over(over), F.lit(0)).alias(f"_near_{v}") for v in values]).join(coarse, ["conv_id", "_stride"])

    def both(v: str) -> Column:
        pair = F.col(f"_{v}"), F.col(f"_near_{v}")
        return pair[0].bitwiseXOR(pair[1]) if add is F.bit_xor else pair[0] + pair[1]

    return near.select(*rows.columns, *[both(v).alias(f"before_{v}") for v in values])


def _ends(wide: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of nodes at which conversations end."""
    last = wide.groupBy("conv_id").agg(F.max("block").alias("block"))
    ended = wide.join(last, ["conv_id", "block"]).select(
        "conv_id", F.col("k1").bitwiseXOR(F.col("s1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("s2")).alias("k2"), (F.col("block") * WIDTH + F.col("filled")).alias("depth")
    )
    # a range holds 2 ** ENDS ids at most; a node's ranges, in order, make up its list
    listed = ended.groupBy("k1", "k2", "depth", F.shiftright("conv_id", ENDS).alias("range")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = listed.select("k1", "k2", "depth", "range", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    dealt = listed.repartition("k1", "k2", "depth").sortWithinPartitions("k1", "k2", "depth", "range")
    return dealt.mapInArrow(_digests, "k1 long, k2 long, depth long, ends_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node; a node's rows follow each other, also from batch to batch."""
    node, sha = None, None
    for batch in batches:
        done = []
        for k1, k2, depth, _range, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k1, k2, depth) == node:
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, sha.hexdigest()))
            node, sha = (k1, k2, depth), hashlib.sha256(ids.encode())
        if done:
            yield _named(done)
    if node is not None:
        yield _named([(*node, sha.hexdigest())])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["k1", "k2", "depth", "ends_sha256"])
