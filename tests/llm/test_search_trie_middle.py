"""Forest search, fill-in-the-middle and the prefix trie, each against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_rows import EDGES, LONG, SCHEMA, doc, nothing  # noqa: F401
from pyspark.sql import types as T

from tallywork.llm import prefix_trie as trie
from tallywork.llm import projection_forest as forest
from tallywork.llm.fill_in_middle import arrange, cut, fill_in_middle, restore

CLASHING = [T.StructField(n, T.StringType()) for n in ("row", "least", "v", "pos", "block", "k1", "copy", "part", "output", "n")]


def middle_of(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MIDDLES = [
    *EDGES,
    *[doc(100 + i, "αβ γ\n\nδ\U0001f600 line\n" * (i + 1) + "no line feed at the end") for i in range(12)],
    *[doc(200 + i, t) for i, t in enumerate(["\n", "\n\n\n", "a<P>b\nc", "<S\n>x\n<", "<P\n", "cr\r\nlf\n", "<", "nul\x00in\nside"])],
    doc(300, LONG.replace(" ", "\n") * 3),
]


def test_middle_equals_brute_force(spark):
    docs = spark.createDataFrame(MIDDLES, SCHEMA)
    for rate, spm_rate in ((100, 50), (40, 0)):
        made = fill_in_middle(docs, rate, spm_rate)
        got = sorted(map(repr, made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256").collect()))
        assert got == sorted(
            repr(T.Row(doc_id=d, n=n, form=f, prefix_chars=p, middle_chars=m, output=o, output_sha256=hashlib.sha256(o.encode()).hexdigest()))
            for d, text, *_ in MIDDLES
            for n, f, p, m, o in [middle_of(d, text, rate, spm_rate)]
        )
        back = restore(made).select("doc_id", "text", "restored_sha256").collect()
        assert sorted(map(repr, back)) == sorted(
            repr(T.Row(doc_id=d, text=t or "", restored_sha256=hashlib.sha256((t or "").encode()).hexdigest())) for d, t, *_ in MIDDLES
        )


def test_middle_of_nothing(nothing):  # noqa: F811
    assert restore(fill_in_middle(nothing)).collect() == []


def test_pieces_are_cut_and_arranged():
    left, right = cut([("T", 0, 4), ("T", 10, 12)], 5)
    assert (left, right) == ([("T", 0, 4), ("T", 10, 11)], [("T", 11, 12)])
    assert cut([("T", 0, 4)], 4) == ([("T", 0, 4)], []) and cut([], 3) == ([], [])
    parts = {"p": [("T", 0, 1)], "m": [], "s": [("T", 1, 2)]}
    assert arrange(parts, "spm") == [("S", 0, 3), ("T", 1, 2), ("P", 0, 3), ("T", 0, 1), ("M", 0, 3)]


def trie_of(rows):
    """Every node of the rebuilt conversations, by prefixes as tuples."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fix(c / 20)) * 0 - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(p)))
        out.append(
            (
                min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids.get(p, [])), sum(q not in kids for q in below),
                sum((len(members[q]) - 1) * words(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def conversations(seed=5):
    draw, rows = random.Random(seed), []
    for c in [*range(45), *range(-25, -3), 60, 61, 77, 2**62, 2**62 + 1]:
        for turn in range(draw.choice([0, 1, 2, 2, 3, 5, 8, 9, 16, 17, 26])):
            rows.append((c, draw.choice([turn, turn, turn, 1, None]), draw.choice(["user", "user", None]), draw.choice(["a b", "a b", "", None, "c\td e"])))
    rows += [(45, t, "user", "same words here") for t in range(40)] + [(46, t, "user", "same words here") for t in range(40)]
    rows += [(47, 1, "user", "again")] * 30 + [(None, 1, "user", "lost")]
    return [(*r, *["x"] * len(CLASHING)) for r in rows]


TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), *CLASHING]
)


@pytest.mark.parametrize("stride", [1 << 10, 2])
def test_trie_equals_brute_force(spark, monkeypatch, stride):
    monkeypatch.setattr(trie, "STRIDE", stride)
    rows = conversations()
    got = trie.prefix_trie(trie.branched(spark.createDataFrame(rows, TURNS).repartition(3)))
    order = lambda r: (r[1], r[0])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(trie_of(rows), key=order)


def test_trie_of_nothing_and_of_turnless(spark):
    assert trie.prefix_trie(trie.branched(spark.createDataFrame([], TURNS))).collect() == []
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(alone, None, None, None, *["x"] * len(CLASHING))]
    assert [tuple(r) for r in trie.prefix_trie(trie.branched(spark.createDataFrame(rows, TURNS))).collect()] == trie_of(rows)


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), *CLASHING])


def exact(rows, k):
    """Brute force over rows of (id, vector): {(query id, vector): [(id, score)]}."""
    good = [(i, tuple(v)) for i, v, *_ in rows if i is not None and v and any(v) and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    full = [np.pad(np.array(v, np.float64), (0, width - len(v))) for _, v in good]
    out = {}
    for a, (i, v) in enumerate(good):
        if i % 20 == 0:
            scores = [(-float(np.dot(full[a], full[b])), j) for b, (j, _) in enumerate(good) if b != a]
            out.setdefault(i, []).append([(j, -s) for s, j in sorted(scores)[:k]])
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(v, s) for _, v, s in sorted(rows)] for q, rows in out.items()}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * len(CLASHING)) for i, v in rows], VECTORS)


def test_forest_on_edge_rows(spark):
    draw = random.Random(3)
    rows = [(i, [float(draw.randint(-3, 3)) for _ in range(4)]) for i in range(120)]
    rows += [(1000 + i, [2.0, 1.0, 0.0, -1.0]) for i in range(200)]  # a vector that fills over a third
    rows += [(5, [1.0, 2.0]), (5, [-1.0, 2.0]), (7, [-0.0, 1.0]), (7, [0.0, 1.0]), (-20, [3.0])]
    rows += [(20_000, None), (20_020, []), (20_040, [0.0, 0.0]), (20_060, [float("nan"), 1.0]), (20_080, [None, 1.0]), (20_100, [float("inf")]), (None, [1.0])]
    got, true = found(forest.nearest(vectors(spark, rows), k=20)), exact(rows, 20)
    assert got.keys() == true.keys()
    for q, lists in true.items():
        assert got[q] == lists[0], q


def test_forest_with_few_rows(spark):
    assert forest.nearest(vectors(spark, [])).collect() == []
    assert forest.nearest(vectors(spark, [(20, [1.0])])).collect() == []
    assert forest.nearest(vectors(spark, [(1, [1.0]), (2, [2.0])])).collect() == []
    assert found(forest.nearest(vectors(spark, [(20, [1.0]), (2, [2.0]), (40, [1.0])]))) == {20: [(2, 2.0), (40, 1.0)], 40: [(2, 2.0), (20, 1.0)]}
    twice = forest.nearest(vectors(spark, [(20, [1.0]), (20, [1.0])])).collect()  # repeated rows are candidates for each other
    assert sorted(map(tuple, twice)) == [(20, 1, 20, 1.0)] * 2


def test_forest_recall_with_trees(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 32)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24))
    x = (centres[rng.integers(0, 40, 3000)] + 0.5 * rng.normal(size=(3000, 24))) * rng.uniform(0.2, 3, (3000, 1))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, true = found(forest.nearest(vectors(spark, rows), k=20)), exact(rows, 20)
    assert got.keys() == true.keys() and all(len(v) == 20 for v in got.values())
    share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in lists[0]}) / 20 for q, lists in true.items()])
    assert share >= 0.9
    known = {q: dict(exact(rows, 3000)[q][0]) for q in (0, 20)}
    assert all(abs(known[q][i] - s) < 1e-9 for q in known for i, s in got[q])
