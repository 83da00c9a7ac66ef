"""Sharding, mixing, licences and decontamination on small tables with edge rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from llm_rows import LONG, SCHEMA, doc, edges, nothing  # noqa: F401

from tallywork.llm.decontamination import LEAST_EQUAL, find_leaks, layout, without_leaks
from tallywork.llm.licences import RULES, SENTENCES, anchors, normalised, recognise
from tallywork.llm.mixing import mix_sources, mixed_rows
from tallywork.llm.sharding import shard_by_bytes, write_shards


def test_shards_are_near_equal_and_gapless(spark, edges):
    rows = shard_by_bytes(edges, 3).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in edges.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].size == 8 and by_id[3].text_crc32 == 0
    assert by_id[6].text_crc32 == zlib.crc32(b"short") and by_id[6].size == 13


def test_hot_text_is_spread_over_shards(spark):
    table = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text' ELSE concat('text ', id) END AS text")
    rows = shard_by_bytes(table, 6).collect()
    total, sizes = sum(r.size for r in rows), Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert len(sizes) == 6 and all(abs(s - total / 6) <= 30 for s in sizes.values())


def test_shards_of_nothing_and_of_one(spark, nothing):
    assert shard_by_bytes(nothing).count() == 0
    one = shard_by_bytes(spark.createDataFrame([(1, "x")], "doc_id long, text string"), 4).collect()
    assert [(r.slot, r.size) for r in one] == [(0, 9)]


def test_written_shards_hold_the_texts(spark, tmp_path):
    table = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    write_shards(table, shard_by_bytes(table, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.shard for r in back.collect()} == {0, 1, 2, 3}
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in table.collect())


def brute_targets(sizes):
    """The contract's rule as it is said: share by weight, stop at twice the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    targets, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        capped = {s for s in free if weights[s] * level > 2 * sizes[s]}
        if not capped:
            return targets | {s: weights[s] * level for s in free}
        for s in capped:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        free -= capped
    return targets


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [doc(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = mix_sources(table, rows_per_bucket=50).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
    targets = brute_targets(sizes)
    for r in found:
        assert r.target == pytest.approx(targets[r.source])
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mix_sources(table.repartition(5), rows_per_bucket=70).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)


def test_mix_edges(spark, edges, nothing):
    rows = mix_sources(edges).collect()
    assert len(rows) == edges.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mix_sources(nothing).count() == 0
    assert {r.target for r in mix_sources(edges.filter("text IS NULL")).collect()} == {0.0}
    mixed = mixed_rows(edges)
    assert mixed.columns == edges.columns
    assert Counter(r.doc_id for r in mixed.collect())[1] == sum(r.copies for r in rows if r.doc_id == 1)
    assert mixed_rows(nothing).count() == 0


def test_licences(spark, edges, nothing):
    apache = [SENTENCES[k] for k in ("apache-grant", "apache-use", "apache-copy-url", "apache-basis", "apache-see")]
    rows = [
        doc(1, "Prose before | x\n" + SENTENCES["mit-line"] + "\nProse after. More."),
        doc(2, "\n\n".join(apache).replace("software distributed", "software\ndistributed")),
        doc(3, "\n".join([SENTENCES["mit-grant"], "Some other words.", SENTENCES["mit-notice"]])),
        doc(4, "this is licensed under nothing. license license"),
        doc(5, (SENTENCES["gpl3-line"] + " ") * 300),
        doc(5, (SENTENCES["gpl3-line"] + " ") * 300),
    ]
    found = recognise(spark.createDataFrame(rows, SCHEMA)).collect()
    names = Counter((r.doc_id, r.licence, r.rule) for r in found)
    assert names == {(1, "MIT", "mit-line"): 1, (2, "Apache-2.0", "apache-header"): 1, (3, "MIT", "mit-grant"): 1, (5, "GPL-3.0-only", "gpl3-line"): 300}
    assert recognise(edges).count() == recognise(nothing).count() == 0
    assert all(set(anchors()) & set(normalised(s).split()) for s in SENTENCES.values())


def test_every_licence_rule_is_found(spark):
    rows = [doc(i, "\n\n".join(["Prose before."] + [SENTENCES[k] for k in ids] + ["Prose after."])) for i, (_, _, ids) in enumerate(RULES)]
    used = {k for _, _, ids in RULES for k in ids}
    assert used == set(SENTENCES)
    tags = [
        doc(100, "Copyright 2020 somebody\n// SPDX-License-Identifier: MIT\nimport this and that"),
        doc(101, "SPDX-License-Identifier: MIT OR BSD-3-Clause\n\nMIT\n\nmore"),  # another licence, and a line that is none
        doc(102, "SPDX-License-Identifier: unknown\n\nMIT"),
        doc(103, "Released under the MIT License.\n\nLicence: MIT. SPDX-License-Identifier:\nApache-2.0\n"),
        doc(104, SENTENCES["gpl3-free"].replace("redistribute", "resell")),
    ]
    found = defaultdict(list)
    for r in recognise(spark.createDataFrame(rows + tags, SCHEMA)).collect():
        found[r.doc_id].append((r.rule, r.first_sentence, r.last_sentence))
    for i, (rule, _, ids) in enumerate(RULES):
        cut = sum(k in ("spdx-apache", "spdx-mit", "spdx-gpl3", "gpl3-free") for k in ids)
        assert found[i] == [(rule, 2, 1 + len(ids) + cut)], rule
    assert found[100] == [("mit-tag", 1, 2)]
    assert not {101, 102, 104} & set(found)
    assert [r[0] for r in sorted(found[103], key=lambda r: r[1])] == ["mit-line", "apache-tag"]


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def test_leaks(spark, edges, nothing):
    words = ITEM.split()
    swapped = words.copy()
    swapped[4], swapped[13] = "other", "words"
    prose = " ".join(f"filler{i}" for i in range(300))
    rows = [
        doc(1, f"{prose} {ITEM.upper()}, {prose}"),
        doc(2, f"{prose} {' '.join(swapped)} {prose}"),
        doc(3, f"{prose} {' '.join(words[:8])} {prose}"),
        doc(4, f"{LONG} {ITEM}"),
        doc(5, " ".join(reversed(words))),
        doc(None, ITEM),
        doc(None, "a clean text without id"),
        doc(6, None),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame([(10, ITEM), (11, ITEM), (12, None), (13, "too short"), (None, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in find_leaks(table, items).collect()}
    assert set(found) == {(d, i) for d in (1, 2, 4, None) for i in (10, 11)}
    assert found[1, 10].most_equal == 1.0 and (found[1, 10].first_word, found[1, 10].last_word) == (300, 319)
    assert found[2, 10].most_equal >= 0.8
    clean = without_leaks(table, items)
    assert clean.columns == table.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows if (r[0], r[1]) not in {(d, t) for d, t, *_ in rows if d in (1, 2, 4) or t == ITEM})
    assert find_leaks(nothing, items).count() == find_leaks(edges, items.filter("item_id = 13")).count() == 0


def test_leaks_in_blocks(spark, monkeypatch):
    from tallywork.llm import decontamination

    monkeypatch.setattr(decontamination, "SEEDS_PER_BLOCK", 7)
    items = spark.createDataFrame([(1, ITEM), (2, " ".join(f"q{i}" for i in range(15)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM), (2, "x " + " ".join(f"q{i}" for i in range(15)))], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()) == [(1, 1), (2, 2)]


def brute_leaks(docs, items):
    """Every window of every item against every place of every document."""
    found = {}
    for d, text in docs:
        for i, item in items:
            a, b = text.split(), item.split()
            span, pad = (10, 2) if len(b) >= 10 else (len(b), 0)
            for p in range(len(a) - span + 1):
                for q in range(len(b) - span + 1) if b else ():
                    places = [o for o in range(-pad, span + pad) if 0 <= q + o < len(b)]
                    share = sum(0 <= p + o < len(a) and a[p + o] == b[q + o] for o in places) / len(places)
                    if share >= 0.8:
                        found.setdefault((d, i), []).append((p, p + span - 1, round(share, 6)))
    return {k: (len({p for p, _, _ in v}), min(v)[0], max(e for _, e, _ in v), max(s for _, _, s in v)) for k, v in found.items()}


def test_leaks_equal_brute_force(spark):
    rng = random.Random(5)
    lengths = [1, 2, 4, 5, 7, 9, 10, 10, 11, 12, 12, 13, 14, 15, 15, 20, 20, 38]
    items = [(i, " ".join(f"i{i}w{k}" for k in range(n))) for i, n in enumerate(lengths)]
    items += [(50 + i, " ".join(rng.choice("abc") for _ in range(n))) for i, n in enumerate((3, 6, 10, 12, 17))]
    docs = []
    for _, item in items:
        words = item.split()
        for exchanged in (0, 1, 1, 2, 2, 2, 3, 4):
            out = set(rng.sample(range(len(words)), min(exchanged, len(words))))
            passage = [f"other{k}" if k in out else w for k, w in enumerate(words)]
            docs.append((len(docs), " ".join([f"f{k}" for k in range(rng.choice((0, 1, 30)))] + passage + [f"g{k}" for k in range(rng.choice((0, 1, 200)))])))
    ten = items[6][1].split()
    for place in range(10):  # any single word of the shortest item with a window
        docs.append((len(docs), " ".join(["x"] * 20 + ten[:place] + ["other"] + ten[place + 1 :] + ["y"] * 20)))
    for first in range(6):  # every sixth word
        docs.append((len(docs), " ".join("other" if k % 6 == first else w for k, w in enumerate(items[-6][1].split()))))
    docs += [(len(docs) + k, " ".join(rng.choice("abcd") for _ in range(rng.choice((4, 9, 13, 150))))) for k in range(20)]
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.windows, r.first_word, r.last_word, r.most_equal) for r in found.collect()} == brute_leaks(docs, items)


def test_masks_leave_out_any_two_places():
    for n in range(1, 11):
        shape = layout(n)
        allowed = max(k for k in range(3) if k == 0 or (n - k) / n >= LEAST_EQUAL)
        for out in combinations(range(n), allowed):
            assert any(all(mask[i] == "0" for i in out) for mask in shape.masks)
