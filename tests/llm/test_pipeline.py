"""The pipeline on a small folder of tables: every stage against a brute-force version of what it does, and the whole run."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from llm_rows import EDGES, SCHEMA, doc
from test_free import brute_links, quality_rows
from test_native import brute_leaks, brute_targets

import corpus_pipeline
from tallywork.llm.quality import fit_quality, score_quality

COLUMNS = [f.name for f in SCHEMA.fields]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def corpus():
    rng = random.Random(12)
    rows, labels = [], []
    for (i, text, *_), good in quality_rows(400):
        rows.append(doc(1000 + i, text, rng.choice(["a", "a", "b", None])))
        labels.append((1000 + i, good))
    long = [r for r in rows if len(words(r[1])) > 30]
    for k, base in enumerate(rng.sample(long, 40)):  # near and exact copies, some of copies
        changed = base[1].split(" ")
        if k % 3:
            changed[k % 5] = f"changed{k}"
        rows.append(doc(2000 + k, " ".join(changed), rng.choice(["a", "b"])))
        if k % 4 == 0:
            rows.append(doc(3000 + k, " ".join(changed + ["more"]), "c"))
    items = [(n, " ".join(f"item{n}w{k}" for k in range(size))) for n, size in enumerate((8, 12, 25))]
    for k in range(12):
        base = rng.choice(long)[1].split(" ")
        rows.append(doc(4000 + k, " ".join([*base[:9], *items[k % 3][1].split(), *base[9:]]), "b"))
    return rows + EDGES, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = corpus()
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"file://{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{path}/benchmark.parquet")
    return f"file://{path}"


def counted(rows):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in rows)


def after_quality(rows, docs, spark, folder):
    found = score_quality(docs, fit_quality(docs, spark.read.parquet(f"{folder}/labels.parquet"))).collect()
    good = {(r["doc_id"], r["score"] >= 0.3) for r in found}
    by_id = {i for i, ok in good if ok} - {i for i, ok in good if not ok}
    mixed = {i for i, ok in good if ok} & {i for i, ok in good if not ok}  # rows without id have one name for two texts
    return Counter({k: n for k, n in counted(rows).items() if k[0] in by_id}), mixed


def after_copies(rows):
    distinct = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows})
    classes = brute_links([(n, text) for n, (_, _, text) in enumerate(distinct)])
    return {(None if none else i, text) for n, (none, i, text) in enumerate(distinct) if not words(text) or classes[n][0] == n}


def after_leaks(rows, items):
    plain = [(n, " ".join(words(r["text"]))) for n, r in enumerate(rows)]
    bad = {d for d, _ in brute_leaks([p for p in plain if len(p[1]) < 20_000], items)}
    return Counter((r["doc_id"], r["text"], r["source"]) for n, r in enumerate(rows) if n not in bad)


def sharded(rows):
    ordered = sorted(rows, key=lambda r: (hashlib.md5((r["text"] or "").encode()).hexdigest(), r["doc_id"] is not None, r["doc_id"] or 0))
    sizes = [len((r["text"] or "").encode()) + 8 for r in ordered]
    total, start, slots, out = sum(sizes), 0, Counter(), []
    for r, size in zip(ordered, sizes, strict=True):
        shard = min(23, (2 * start + size) * 24 // (2 * total))
        out.append((r["doc_id"], size, zlib.crc32((r["text"] or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        start += size
    return out


def test_stages_and_run(spark, folder, tmp_path):
    _rows, _labels, items = corpus()
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(f"file://{tmp_path}/{name}")
        done = spark.read.parquet(f"file://{tmp_path}/{name}")
        after = done.collect()
        seen.append((len(before), len(after)))
        if name != "shard":
            assert done.columns == COLUMNS
        if name == "quality":
            expected, mixed = after_quality(before, docs, spark, folder)
            assert Counter({k: n for k, n in counted(after).items() if k[0] not in mixed}) == expected
        elif name == "near_copies":
            assert {(r["doc_id"], r["text"] or "") for r in after} == after_copies(before) and len(after) == len(after_copies(before))
        elif name == "decontaminate":
            assert counted(after) == after_leaks(before, items)
        elif name == "mix":
            taken, sizes, largest = Counter(), Counter(), Counter()
            split = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
            for r in before:
                sizes[r["source"]] += split(r["text"])
                largest[r["source"]] = max(largest[r["source"]], split(r["text"]))
            for r in after:
                taken[r["source"]] += split(r["text"])
            for source, target in brute_targets(sizes).items():  # a document at the cut is taken whole
                assert target - 1 <= taken[source] <= target + largest[source]
            known, times = counted(before), counted(after)
            assert set(times) <= set(known) and all(n <= 2 * known[k] for k, n in times.items())
        else:
            assert sorted(map(repr, ((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in after))) == sorted(map(repr, sharded(before)))
        docs = done
    assert seen[0][1] < seen[0][0] and seen[1][1] < seen[1][0] and seen[2][1] < seen[2][0]  # the first three took something away
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.select(*whole.columns).collect()))


def test_run_on_empty_tables(spark, tmp_path):
    for name, shape in (("documents", SCHEMA), ("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], shape).write.parquet(f"file://{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
