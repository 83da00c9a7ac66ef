"""What stored tables, cleaning and reconciliation leave on disk and read again."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_run import SHAPE, SPEC, people

from tallywork.catalog.registry import Tables
from tallywork.operators import clean, quality
from tallywork.plans import run as plan
from tallywork.plans.analysis import analyze
from tallywork.sources.scratch import materialize, settings

MESSY = [(1, "a", 0.5, "x."), (1, " a\t", 0.5, "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "a", 2.0, None), (3, "", 0.0, "x"), (3, "", -0.0, "x"), (4, "b", 1.0, "y")]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_shuffle_files_go_when_a_stored_table_stands(spark):
    before = shuffle_files(spark)
    kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffle_files(spark) <= before and kept.count() == 7
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), settings(spark, **{name: "3", "spark.sql.own.name": "x"}):
        assert spark.conf.get(name) == "3"
        1 / 0
    assert spark.conf.get(name) == old and spark.conf.get("spark.sql.own.name", None) is None


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_clean_scan_gives_the_clean_rows(spark, monkeypatch, most):
    monkeypatch.setattr(clean, "MOST_REPEATED", most)
    df = materialize(spark.createDataFrame(MESSY, "k long, s string, v double, t string").repartition(3), "messy")

    def texts(found):
        return sorted(str((r.k, r.s, None if r.v is None else r.v + 0.0, r.t)) for r in found.collect())

    assert texts(clean.clean_scan(df, "t", ["v"])) == texts(clean.clean(df, "t", ["v"]))
    assert clean.clean_scan(df, "t").columns == df.columns and clean.clean_scan(df, "t").count() == 5


def test_rows_that_are_clean_are_not_stored_again(spark):
    once = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "a", None)], "k long, s string, t string")
    assert clean.clean_scan(once, "t", as_is=True) is once
    blank = once.union(spark.createDataFrame([(4, "a ", "x")], once.schema))
    assert rows(clean.clean_scan(blank, "t", as_is=True), "k")[4]["s"] == "a"
    assert rows(clean.clean_scan(once.union(spark.createDataFrame([(4, "a", "x.")], once.schema)), "t", as_is=True), "k")[4]["t"] == "x"
    raw = materialize(spark.createDataFrame(list(people(40)), SHAPE), "raw")
    done = analyze(raw, SPEC, models=False, charts_too=False, stored_raw=True)
    assert done.cleaned is raw
    plain = analyze(raw, SPEC, models=False, charts_too=False)
    for name in ("categories", "clean_counts"):
        assert sorted(map(str, done.results[name].collect())) == sorted(map(str, plain.results[name].collect()))


def test_run_writes_compressed_text_of_clean_rows(spark, tmp_path):
    data = [*people(30), *people(3)]
    raw = materialize(spark.createDataFrame(data, SHAPE), "raw")
    _tables, manifest = plan.run_analysis(raw, SPEC, f"file://{tmp_path}/out", models=False, charts=False, stored_raw=True)
    folder = Path(manifest.folder.removeprefix("file://")) / "files/cleaned_csv"
    assert [*folder.glob("*.csv.gz")] and not [*folder.glob("*.csv")]
    back = spark.read.schema(SHAPE).csv(str(folder), header=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.dropDuplicates().collect()))


def test_reconcile_reads_each_side_once(spark, tmp_path):
    shape = "t string, k string, g string, v double"
    data = [("a", None, "g", 1.0), ("a", None, "g", 1.0), ("b", "x", None, 2.0), (None, "x", "g", None), (None, None, None, None)]
    sides = []
    for name, part in (("left", data), ("right", data[:3])):
        spark.createDataFrame(part, shape).write.parquet(str(tmp_path / name))
        sides.append(spark.read.parquet(str(tmp_path / name)))
    got = quality.reconcile(*sides, ["k", "g"], "t")
    assert not [f for f in got.inputFiles() if str(tmp_path) in f]  # later reads take the stored facts
    said = {(r["check_name"], r["item"]): (r["left_value"], r["right_value"], r["matches"]) for r in got.collect()}
    assert said == {
        ("rows", ""): (5, 3, False), ("columns", ""): (4, 4, True), ("missing", "k"): (3, 2, False), ("missing", "g"): (2, 1, False),
        ("category", "a"): (2, 2, True), ("category", "b"): (1, 1, True), ("distinct_rows", ""): (4, 2, False),
    }
    empty = rows(quality.reconcile(sides[0].limit(0), sides[0].limit(0), ["k"], "t"), "check_name", "item")
    assert {k: v["left_value"] for k, v in empty.items()} == {("rows", ""): 0, ("columns", ""): 4, ("missing", "k"): 0, ("distinct_rows", ""): 0}


def test_reconcile_tells_zeros_of_a_numeric_target_apart(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (1.0, "x")], "t double, k string")
    got = rows(quality.reconcile(df, df, ["k"], "t"), "check_name", "item")
    assert {k[1]: v["left_value"] for k, v in got.items() if k[0] == "category"} == {"0.0": 1, "-0.0": 1, "1.0": 1}
    assert got["distinct_rows", ""]["left_value"] == 2


def test_stored_view_is_the_view_without_its_hash(spark, tmp_path):
    tables = {
        "lineitem": ([(o, p, 5, n, 7.0, 100.0, 0.1, 0.0, "R") for o in (1, 2, 2, None) for p in (1, 2, 9) for n in (1, 1)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"),
        "orders": ([(1, 1, "1-URGENT"), (2, 1, "5-LOW"), (2, 2, "2-HIGH"), (3, 7, "x")], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "customer": ([(1, "A"), (2, "B"), (2, None)], "c_custkey long, c_mktsegment string"),
        "part": ([(1, 3, "b", "t"), (2, 4, None, "u")], "p_partkey long, p_size int, p_brand string, p_type string"),
    }
    for name, (data, shape) in tables.items():
        spark.createDataFrame(data, shape).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    assert t.stored_census.columns == t.census.columns and t.census.count() == 28  # 4 rows of order 1, 8 of order 2 for each of its 3 customers
    assert sorted(map(str, t.stored_census.collect())) == sorted(map(str, t.census.collect()))
    assert "h" not in spark.read.parquet(*t.stored_census.inputFiles()).columns
