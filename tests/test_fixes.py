"""Constant columns, large integers, missing targets, stored edges, and tails at any size."""

from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.functions import tails
from tallywork.operators import charts, split
from tallywork.operators.numeric import numeric_hints, numeric_profile, stored_frequencies
from tallywork.operators.order import average_ranks
from tallywork.operators.selection import select_quantiles
from tallywork.sources.scratch import Store


def test_constant_column_has_no_shape(spark):
    df = spark.range(6).select(F.lit(0.1).alias("x"))
    profile = numeric_profile(df, ["x"])
    got = rows(profile)[0]
    assert (got["std"], got["skewness"], got["kurtosis"], got["mean"]) == (0.0, 0.0, 0.0, 0.1)
    assert rows(numeric_hints(profile))[0]["skew_label"] == "even"


def test_large_integers_stay_distinct(spark):
    df = spark.range(3).select((F.col("id") + F.lit(2**53)).alias("x"), (F.col("id") + F.lit(2**53)).cast("decimal(30,2)").alias("d"))
    assert [r["distinct_values"] for r in rows(numeric_profile(df, ["x", "d"]))] == [3, 3]


def test_charts_rank_levels_over_all_rows(spark):
    data = [("a", None)] * 5 + [("b", "y")] * 3 + [("c", "y")] * 2 + [("a", "n")]
    df = spark.createDataFrame(data, "c string, t string")
    assert {r["level"] for r in rows(charts.stacked_shares(df, ["c"], "t", top_n=1))} == {"a", "Other"}
    rates = rows(charts.positive_rate_bars(df, ["c"], "t", "y", top_n=2))
    assert [(r["level"], r["rate_rank"]) for r in rates] == [("Other", 1), ("b", 2), ("a", 3)] or [r["level"] for r in rates][-1] == "a"


def test_order_does_not_depend_on_plan_options(spark):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(997)) / 7).alias("x"))
    found = []
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            freq = stored_frequencies(df, ["x"])
            found.append((sorted((r["value"], r["rank"]) for r in rows(average_ranks(freq))), rows(select_quantiles(freq, {"m": 0.5}, weight="n"))))
    for option in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"):
        spark.conf.unset(option)
    assert all(f == found[0] for f in found)


def test_split_and_sample_cut_again_inside_a_bucket(spark, monkeypatch):
    df = spark.range(4000).selectExpr("id", "id % 3 AS c")
    usual = {r["id"]: r["split"] for r in rows(split.stratified_split(df, "c", ["id"]))}
    monkeypatch.setattr(split, "EDGE_ROWS", 20)
    monkeypatch.setattr(split, "BUCKET_DIGITS", 1)
    again = {r["id"]: r["split"] for r in rows(split.stratified_split(df, "c", ["id"]))}
    assert usual == again and sum(s == "test" for s in usual.values()) == 800
    expected = [r["id"] for r in df.orderBy(split.order_hash(["id"], 42)).limit(50).collect()]
    assert sorted(r["id"] for r in rows(split.fixed_sample(df, ["id"], 50))) == sorted(expected)
    assert split.fixed_sample(df.limit(7), ["id"], 50).count() == 7


@pytest.mark.parametrize("dof", [10.0**k for k in range(2, 13, 2)])
def test_student_tail_nears_the_normal_one(dof):
    normal = math.erfc(2 / math.sqrt(2))
    assert tails.t_tail(2.0, dof) == pytest.approx(normal, rel=10 / dof + 1e-9)


def test_a_fraction_that_does_not_settle_is_an_error(monkeypatch):
    monkeypatch.setattr(tails, "_MAX_TERMS", 3)
    with pytest.raises(ArithmeticError):
        tails.chi2_tail(60_000.0, 50_000.0)


def test_store_is_cleared(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.keep(spark.range(3), "x").count() == 3
    store.clear()
    assert not list(tmp_path.iterdir())


def test_scans_fail_on_unreadable_numbers(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T

    from tallywork.sources.delimited import read_lenient, read_strict, require_readable

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for name, lines in {"good": "1, x\n?, NA\n", "bad": "1, x\nabc, y\n"}.items():
        (tmp_path / name).write_text(lines)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert read_strict(spark, str(tmp_path / "good"), schema, na_words=("?", "NA")).count() == 1
        with pytest.raises(PySparkException):
            read_strict(spark, str(tmp_path / "bad"), schema, na_words=("?", "NA")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert require_readable(read_lenient(spark, str(tmp_path / "good"), schema, failures="f"), "f").columns == ["a", "b"]
    with pytest.raises(ValueError, match="1 values"):
        require_readable(read_lenient(spark, str(tmp_path / "bad"), schema, failures="f"), "f")


def test_duplicate_count_tells_nulls_apart(spark):
    from tallywork.operators.clean import duplicate_count

    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), (None, None), ("a", "a")], "x string, y string")
    assert rows(duplicate_count(df))[0]["duplicate_rows"] == 1
