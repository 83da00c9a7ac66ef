from __future__ import annotations

import math
import random

import pandas as pd
import pytest

from conftest import rows
from pyspark.sql import functions as F
from tallywork.operators import correlation, evaluate, split, ttest


def test_pearson_and_spearman_against_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2, 2, 3, 9, 50], "y": [3.0, 1, 4, 1, 5, 9], "c": [7.0] * 6})
    df = spark.createDataFrame(pdf)
    pearson = rows(correlation.pearson_pairs(df, ["x", "y", "c"]), "column_a", "column_b")
    assert pearson["x", "y"]["r"] == pytest.approx(0.882336860)
    assert pearson["x", "c"]["r"] is None
    spearman = rows(correlation.spearman_pairs(df, ["x", "y"]))[0]
    assert spearman["r"] == pytest.approx(0.602941176)
    cells = rows(correlation.matrix_cells(correlation.pearson_pairs(df, ["x", "y", "c"])), "column_a", "column_b")
    assert cells["x", "x"]["r"] == 1.0 and cells["c", "c"]["r"] is None


def test_spearman_is_pairwise_complete(spark):
    rng = random.Random(5)
    pdf = pd.DataFrame({c: [float(rng.randrange(12)) for _ in range(200)] for c in "abc"})
    pdf.loc[::7, "a"] = None
    pdf.loc[::5, "b"] = None
    expected = pdf.corr("spearman")
    df = spark.createDataFrame(pdf)
    for (a, b), r in rows(correlation.spearman_pairs(df, ["a", "b", "c"]), "column_a", "column_b").items():
        assert r["r"] == pytest.approx(expected.loc[a, b], abs=1e-12)


def test_rank_join_beyond_broadcast(spark):
    """Hot and cold values take different ways; with broadcasts off both must still be whole."""
    rng = random.Random(8)
    pdf = pd.DataFrame(
        {"x": [0.0] * 700 + [rng.random() for _ in range(1600)], "y": [rng.gauss(0, 1) for _ in range(2300)]}
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(correlation.spearman_pairs(spark.createDataFrame(pdf), ["x", "y"]))[0]["r"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == pytest.approx(pdf.corr("spearman").loc["x", "y"], abs=1e-12)


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 9.0], [2.0, 2.5, 7.0, 8.0]
    df = spark.createDataFrame([("h", v) for v in a] + [("l", v) for v in b] + [(None, 1.0)], "g string, v double")
    got = rows(ttest.welch_t_tests(df, ["v"], "g", "h", "l"))[0]
    x, y = pd.Series(a), pd.Series(b)
    expected = (x.mean() - y.mean()) / math.sqrt(x.var() / 5 + y.var() / 4)
    assert got["t_statistic"] == pytest.approx(expected)
    assert got["cohens_d"] == pytest.approx((x.mean() - y.mean()) / math.sqrt((x.var() + y.var()) / 2))
    assert 0.5 < got["p_value"] < 0.8 and not got["is_significant"]
    constant = spark.createDataFrame([("h", 1.0), ("h", 1.0), ("l", 1.0), ("l", 1.0)], "g string, v double")
    assert rows(ttest.welch_t_tests(constant, ["v"], "g", "h", "l"))[0]["t_statistic"] is None


@pytest.mark.parametrize("n", [1, 7, 101, 1000])
def test_split_is_exact_disjoint_and_repeatable(spark, n):
    df = spark.range(n).selectExpr("id", "CASE WHEN id % 4 = 0 THEN 'p' ELSE 'q' END AS t")
    once = split.stratified_split(df, "t", ["id"])
    got = rows(once)
    assert len(got) == n == len({r["id"] for r in got})
    test = [r for r in got if r["split"] == "test"]
    assert len(test) == math.ceil(0.2 * n)
    again = split.stratified_split(df.repartition(3), "t", ["id"])
    assert {r["id"] for r in rows(again) if r["split"] == "test"} == {r["id"] for r in test}
    positive = sum(r["t"] == "p" for r in test)
    assert abs(positive - 0.2 * sum(r["t"] == "p" for r in got)) <= 1


def test_published_split_size(spark):
    df = spark.range(32_537).selectExpr("id", "CASE WHEN id < 7839 THEN 'p' ELSE 'q' END AS t")
    counts = rows(split.stratified_split(df, "t", ["id"]).groupBy("split").count(), "split")
    assert counts["test"]["count"] == 6_508


def test_split_without_a_key_hashes_the_row(spark):
    df = spark.range(40).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'p' END AS a", "'q' AS t")
    assert split.stratified_split(df, "t", []).where("split = 'test'").count() == 8


def test_fixed_sample(spark):
    df = spark.range(50)
    first = {r["id"] for r in rows(split.fixed_sample(df, ["id"], 10))}
    assert len(first) == 10 and first == {r["id"] for r in rows(split.fixed_sample(df.repartition(5), ["id"], 10))}
    assert split.fixed_sample(df, ["id"], 500).count() == 50


def predictions(spark, tp, fn, fp, tn):
    data = [(1, 1)] * tp + [(1, 0)] * fn + [(0, 1)] * fp + [(0, 0)] * tn
    return spark.createDataFrame(data, "label int, prediction int")


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        ((1348, 220, 1026, 3914), (0.808543, 0.567818, 0.859694, 0.683917)),
        ((1168, 400, 680, 4260), (0.834050, 0.632035, 0.744898, 0.683841)),
    ],
)
def test_published_metrics(spark, counts, expected):
    got = rows(evaluate.binary_metrics(predictions(spark, *counts)))[0]
    assert (got["accuracy"], got["precision"], got["recall"], got["f1_score"]) == pytest.approx(expected, abs=1e-6)


def test_metrics_without_positives(spark):
    got = rows(evaluate.binary_metrics(predictions(spark, 0, 0, 0, 3)))[0]
    assert (got["precision"], got["recall"], got["f1_score"]) == (0.0, 0.0, 0.0)
    assert {r["n"] for r in rows(evaluate.confusion(predictions(spark, 0, 0, 0, 3)))} == {0, 3}


@pytest.mark.parametrize("most", [1, 250_000])
def test_auc_against_brute_force(spark, most):
    rng = random.Random(11)
    data = [(int(rng.random() < 0.3), rng.randrange(40) / 40.0) for _ in range(500)]
    pos = [s for y, s in data if y]
    neg = [s for y, s in data if not y]
    expected = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "label int, score double")
    got = rows(evaluate.roc_auc(df, most=most))[0]["roc_auc"]
    assert got == pytest.approx(expected, abs=1e-12)
    flipped = rows(evaluate.roc_auc(df.selectExpr("label", "-score AS score"), most=most))[0]["roc_auc"]
    assert flipped == pytest.approx(1 - expected, abs=1e-12)


@pytest.mark.parametrize("most", [1, 250_000])
def test_roc_drop_collinear(spark, most):
    data = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]
    df = spark.createDataFrame(data, "label int, score double")
    assert len(rows(evaluate.roc_points(df, most=most))) == 7
    kept = rows(evaluate.roc_points(df, drop_collinear=True, most=most))
    assert sorted(r["threshold"] for r in kept if r["threshold"] is not None) == [0.4, 0.5, 0.7, 0.9]


def test_rows_of_a_hot_value_are_spread_when_ranks_are_joined(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    df = spark.range(20_000).select(
        (F.col("id") % 7).cast("double").alias("few"),
        F.when(F.col("id") % 16 == 0, F.col("id") / 3.0).otherwise(F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0)).alias("gain"),
    )
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ranked = correlation._rank_rows(df, ["few", "gain"])
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        plan = correlation._rank_rows(df, ["few"])._jdf.queryExecution().executedPlan().toString()
        got, expected = ranked.toPandas(), df.toPandas().rank()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and max(sizes) < 3_000  # 18,750 rows hold a zero
    assert "SortMergeJoin" not in plan  # a column of hot values alone moves no row
    for c in ("few", "gain"):
        assert sorted(got[c]) == sorted(expected[c])
