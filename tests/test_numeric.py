from __future__ import annotations

import random

import pandas as pd
import pytest

from conftest import rows
from tallywork.operators import charts, numeric
from tallywork.operators.frequency import numeric_frequencies
from tallywork.operators.order import average_ranks, cumulate
from tallywork.operators.selection import select_quantiles


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_known_profile(spark):
    got = rows(numeric.numeric_profile(frame(spark, [1.0, 2.0, 2.0, 3.0, 9.0, 50.0, None, float("nan")]), ["x"]))[0]
    assert got["skewness"] == pytest.approx(2.334301687)
    assert got["kurtosis"] == pytest.approx(5.517307126)
    assert (got["q1"], got["median"], got["q3"]) == (2.0, 2.5, 7.5)
    assert (got["count"], got["missing"], got["distinct_values"], got["outlier_candidates"]) == (6, 2, 5, 1)
    direct = rows(numeric.moments(frame(spark, [1.0, 2.0, 2.0, 3.0, 9.0, 50.0]), ["x"]))[0]
    assert direct["skewness"] == pytest.approx(got["skewness"]) and direct["std"] == pytest.approx(got["std"])


def test_constant_single_and_missing_columns(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None), (5.0, None), (5.0, None)], "c double, m double")
    got = rows(numeric.numeric_profile(df, ["c", "m"]), "column")
    assert (got["c"]["std"], got["c"]["skewness"], got["c"]["kurtosis"]) == (0.0, 0.0, 0.0)
    assert (got["m"]["median"], got["m"]["missing_pct"], got["m"]["mean"], got["m"]["distinct_values"]) == (
        None, 100.0, None, 0,
    )
    one = rows(numeric.numeric_profile(frame(spark, [3.0]), ["x"]))[0]
    assert (one["std"], one["skewness"], one["kurtosis"], one["median"]) == (None, None, None, 3.0)


def test_empty_table(spark):
    empty = frame(spark, [1.0]).where("x > 1")
    assert rows(numeric.moments(empty, ["x"]))[0]["count"] == 0
    assert rows(numeric.numeric_profile(empty, ["x"])) == []


@pytest.mark.parametrize("most", [1, 40, 250_000])
def test_order_statistics_against_pandas(spark, most):
    rng = random.Random(most)
    values = [0.0] * 400 + [rng.choice([rng.gauss(0, 1), float(rng.randrange(9))]) for _ in range(900)]
    series = pd.Series(values)
    freq = numeric_frequencies(frame(spark, values), ["x"])
    wanted = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.933, "e": 1.0}
    got = rows(select_quantiles(freq, wanted, weight="n"))[0]
    for name, p in wanted.items():
        assert got[name] == pytest.approx(series.quantile(p), abs=1e-12)
    ranks = {r["value"]: r["rank"] for r in rows(average_ranks(freq, most=most))}
    expected = dict(zip(values, series.rank()))
    assert ranks == pytest.approx(expected)
    assert all(r["n_total"] == 1300 for r in rows(cumulate(freq, most=most)))


def test_by_group_drops_missing_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), (None, 9.0)], "g string, x double")
    got = rows(numeric.numeric_by_group(df, ["x"], "g"), "group")
    assert {k: (v["mean"], v["median"]) for k, v in got.items()} == {"a": (2.5, 2.5), "b": (2.0, 2.0)}


def test_histogram_counts_everything_once(spark):
    values = [float(v) for v in range(100)] + [1000.0]
    got = rows(charts.histogram(frame(spark, values), "x"))
    assert sum(r["n"] for r in got) == 101
    assert any(r["n"] == 0 for r in got)
    constant = rows(charts.histogram(frame(spark, [2.0, 2.0]), "x"))
    assert [(r["bin_low"], r["bin_high"], r["n"]) for r in constant] == [(1.5, 2.5, 2)]


def test_density_integrates_to_the_mass_in_range(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(800)]
    got = sorted(rows(charts.density_curve(frame(spark, values), "x")), key=lambda r: r["point"])
    gap = got[1]["x"] - got[0]["x"]
    assert sum(r["density"] for r in got) * gap == pytest.approx(1.0, abs=0.02)


def test_box_whiskers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, x double")
    got = rows(charts.box_stats(df, "x", "g"))[0]
    assert (got["whisker_low"], got["whisker_high"], got["fliers"]) == (1.0, 5.0, 1)
