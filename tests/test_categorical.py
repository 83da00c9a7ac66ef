from __future__ import annotations

import pytest

from conftest import rows
from tallywork.operators import categorical, clean, contingency
from tallywork.operators.frequency import category_frequencies


def test_ties_modes_and_sparse(spark):
    data = [("b", "y")] * 2 + [("a", "n")] * 2 + [("c", "y")] + [(None, "y")]
    df = spark.createDataFrame(data, "c string, t string")
    freq = category_frequencies(df, ["c"], "t", "y")
    got = rows(categorical.categorical_columns(freq))[0]
    assert (got["mode_value"], got["distinct_values"], got["missing"], got["sparse_count"]) == ("a", 3, 1, 0)
    top = rows(categorical.value_counts(freq, 2), "category")
    assert set(top) == {"a", "b"}
    assert (top["b"]["pct"], top["b"]["positive_pct"]) == (40.0, 100.0)


def test_all_missing_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    got = rows(categorical.categorical_columns(category_frequencies(df, ["c"])))[0]
    assert (got["mode_value"], got["distinct_values"], got["missing"]) == (None, 0, 2)


def test_recode_caps_only_when_needed(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "a", "b", "b", "c", None]], "c string")
    capped = [r["c"] for r in rows(categorical.recode_top(df, "c", 2))]
    assert sorted(capped) == ["Other", "Other", "a", "a", "b", "b"]
    kept = [r["c"] for r in rows(categorical.recode_top(df, "c", 2, null_to_other=False))]
    assert kept.count(None) == 1 and kept.count("Other") == 1
    whole = [r["c"] for r in rows(categorical.recode_top(df, "c", 3))]
    assert whole.count(None) == 1 and "Other" not in whole
    assert categorical.rows_in_top(df, "c", 1).count() == 2


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.createDataFrame([("a",)], "c string")
    plan = categorical.top_levels(category_frequencies(df, ["c"]), 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def two_by_two(spark, a, b, c, d):
    data = [("x", "p")] * a + [("x", "q")] * b + [("y", "p")] * c + [("y", "q")] * d
    return spark.createDataFrame(data, "r string, l string")


def test_yates_only_for_one_degree_of_freedom(spark):
    got = rows(contingency.chi_square_tests(two_by_two(spark, 10, 20, 30, 15), ["r"], "l"))[0]
    assert got["chi2"] == pytest.approx(6.752232, abs=1e-6)
    assert got["dof"] == 1 and got["is_significant"]
    with_zero = rows(contingency.chi_square_tests(two_by_two(spark, 10, 0, 5, 5), ["r"], "l"))[0]
    assert with_zero["chi2"] == pytest.approx(4.266667, abs=1e-6)


def test_unobserved_cells_count(spark):
    data = [("a", "p")] * 6 + [("b", "q")] * 6 + [("c", "p")] * 4 + [("c", "q")] * 4
    df = spark.createDataFrame(data, "r string, l string")
    got = rows(contingency.chi_square_tests(df, ["r"], "l"))[0]
    assert got["chi2"] == pytest.approx(12.0) and got["dof"] == 2
    cells = rows(contingency.dense(contingency.crosstab(df, ["r"], "l")), "level", "label")
    assert cells["a", "q"]["n"] == 0 and cells["a", "q"]["expected"] == pytest.approx(3.0)


def test_degenerate_table(spark):
    df = spark.createDataFrame([("a", "p"), ("b", "p")], "r string, l string")
    got = rows(contingency.chi_square_tests(df, ["r"], "l"))[0]
    assert (got["chi2"], got["dof"], got["p_value"], got["cramers_v"]) == (0.0, 0, 1.0, 0.0)


def test_capping_rules_differ_between_test_and_chart(spark):
    data = [(f"v{i}", "p") for i in range(3)] + [("v0", "q"), (None, "q")]
    df = spark.createDataFrame(data, "r string, l string")
    test_cells = rows(contingency.crosstab(df, ["r"], "l", top_n=2))
    chart_cells = rows(contingency.crosstab(df, ["r"], "l", top_n=2, null_to_other=True))
    assert sum(r["n"] for r in test_cells) == 4
    assert sum(r["n"] for r in chart_cells) == 5
    assert sum(r["n"] for r in rows(contingency.crosstab(df, ["r"], "l", top_n=5, null_to_other=True))) == 4
    uncapped = rows(contingency.crosstab(df, ["r"], "l", top_n=2, uncapped=["r"]))
    assert {r["level"] for r in uncapped} == {"v0", "v1", "v2"}


def test_target_distribution_counts_missing_labels_in_the_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    got = rows(categorical.target_distribution(df, "t"), "category")
    assert (got["a"]["pct"], got["a"]["imbalance_ratio"]) == (50.0, 2.0)


def test_unexpected_values(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "t string")
    assert rows(clean.unexpected_values(df, "t", ["a"])) == [{"value": "z", "n": 1}]
