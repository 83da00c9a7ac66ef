"""Small expected cells, pairwise ranks, multiset digests, the quarantine scan, and tails in log space."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions import tails
from tallywork.operators import charts, contingency, correlation, multisets
from tallywork.sources import quarantine


def test_small_cells_without_a_grid(spark):
    draw = random.Random(2)
    data = [(draw.choice("ab"), draw.choice(["r", "r", "s", f"t{draw.randrange(60)}"]), draw.choice(["y", "y", "z", f"w{draw.randrange(30)}"])) for _ in range(700)]
    data += [("even", f"l{i % 5}", f"m{i % 4}") for i in range(100)]  # every expected count is 5 exactly
    df = spark.createDataFrame(data, "column string, level string, label string")
    cells = df.groupBy("column", "level", "label").agg(F.count(F.lit(1)).alias("n"))
    got = rows(contingency.small_cells(*contingency._margins(cells)), "column")
    frame = pd.DataFrame(data, columns=["column", "level", "label"])
    for name, part in frame.groupby("column"):
        a, b, n = part["level"].value_counts(), part["label"].value_counts(), len(part)
        assert got[name]["small_expected_cells"] == sum(Fraction(int(x) * int(y), n) < 5 for x in a for y in b), name
    assert got["even"]["small_expected_cells"] == 0


def test_pairwise_ranks_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.integers(0, 9, (400, 5)).astype(float), columns=list("abcde"))
    pdf["b"] += pdf["a"]
    for c in "cde":
        pdf.loc[rng.random(400) < 0.3, c] = np.nan
    pdf["e"] = pdf["e"].where(pdf["d"].isna())  # never present with d
    pdf["f"] = 2.5
    data = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in pdf.itertuples(index=False, name=None)]
    got = rows(correlation.spearman_pairs(spark.createDataFrame(data, ", ".join(f"{c} double" for c in pdf.columns)), list(pdf.columns)), "column_a", "column_b")
    expected = pdf.corr("spearman")
    assert len(got) == 15
    for (a, b), r in got.items():
        want = expected.loc[a, b]
        assert (r["r"] is None) if math.isnan(want) else r["r"] == pytest.approx(want, abs=1e-12), (a, b)


def test_multisets(spark):
    draw = random.Random(5)
    base = [(draw.randrange(50), draw.choice(["x", "y|", "1:z", None, ""])) for _ in range(500)]
    shape = "k long, v string"
    left, same = spark.createDataFrame(base, shape), spark.createDataFrame(random.Random(1).sample(base, len(base)), shape).repartition(3)
    assert all(r["matches"] for r in rows(multisets.compare_ranges(left, same, ["k", "v"])))
    assert rows(multisets.differing_rows(left, same, ["k", "v"])) == []
    other = base[1:] + [(base[0][0], "changed")] + [(7, None)]  # as many rows of one kind more as of another less
    right = spark.createDataFrame(other, shape)
    got = {(r["k"], r["v"]): (r["left_n"], r["right_n"]) for r in rows(multisets.differing_rows(left, right, ["k", "v"]))}
    expected = {}
    for row in {*base, *other}:
        n = base.count(row), other.count(row)
        if n[0] != n[1]:
            expected[row] = n
    assert got == expected
    ranges = rows(multisets.compare_ranges(left, right, ["k", "v"]))
    assert sum(not r["matches"] for r in ranges) in (1, 2, 3) and sum(r["right_rows"] - r["left_rows"] for r in ranges) == 1
    empty = left.where("k < 0")
    assert rows(multisets.compare_ranges(empty, empty, ["k", "v"])) == []
    assert sum(r["left_n"] for r in rows(multisets.differing_rows(left, empty, ["k", "v"]))) == 500


def test_quarantine_keeps_every_line(spark, tmp_path):
    lines = ["1, a, 2.5", "x, b, 2.5", "2, c", "", "   ", "?, d, many", " 3 , ?, ? ", "4, e, 1, 9", "5, f, 1e400"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("v-x", T.DoubleType())])
    good, rejected = quarantine.scan_with_rejects(spark, str(tmp_path / "in.csv"), schema, keys=["k"])
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", 2.5), (3, None, None), (5, "f", math.inf)], key=str)
    got = sorted((r["line"], r["column"], r["reason"]) for r in rejected.collect())
    assert got == sorted(
        [
            ("x, b, 2.5", "k", quarantine.UNREADABLE),
            ("2, c", "", quarantine.WRONG_COUNT),
            ("?, d, many", "v-x", quarantine.UNREADABLE),
            ("?, d, many", "k", quarantine.NO_KEY),
            ("4, e, 1, 9", "", quarantine.WRONG_COUNT),
        ]
    )
    assert all(r["file"].endswith("in.csv") for r in rejected.collect())


@pytest.mark.parametrize(("x", "dof"), [(0.5, 1), (3.0, 2), (80.0, 7), (900.0, 4), (5e5, 12)])
def test_log_chi_square_tail(x, dof):
    log_p, p = tails.log_chi2_tail(x, dof), tails.chi2_tail(x, dof)
    if p > 1e-280:
        assert math.exp(log_p) == pytest.approx(p, rel=1e-9)
    if dof % 2 == 0:
        terms = [i * math.log(x / 2) - math.lgamma(i + 1) for i in range(dof // 2)]
        top = max(terms)
        assert log_p == pytest.approx(top + math.log(sum(math.exp(v - top) for v in terms)) - x / 2, rel=1e-12)


@pytest.mark.parametrize(("t", "dof"), [(1.0, 1.0), (2.0, 30.0), (60.0, 12_000.0), (300.0, 50_000.0), (1e6, 3.0)])
def test_log_student_tail(t, dof):
    log_p = tails.log_t_tail(t, dof)
    assert log_p == tails.log_t_tail(-t, dof)
    # bounds of the tail: its density at t over the decay there
    density = tails.log_gamma_half_step(dof / 2) - 0.5 * math.log(dof * math.pi) - (dof + 1) / 2 * math.log1p(t * t / dof)
    above = math.log(2) + density + math.log((dof + t * t) / (t * dof))
    assert log_p <= min(0.0, above) + 1e-9 and log_p > above - math.log1p((dof + 2) / max(t * t, 1e-9)) - 1.0
    if dof == 1.0:
        assert math.exp(log_p) == pytest.approx(0.5)


def test_log_tails_of_nothing():
    assert tails.log_t_tail(0.0, 5.0) == 0.0 and tails.log_t_tail(math.inf, 5.0) == -math.inf and math.isnan(tails.log_t_tail(None, 5.0))
    assert tails.log_chi2_tail(0.0, 3) == 0.0 and tails.log_chi2_tail(3.0, 0) == 0.0


@pytest.mark.parametrize("grouped", [False, True])
def test_density_by_cells_against_the_plain_sum(spark, grouped):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(0, 1, 400), rng.normal(30, 0.01, 300), [1e4, -50.0], np.full(200, 2.0)])
    groups = rng.choice(["a", "b"], len(values)) if grouped else np.full(len(values), "all")
    data = [(float(v), str(g)) for v, g in zip(values, groups, strict=True)] + [(7.0, "lone"), (None, "a")] * grouped
    df = spark.createDataFrame(data, "x double, g string")
    got = rows(charts.density_curve(df, "x", "g" if grouped else None), "group", "point")
    xs = np.linspace(values.min(), values.max(), charts.GRID_POINTS)
    for g in np.unique(groups):
        own = values[groups == g]
        h = own.std(ddof=1) * len(own) ** -0.2
        plain = np.exp(-0.5 * ((xs[:, None] - own[None, :]) / h) ** 2).sum(axis=1) / (len(own) * h * math.sqrt(2 * math.pi))
        assert [got[g, p]["density"] for p in range(len(xs))] == pytest.approx(plain.tolist(), abs=1e-13)
        assert [got[g, p]["x"] for p in range(len(xs))] == pytest.approx(xs.tolist())
    assert {k[0] for k in got} == set(groups)  # a group of one value has no bandwidth
