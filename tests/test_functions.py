from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallywork.functions import numeric, tails, text


@pytest.mark.parametrize(
    ("t", "dof", "expected"), [(2.228, 10, 0.050012), (0.0, 7, 1.0), (1.0, 1, 0.5), (1.96, 1e9, 0.0499958)]
)
def test_student_tail(t, dof, expected):
    assert tails.t_tail(t, dof) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    ("x", "dof", "expected"),
    [(8.035714285714286, 1, 0.004586392), (18.307, 10, 0.0500006), (3.0, 4, math.exp(-1.5) * 2.5), (5.0, 0, 1.0)],
)
def test_chi_square_tail(x, dof, expected):
    assert tails.chi2_tail(x, dof) == pytest.approx(expected, abs=1e-6)


def test_text_clean_up(spark):
    df = spark.createDataFrame([("\tX ",), ("　 Y\xa0",), (">50K.. ",), ("?",), (None,)], "s string")
    got = rows(
        df.select(
            text.strip(F.col("s")).alias("stripped"),
            text.clean_label(F.col("s")).alias("label"),
            text.sentinel_to_null(F.col("s"), ["?"]).alias("known"),
        )
    )
    assert [r["stripped"] for r in got] == ["X", "Y", ">50K..", "?", None]
    assert [r["label"] for r in got] == ["X", "Y", ">50K", "?", None]
    assert [r["known"] for r in got] == ["\tX ", "　 Y\xa0", ">50K.. ", None, None]


def test_half_even_and_ratio(spark):
    df = spark.createDataFrame([(2.125, 0.0)], "a double, b double")
    got = rows(df.select(numeric.half_even(F.col("a"), 2).alias("r"), numeric.ratio(F.col("a"), F.col("b")).alias("q")))
    assert got == [{"r": 2.12, "q": 0.0}]
