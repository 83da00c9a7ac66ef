"""Exact quantiles by selection on order-preserving keys."""

from __future__ import annotations

import math
import random
import struct

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.operators import selection
from tallywork.operators.selection import order_key, select_quantiles

EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, -1.0]
EXTREMES += [math.nextafter(2.0**e, d) for e in (-1022, -1000, -60, -1, 0, 1, 2, 3, 29, 31, 52, 53, 62, 63, 64, 1000, 1023) for d in (-math.inf, math.inf)]
EXTREMES += [2.0**e for e in range(-1074, 1024, 3)]


def test_keys_are_the_bits_of_the_number(spark):
    draw = random.Random(1)
    values = EXTREMES + [struct.unpack("d", draw.randbytes(8))[0] for _ in range(4000)] + [draw.gauss(0, 1e3) for _ in range(2000)]
    values = [v for v in values if not math.isnan(v)] + [math.inf, -math.inf]
    found = spark.createDataFrame([(v,) for v in values], "x double").select("x", order_key(F.col("x")).alias("k")).collect()
    for r in found:
        bits = struct.unpack("q", struct.pack("d", abs(r["x"])))[0]
        assert r["k"] == (-bits if r["x"] < 0 else bits), r


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_against_pandas(spark, seed):
    draw = random.Random(seed)
    near = [1.0 + draw.randrange(200) * 2.0**-52 for _ in range(500)]  # told apart by the last bits only
    data = {
        "near": near,
        "hot": [7.5] * 700 + [draw.gauss(0, 1) for _ in range(300)],
        "wide": [draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(400)],
        "one": [3.25],
        "two": [-2.0, 5.0],
    }
    wanted = {"min": 0.0, "q1": 0.25, "median": 0.5, "p933": 0.933, "max": 1.0}
    long = [(c, v) for c, values in data.items() for v in values] + [("near", None), ("gone", None)]
    df = spark.createDataFrame(long, "column string, value double")
    got = rows(select_quantiles(df, wanted), "column")
    counted = df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    assert rows(select_quantiles(counted, wanted, weight="n"), "column") == got and set(got) == set(data)
    for c, values in data.items():
        ordered = sorted(values)
        for name, p in wanted.items():
            place = (len(ordered) - 1) * p
            low, high = ordered[math.floor(place)], ordered[min(math.floor(place) + 1, len(ordered) - 1)]
            assert got[c][name] == low + (high - low) * (place - math.floor(place)), (c, name)


def test_quantiles_by_group(spark):
    draw = random.Random(4)
    data = [(draw.choice(["a", "b", None, "c"]), "x", draw.choice([draw.gauss(0, 1), 2.0, None])) for _ in range(900)]
    got = rows(select_quantiles(spark.createDataFrame(data, "g string, column string, value double"), {"m": 0.3}, by=("g",)), "g")
    frame = pd.DataFrame(data, columns=["g", "column", "value"]).dropna()
    expected = frame.groupby("g")["value"].quantile(0.3)
    assert {g: r["m"] for g, r in got.items()} == pytest.approx(expected.to_dict(), abs=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([("x", None)], "column string, value double")
    assert rows(select_quantiles(empty, {"m": 0.5})) == []


def test_bins_are_few_whatever_the_number_of_values(spark):
    df = spark.range(200_000).select(F.lit("x").alias("column"), (F.col("id") / 7.0).alias("value"))
    assert rows(select_quantiles(df, {"m": 0.5}))[0]["m"] == pytest.approx(199_999 / 2 / 7.0)
    keyed = df.withColumn("__key", order_key(F.col("value")))
    assert selection._bins(keyed, ["column"], 64 - selection.BITS[0], F.lit(1)).count() < 20_000  # 1024 for each power of two


def test_keys_as_a_column_are_the_same(spark):
    draw = random.Random(2)
    values = EXTREMES + [struct.unpack("d", draw.randbytes(8))[0] for _ in range(2000)] + [math.inf, -math.inf, None]
    df = spark.createDataFrame([(v,) for v in values if v is None or not math.isnan(v)], "value double")
    found = selection.with_order_key(df)
    assert found.columns == ["value", "__key"] and not found.schema["__key"].nullable
    assert found.count() == df.count() - 1
    assert found.where(~F.col("__key").eqNullSafe(order_key(F.col("value")))).isEmpty()


@pytest.mark.parametrize("by", [(), ("g",)])
def test_a_pass_computes_a_key_once_per_row(spark, monkeypatch, by):
    plans, keep = [], selection.materialize
    monkeypatch.setattr(selection, "materialize", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, *a))
    df = spark.range(5000).select(F.lit("x").alias("column"), (F.col("id") % 2).alias("g"), (1 + F.col("id") / 1e9).alias("value"))
    select_quantiles(df, {"m": 0.5}, by=by).collect()
    assert len(plans) > 1 and {p.upper().count("LOG2(") for p in plans} == {1}
