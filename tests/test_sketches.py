"""Stored sketches against exact counts and ranks."""

from __future__ import annotations

import numpy as np
from conftest import rows

from tallywork.operators import sketches


def test_sketches_merge_within_their_errors(spark, tmp_path):
    rng = np.random.default_rng(9)
    days = rng.choice(["d1", "d2", "d3"], 30_000)
    x = np.where(rng.random(30_000) < 0.3, 0.0, rng.normal(size=30_000))
    k = rng.integers(0, 4_000, 30_000)
    data = [(str(d), float(a), int(b)) for d, a, b in zip(days, x, k, strict=True)] + [(None, 1.0, 1), ("d1", None, None), ("d2", float("nan"), None)]
    df = spark.createDataFrame(data, "day string, x double, k long")
    path = f"file://{tmp_path}/sketches"
    sketches.add_parts(df.where("day <> 'd3'"), ["x", "k"], "day", path)
    sketches.add_parts(df.where("day = 'd2'").limit(10), ["x", "k"], "day", path)  # a wrong part, replaced by the next call
    sketches.add_parts(df.where("day IN ('d2', 'd3')"), ["x", "k"], "day", path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    for parts in (None, ["d1"], ["d2", "d3"]):
        inside = np.isin(days, parts) if parts else np.full(len(days), True)
        for name, r in rows(sketches.merge_sketches(stored, parts=parts), "column").items():
            exact = {"x": x, "k": k}[name][inside].astype(float)
            distinct = len(np.unique(exact))
            assert r["n"] == len(exact)
            assert abs(r["distinct_values"] - distinct) <= sketches.DISTINCT_ERROR * distinct
            for quantile, p in sketches.QUARTILES.items():
                low, high = (exact < r[quantile]).mean(), (exact <= r[quantile]).mean()
                assert low - sketches.RANK_ERROR <= p <= high + sketches.RANK_ERROR, (name, quantile)
