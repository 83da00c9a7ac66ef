"""A run that is taken up again, its end products, and checks before it starts."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from conftest import rows
from test_models import SPEC as PEOPLE

from tallywork.operators import quality
from tallywork.plans import run as plan
from tallywork.plans.analysis import report
from tallywork.spec import AnalysisSpec

SPEC = AnalysisSpec(**{**PEOPLE.__dict__, "key": ("id",)})
SHAPE = "id long, x double, z double, c string, g string, t string"


def people(n=160):
    draw = random.Random(4)
    for i in range(n):
        x, c = draw.gauss(0, 1), draw.choice(["a", "b", None])
        yield (i, x, float(draw.randrange(9)), c, draw.choice("mf"), "yes" if x + (c == "a") + draw.gauss(0, 0.5) > 0.5 else "no")


def test_run_is_taken_up_after_a_failure(spark, tmp_path, monkeypatch):
    data = list(people())
    raw, out = spark.createDataFrame(data, SHAPE), f"file://{tmp_path}/out"
    real = plan.analyze

    def stops(*args, **options):
        if options.get("charts_too", True) is False and options.get("models", True):
            raise RuntimeError("an executor is lost for good")
        return real(*args, **options)

    monkeypatch.setattr(plan, "analyze", stops)
    with pytest.raises(RuntimeError, match="lost"):
        plan.run_analysis(raw, SPEC, out, charts=False)
    calls = []

    def counts(*args, **options):
        calls.append(options)
        return real(*args, **options)

    monkeypatch.setattr(plan, "analyze", counts)
    tables, manifest = plan.run_analysis(raw, SPEC, out, charts=False)
    assert len(calls) == 1 and calls[0].get("models", True)  # what was finished is not built again
    stages = {r["stage"] for r in rows(manifest.contents())}
    assert {"cleaned", "cleaned_csv", "results", "models", "report", "model_metadata_json", "numeric_profile"} <= stages
    folder = Path(manifest.folder.removeprefix("file://"))
    described = json.loads(next((folder / "files/model_metadata_json").glob("*.json")).read_text())
    assert described["model_name"] in ("LogisticRegression", "RandomForest") and json.loads(described["model_params"])
    assert spark.read.csv(f"{manifest.folder}/files/cleaned_csv", header=True).count() == len(data)
    assert {r["section"] for r in rows(tables["report"].select("section").distinct())} >= {"data", "clean_counts", "model_selection", "group_performance"}
    calls.clear()
    again, _ = plan.run_analysis(raw.repartition(3), SPEC, out, charts=False)  # the same rows in another order
    assert calls == [] and again.keys() == tables.keys()


def test_fingerprint_follows_rows_and_spec(spark):
    data = list(people(50))
    raw = spark.createDataFrame(data, SHAPE)
    name = plan.input_fingerprint(raw, SPEC)
    assert name == plan.input_fingerprint(spark.createDataFrame(data[::-1], SHAPE).repartition(4), SPEC)
    changed = [*data[:-1], (*data[-1][:3], "changed", *data[-1][4:])]
    assert name != plan.input_fingerprint(spark.createDataFrame(changed, SHAPE), SPEC)
    assert name != plan.input_fingerprint(spark.createDataFrame([*data, data[0]], SHAPE), SPEC)
    assert name != plan.input_fingerprint(raw, AnalysisSpec(**{**SPEC.__dict__, "alpha": 0.01}))


def test_run_checks_its_columns(spark, tmp_path):
    raw = spark.createDataFrame(list(people(5)), SHAPE)
    with pytest.raises(KeyError, match="missing columns"):
        plan.run_analysis(raw.drop("z"), SPEC, f"file://{tmp_path}/a")
    with pytest.raises(TypeError, match="not numeric"):
        plan.run_analysis(raw.selectExpr("id", "string(x) AS x", "z", "c", "g", "t"), SPEC, f"file://{tmp_path}/b")


def test_report_tells_of_absent_sections(spark):
    only = {"target": spark.createDataFrame([("yes", 2)], "category string, n long")}
    assert [r["metric"] for r in rows(report(only, ["target"]))] == ["n"]
    with pytest.raises(KeyError, match="model_comparison"):
        report(only)


def test_overview_has_types_and_preview(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 1.5), (3, None, 2.5)], "k long, s string, v double")
    got = {(r["part"], r["item"], r["metric"]): (r["number"], r["text"]) for r in rows(quality.overview_report(df, ["k"], ["s"], n=2))}
    assert got["types", "s", "type"] == (1.0, "string") and got["facts", "table", "rows"] == (3.0, None)
    assert {k[1:]: v for k, v in got.items() if k[0] == "preview"} == {
        ("1", "k"): (1.0, None), ("1", "s"): (None, "a"), ("1", "v"): (1.5, None), ("2", "k"): (2.0, None), ("2", "s"): (None, "b")
    }
