from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import rows
from tallywork.catalog.census import SPEC as CENSUS
from tallywork.modeling import features, training
from tallywork.modeling.certificate import logistic_certificate
from tallywork.plans.analysis import analyze, report
from tallywork.sources.scratch import new_path
from tallywork.spec import AnalysisSpec

SPEC = AnalysisSpec(
    numeric=("x", "z"), categorical=("c", "g"), target="t", positive="yes", negative="no",
    key_missing=("c",), group="g", test_values=("x",), test_categories=("c",), share_categories=("c",),
    rate_categories=("c",), histogram_by_target=("x",), histogram=("z",), box_by_target=("x",), box_log=("z",),
    scatter=("x", "z"), forest_trees=5, forest_depth=4,
)


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(1)
    data = []
    for i in range(400):
        x = rng.gauss(0, 1)
        c = rng.choice(["a", "b", "c", None])
        yes = x + (c == "a") + rng.gauss(0, 0.5) > 0.8
        data.append((i, x, float(rng.randrange(20)), c, rng.choice("mf"), "yes" if yes else "no"))
    return spark.createDataFrame(data, "id long, x double, z double, c string, g string, t string").cache()


def test_preprocessing_learns_from_train_only(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "a"), (9.0, None)], "n double, c string")
    test = spark.createDataFrame([(None, None), (1.0, "unseen")], "n double, c string")
    model = Pipeline(stages=features.preprocessing_stages(["n"], ["c"])).fit(train)
    model.write().overwrite().save(str(tmp_path / "model"))
    for fitted in (model, PipelineModel.load(str(tmp_path / "model"))):
        got = [r["v"] for r in rows(fitted.transform(test).select(vector_to_array("features").alias("v")))]
        scale = (((1 - 4) ** 2 + (2 - 4) ** 2 + 0 + (9 - 4) ** 2) / 4) ** 0.5
        assert got[0] == pytest.approx([(3.0 - 4.0) / scale, 1.0, 0.0])
        assert got[1] == pytest.approx([(1.0 - 4.0) / scale, 0.0, 0.0])


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    table = rows(features.class_weight_table(df), "label")
    assert (table[1]["weight"], table[0]["weight"]) == pytest.approx((2.0, 2 / 3))
    attached = features.with_class_weight(df).agg(F.sum("weight").alias("w")).first()["w"]
    assert attached == pytest.approx(4.0)


@pytest.mark.parametrize(
    ("logistic", "forest", "chosen", "reason"),
    [
        (0.683917, 0.683841, training.LOGISTIC, "within_margin"),
        (0.60, 0.65, training.FOREST, "forest_higher"),
        (0.65, 0.60, training.LOGISTIC, "logistic_not_lower"),
    ],
)
def test_selection_rule(spark, logistic, forest, chosen, reason):
    table = spark.createDataFrame(
        [(training.LOGISTIC, logistic), (training.FOREST, forest)], "model string, f1_score double"
    )
    got = rows(training.selection(table))[0]
    assert (got["chosen"], got["reason"]) == (chosen, reason)


def test_whole_analysis(spark, people):
    done = analyze(people, SPEC)
    for name, table in done.results.items():
        assert table.limit(1).count() == 1 or name == "unexpected_labels", name
    comparison = rows(done.results["model_comparison"], "model")
    assert comparison[training.LOGISTIC]["roc_auc"] > 0.8
    assert all(r["same"] for r in rows(done.results["saved_check"]))
    sections = {r["section"] for r in rows(report(done.results).select("section").distinct())}
    assert {"target", "numeric_profile", "chi_square", "model_comparison", "group_performance"} <= sections
    described = rows(done.results["model_metadata"])[0]
    assert described["target_mapping"] == {"no": 0, "yes": 1}


def test_certificate_tells_an_optimum(spark, people):
    keyed = AnalysisSpec(**{**SPEC.__dict__, "key": ("id",)})
    table = training.model_table(people, keyed)
    n = table.where("split = 'train'").count()
    fitted = training.train_and_evaluate(training.LOGISTIC, training.logistic(n), table, keyed)
    found = rows(logistic_certificate(fitted, table, keyed), "feature")
    assert set(found) == {"intercept", "x", "z", "c=a", "c=b", "c=c", "g=f", "g=m"}
    assert max(abs(r["gradient"]) for r in found.values()) < 1e-7
    # a fit stopped early has the gradient that a plain sum over its train rows gives
    early = training.train_and_evaluate(training.LOGISTIC, training.logistic(n).setMaxIter(2), table, keyed)
    said = [r["gradient"] for r in logistic_certificate(early, table, keyed).collect()]
    train = features.with_class_weight(table.where("split = 'train'"))
    data = early.model.transform(train).select(vector_to_array("features").alias("f"), "label", "weight").collect()
    x, y, w = (np.array([r[c] for r in data], float) for c in ("f", "label", "weight"))
    last = early.model.stages[-1]
    b = last.coefficients.toArray()
    pull = w * (1 / (1 + np.exp(-(x @ b + last.intercept))) - y)
    assert said == pytest.approx([pull.sum() / n, *((x.T @ pull + b) / n)], abs=1e-12) and max(map(abs, said)) > 1e-4


def test_passes_of_a_fit_read_only_its_rows(spark, people, monkeypatch):
    few = AnalysisSpec(**{**SPEC.__dict__, "key": ("id",), "forest_rows": 100, "forest_trees": 2})
    table = training.model_table(people, few)
    kept, keep = {}, training.materialize
    monkeypatch.setattr(training, "materialize", lambda df, label, *a, **b: kept.setdefault(label, keep(df, label, *a, **b)))
    trained = training.train_forest(table, few)
    asked = training.fit_sample(table.where("split = 'train'"), 100)
    assert 50 < asked.count() < 150 and rows(kept["fit-rows"], "id") == rows(asked, "id")
    assert trained.metrics is kept["metrics"] and rows(trained.metrics)[0]["n"] == 80
    training.verify_saved(trained.model, trained.scored.drop("prediction", "score"), ["row_id"], new_path(spark, "model"))
    assert kept["checked-rows"].count() == 5


def test_model_table_keeps_what_follows_from_the_key_out_of_its_files(spark, people, monkeypatch):
    keyed = AnalysisSpec(**{**SPEC.__dict__, "key": ("id",)})
    kept, keep = {}, training.materialize
    monkeypatch.setattr(training, "materialize", lambda df, label, *a, **b: kept.setdefault(label, keep(df, label, *a, **b)))
    stored, computed = training.model_table(people, keyed), training.model_table(people, keyed, stored=False)
    assert "row_id" not in kept["split"].columns and set(kept["labelled"].columns) == {"id", "x", "z", "c", "g", "label"}
    assert stored.columns == computed.columns == ["id", "x", "z", "c", "g", "row_id", "label", "split"]
    assert rows(stored, "id") == rows(computed, "id")
    assert {r["row_id"] for r in rows(stored)} == {r["row_id"] for r in rows(people.select(training.order_hash(["id"], 42).alias("row_id")))}


def test_compared_models_are_fitted_on_all_train_rows(people, monkeypatch):
    assert CENSUS.forest_rows is None
    few = AnalysisSpec(**{**SPEC.__dict__, "key": ("id",), "forest_rows": 100, "forest_trees": 2})
    table = training.model_table(people, few)
    fitted_on, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: (fitted_on.append(df.count()), fit(self, df, *a))[1])
    _compared, _chosen, models = training.compare_models(table, few)
    assert fitted_on == [320, 320] and set(models) == {training.LOGISTIC, training.FOREST}
    assert models[training.FOREST].model.stages[-1].getOrDefault("cacheNodeIds")
