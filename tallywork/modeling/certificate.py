"""Proof of a logistic fit: coefficients with the gradient of the objective at them.

The objective, 1/2 |w|^2 + sum of class-weighted losses with a free intercept, is strictly convex in its
weights, so a fit is right exactly when its gradient vanishes. That takes one aggregate over the
train rows and no second fit.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.modeling.features import with_class_weight
from tallywork.modeling.training import TrainedModel
from tallywork.spec import AnalysisSpec


def feature_names(trained: TrainedModel, spec: AnalysisSpec) -> list[str]:
    """Names of the feature vector's slots: numeric columns, then ``column=category``."""
    indexer = next((s for s in trained.model.stages if s.hasParam("stringOrderType")), None)
    labels = indexer.labelsArray if indexer else []
    return [*spec.model_numeric, *[f"{c}={word}" for c, words in zip(spec.model_categorical, labels, strict=True) for word in words]]


def logistic_certificate(trained: TrainedModel, table: DataFrame, spec: AnalysisSpec) -> DataFrame:
    """``feature, coefficient, gradient``, the intercept included; ``gradient`` is per train row.

    ``table`` is the split table that the model was trained on. Losses pull up where the label is 0 and
    down where it is 1, so two weighted vector sums, one per label, make up the gradient: two rows as long as
    the feature vector reach the driver, where the coefficients are already.
    """
    train = with_class_weight(table.where(F.col("split") == "train"))
    scored = trained.model.transform(train)
    pull = F.col("weight") * F.abs(vector_to_array("probability").getItem(1) - F.col("label"))
    sums = scored.select("label", "features", pull.alias("pull")).groupBy("label").agg(
        Summarizer.metrics("sum").summary(col("features"), F.col("pull")).alias("s"), F.sum("pull").alias("pull"), F.count(F.lit(1)).alias("n")
    )
    by_label = {r["label"]: r for r in sums.select("label", vector_to_array("s.sum").alias("s"), "pull", "n").collect()}
    names, last = feature_names(trained, spec), trained.model.stages[-1]
    rows = max(1, sum(r["n"] for r in by_label.values()))
    total = [0.0] * (len(names) + 1)
    for label, sign in ((0, 1.0), (1, -1.0)):
        if label in by_label:
            for i, part in enumerate([by_label[label]["pull"], *by_label[label]["s"]]):
                total[i] += sign * part
    weights = [float(w) for w in last.coefficients.toArray()]
    out = [("intercept", float(last.intercept), total[0] / rows)]
    out += [(name, w, (g + w) / rows) for name, w, g in zip(names, weights, total[1:], strict=True)]
    return table.sparkSession.createDataFrame(out, "feature string, coefficient double, gradient double")
