"""Train, compare, evaluate, save and describe classifiers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.columns import col, recode
from tallywork.modeling.features import preprocessing_stages, with_class_weight
from tallywork.operators.clean import first_rows
from tallywork.operators.evaluate import binary_metrics, roc_auc
from tallywork.operators.split import order_hash, stratified_split
from tallywork.sources.scratch import materialize
from tallywork.spec import AnalysisSpec

LOGISTIC = "LogisticRegression"
FOREST = "RandomForest"


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline, its scored test rows and its one-row metrics table."""

    name: str
    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame


def logistic(train_rows: int) -> LogisticRegression:
    """L2-penalised logistic regression with balanced weights.

    The public objective is 1/2 |w|^2 + C * sum of weighted losses with C = 1. Spark divides the
    losses by the weight total, which for balanced weights is the number of rows, so the penalty
    is 1 / rows. Features are scaled by the pipeline already.
    """
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / max(train_rows, 1),
        elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-9,
    )


def forest(trees: int = 100, depth: int = 30, bins: int = 256, seed: int = 42) -> RandomForestClassifier:
    """Balanced random forest: 100 trees grown as deep as Spark allows unless told otherwise, with up
    to ``bins`` candidate cuts per numeric feature.

    The node of every row and tree is kept between passes: else each pass sends all trees to the tasks and walks them
    from the root, which is most of the work on deep trees. The fitted forest is the same.
    """
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed,
        featureSubsetStrategy="sqrt", maxMemoryInMB=1024, cacheNodeIds=True,
    )


def model_table(df: DataFrame, spec: AnalysisSpec, extra: Sequence[str] = (), stored: bool = True) -> DataFrame:
    """Feature columns, the 0/1 ``label``, the row key and a ``row_id`` (hash of the key, or of all
    columns when the spec names no key), split into train and test.

    Rows whose target is not one of the two labels are left out. The result is a stored table
    partitioned by ``split``, so both models read the same rows and each side is pruned to its
    own files; a ``row_id`` that follows from the stored key is not stored beside it. ``stored`` tells whether ``df`` is
    a scan: rows that are dear to compute are stored here, in the columns that are needed, before the split passes over them.
    """
    needed = dict.fromkeys([*spec.key, *spec.model_numeric, *spec.model_categorical, *extra, spec.target])
    row_id = order_hash(spec.key or df.columns, spec.seed).alias("row_id")
    own = [] if spec.key else [row_id]
    labelled = df.select(*[col(c) for c in needed], *own)
    labelled = labelled.withColumn("label", recode(col(spec.target), spec.target_mapping))
    labelled = labelled.where(F.col("label").isNotNull()).drop(spec.target)
    if not stored:
        labelled = materialize(labelled, "labelled")
    split = stratified_split(labelled, "label", spec.key or ("row_id",), spec.test_size, spec.seed)
    kept = materialize(split, "split", partition_by=("split",))
    features = [col(c) for c in needed if c != spec.target]
    return kept.select(*features, row_id if spec.key else col("row_id"), "label", "split")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``prediction`` (0/1 at threshold 0.5) and ``score`` (positive probability)."""
    scored = model.transform(rows)
    keep = [col(c) for c in rows.columns]
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").getItem(1).alias("score"),
    )


def _forest_of(spec: AnalysisSpec) -> RandomForestClassifier:
    return forest(spec.forest_trees, spec.forest_depth, spec.forest_bins, spec.seed)


def train_forest(table: DataFrame, spec: AnalysisSpec) -> TrainedModel:
    return train_and_evaluate(FOREST, _forest_of(spec), table, spec, spec.forest_rows)


def fit_sample(train: DataFrame, rows: int | None) -> DataFrame:
    """About ``rows`` of the train rows, chosen by a hash of ``row_id``; all of them for None."""
    if rows is None:
        return train
    share = rows / max(1, train.count())
    place = F.shiftrightunsigned(F.xxhash64("row_id"), 32) / F.lit(float(1 << 32))
    return train if share >= 1 else train.where(place < share)


def train_and_evaluate(name: str, classifier, table: DataFrame, spec: AnalysisSpec, fit_rows: int | None = None) -> TrainedModel:
    """Fit on the train rows (about ``fit_rows`` of them when given), score all test rows, compute the metrics.

    Where a part of the train rows is fitted on, it is stored first: the many passes of a fit do not look for it in all of them.
    """
    every = table.where(F.col("split") == "train")
    train = fit_sample(every, fit_rows)
    train = with_class_weight(train if train is every else materialize(train, "fit-rows"))
    test = table.where(F.col("split") == "test")
    stages = preprocessing_stages(spec.model_numeric, spec.model_categorical)
    model = Pipeline(stages=[*stages, classifier]).fit(train)
    scored = materialize(score(model, test), "scored")
    metrics = _with_auc(scored)
    # One stored row: its users do not rank the scores again.
    return TrainedModel(name, model, scored, materialize(metrics.select(F.lit(name).alias("model"), *metrics.columns), "metrics"))


def _with_auc(scored: DataFrame) -> DataFrame:
    area = roc_auc(scored).select("roc_auc").scalar()
    return binary_metrics(scored).withColumn("roc_auc", area)


def comparison(models: Sequence[TrainedModel]) -> DataFrame:
    """``model, accuracy, precision, recall, f1_score, roc_auc``, one row per model."""
    out = None
    for m in models:
        row = m.metrics.select("model", "accuracy", "precision", "recall", "f1_score", "roc_auc")
        out = row if out is None else out.unionByName(row)
    return out


def selection(table: DataFrame, margin: float = 0.01) -> DataFrame:
    """``chosen, reason, f1_gap, logistic_f1, forest_f1`` from a comparison table.

    Within ``margin`` the logistic model wins because it is easier to explain; beyond it the
    higher F1 wins.
    """
    f1 = table.agg(
        F.max(F.when(F.col("model") == LOGISTIC, F.col("f1_score"))).alias("logistic_f1"),
        F.max(F.when(F.col("model") == FOREST, F.col("f1_score"))).alias("forest_f1"),
    )
    gap = F.abs(F.col("logistic_f1") - F.col("forest_f1"))
    close = gap < margin
    ahead = F.col("forest_f1") > F.col("logistic_f1")
    return f1.select(
        F.when(~close & ahead, F.lit(FOREST)).otherwise(F.lit(LOGISTIC)).alias("chosen"),
        F.when(close, F.lit("within_margin")).when(ahead, F.lit("forest_higher")).otherwise(
            F.lit("logistic_not_lower")
        ).alias("reason"),
        gap.alias("f1_gap"),
        "logistic_f1",
        "forest_f1",
    )


def compare_models(
    table: DataFrame, spec: AnalysisSpec
) -> tuple[DataFrame, DataFrame, dict[str, TrainedModel]]:
    """Train both classifiers on all rows of the same split: (comparison, selection, models by name)."""
    train_rows = table.where(F.col("split") == "train").count()
    models = {
        LOGISTIC: train_and_evaluate(LOGISTIC, logistic(train_rows), table, spec),
        FOREST: train_and_evaluate(FOREST, _forest_of(spec), table, spec),
    }
    # Two stored rows: later uses of the tables do not recompute the metrics.
    compared = materialize(comparison(list(models.values())), "comparison")
    return compared, selection(compared, spec.tie_margin), models


def model_parameters(model: PipelineModel) -> dict:
    """Simple hyper-parameters of the last stage."""
    stage = model.stages[-1]
    simple = (str, int, float, bool, type(None))
    values = {p.name: v for p, v in stage.extractParamMap().items()}
    return {k: v for k, v in sorted(values.items()) if isinstance(v, simple)}


def model_metadata(spark: SparkSession, model: PipelineModel, name: str, spec: AnalysisSpec, reason: str) -> DataFrame:
    """One row describing a fitted model, ready for a JSON sink."""
    words = json.dumps(model_parameters(model), sort_keys=True)
    return spark.range(1).select(
        F.lit(name).alias("model_name"),
        F.struct(
            F.array(*[F.lit(c) for c in spec.model_numeric]).alias("numeric"),
            F.array(*[F.lit(c) for c in spec.model_categorical]).alias("categorical"),
        ).alias("input_features"),
        F.array(*[F.lit(c) for c in spec.excluded]).cast("array<string>").alias("excluded_columns"),
        F.create_map(*[F.lit(x) for pair in spec.target_mapping.items() for x in pair]).alias("target_mapping"),
        F.lit(words).alias("model_params"),
        F.lit(reason).alias("selection_reason"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("saved_at"),
    )


def verify_saved(model: PipelineModel, rows: DataFrame, key: Sequence[str], path: str, n: int = 5) -> DataFrame:
    """Save, reload, and compare predictions on ``n`` rows; raises ``ValueError`` on a difference.

    Returns the compared rows: key, ``before``, ``after``, ``same``.
    """
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    sample = materialize(first_rows(rows, key, n), "checked-rows")  # looked for once
    before = score(model, sample).select(*[col(k) for k in key], F.col("prediction").alias("before"))
    after = score(loaded, sample).select(*[col(k) for k in key], F.col("prediction").alias("after"))
    compared = before.join(after, list(key)).withColumn("same", F.coalesce(F.col("before") == F.col("after"), F.lit(False)))
    if compared.where("same").count() != sample.count():
        raise ValueError("the reloaded model predicts differently")
    return compared
