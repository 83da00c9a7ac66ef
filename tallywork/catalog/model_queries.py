"""Preprocessing statistics, training, comparison, persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import Tables, long_sql, query, r, rounded
from tallywork.catalog.refit_sql import LAST, REFIT_SQL
from tallywork.catalog.split_queries import SPLIT_SQL, census_split
from tallywork.functions.columns import recode, unpivot_columns
from tallywork.modeling import features, training
from tallywork.modeling.certificate import logistic_certificate
from tallywork.operators import evaluate
from tallywork.sources import sinks
from tallywork.sources.scratch import materialize, new_path

NUM = SPEC.model_numeric
CAT = SPEC.model_categorical
TRAIN_SQL = f"{SPLIT_SQL}, train AS (SELECT * FROM split_rows WHERE split = 'train'), test AS (SELECT * FROM split_rows WHERE split = 'test')"


def _train(t: Tables) -> DataFrame:
    columns = list(dict.fromkeys([*SPEC.key, "price", *NUM, *CAT, "income"]))
    stored = materialize(census_split(t).select(*columns, "split"), "split", partition_by=("split",))
    return stored.where(F.col("split") == "train")


@query(
    "fit_medians",
    f"""{TRAIN_SQL}, long AS ({long_sql(NUM, source="train")})
    SELECT "column", {r("quantile_cont(value, 0.5)")} AS median FROM long GROUP BY "column" """,
)
def _(t: Tables) -> DataFrame:
    return rounded(features.median_table(_train(t), NUM))


_MODE_SQL = f"""long AS ({long_sql(CAT, source="train", kind="VARCHAR", value="category")}),
    freq AS (SELECT "column", category, count(*) AS n FROM long WHERE category IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, category) AS place FROM freq),
    modes AS (SELECT "column", category AS mode_value FROM ranked WHERE place = 1)"""


@query("fit_modes", f"""{TRAIN_SQL}, {_MODE_SQL} SELECT "column", mode_value FROM modes""")
def _(t: Tables) -> DataFrame:
    return features.mode_table(_train(t), CAT)


_SCALE_SQL = f"""nums AS ({long_sql(NUM, source="train")}),
    scales AS (SELECT "column", avg(value) AS mean, CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0E0 END AS scale
               FROM nums GROUP BY "column")"""


@query("fit_scaler", f"""{TRAIN_SQL}, {_SCALE_SQL} SELECT "column", {r("mean")} AS mean, {r("scale")} AS scale FROM scales""")
def _(t: Tables) -> DataFrame:
    return rounded(features.scale_table(_train(t), NUM))


@query(
    "class_weights",
    f"""{TRAIN_SQL}, c AS (SELECT CASE income WHEN '>50K' THEN 1 ELSE 0 END AS label, count(*) AS n FROM train GROUP BY income)
    SELECT label, n, {r("CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n)")} AS weight FROM c""",
)
def _(t: Tables) -> DataFrame:
    labelled = _train(t).withColumn("label", recode(F.col("income"), SPEC.target_mapping))
    return rounded(features.class_weight_table(labelled))


_VOCAB_SQL = f"""{_MODE_SQL},
    vocab AS (SELECT "column", category, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS slot
              FROM (SELECT DISTINCT "column", category FROM freq) x)"""


def _fitted(t: Tables):
    """Preprocessing fitted on the stored train rows, and the stored table."""
    table = training.model_table(t.census, SPEC, stored=False)
    train = table.where(F.col("split") == "train")
    return Pipeline(stages=features.preprocessing_stages(NUM, CAT)).fit(train), table


@query("onehot_vocab", f"""{TRAIN_SQL}, {_VOCAB_SQL} SELECT "column", category, slot FROM vocab""")
def _(t: Tables) -> DataFrame:
    model, table = _fitted(t)
    indexer = next(s for s in model.stages if s.hasParam("stringOrderType"))
    # The fitted vocabulary as a lookup over the train rows' own categories.
    train = table.where(F.col("split") == "train")
    seen = unpivot_columns(train, CAT, "string", "category").where("category IS NOT NULL").distinct()
    slots = F.lit(None).cast("bigint")
    for name, labels in zip(CAT, indexer.labelsArray):
        found = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("category")) - 1
        slots = F.when(F.col("column") == name, found).otherwise(slots)
    return seen.select("column", "category", slots.cast("bigint").alias("slot"))


@query(
    "transform_features",
    f"""{TRAIN_SQL}, {_SCALE_SQL}, {_VOCAB_SQL},
    med AS (SELECT "column", quantile_cont(value, 0.5) AS m FROM nums GROUP BY "column"),
    tnum AS ({long_sql(NUM, "h", source="test")}),
    tcat AS ({long_sql(CAT, "h", source="test", kind="VARCHAR", value="category")})
    SELECT h, tnum."column", {r("(coalesce(value, m) - mean) / scale")} AS value
    FROM tnum JOIN scales ON tnum."column" = scales."column" JOIN med ON med."column" = tnum."column"
    UNION ALL
    SELECT h, tcat."column", CAST(coalesce(slot, -1) AS DOUBLE)
    FROM tcat JOIN modes ON tcat."column" = modes."column"
    LEFT JOIN vocab ON vocab."column" = tcat."column" AND vocab.category = coalesce(tcat.category, mode_value)""",
)
def _(t: Tables) -> DataFrame:
    model, table = _fitted(t)
    out = model.transform(table.where(F.col("split") == "test"))
    hot = {c: F.array_position(vector_to_array(f"{c}__onehot"), 1.0) for c in CAT}
    wide = out.select(
        "h", *[F.col(f"{c}__scaled").alias(c) for c in NUM],
        *[F.when(p > 0, p - 1).otherwise(-1).cast("double").alias(c) for c, p in hot.items()],
    )
    return rounded(unpivot_columns(wide, [*NUM, *CAT], "double", "value", ids=["h"]))


def _trained(t: Tables, name: str) -> training.TrainedModel:
    table = training.model_table(t.census, SPEC, stored=False)
    if name == training.FOREST:
        return training.train_forest(table, SPEC)
    rows = table.where(F.col("split") == "train").count()
    return training.train_and_evaluate(name, training.logistic(rows), table, SPEC)


def _checked(trained: training.TrainedModel) -> DataFrame:
    """``model, test_rows, positives, metrics_agree, beats_chance`` of a trained model.

    A fit has no SQL twin, what it claims has: which rows were scored, and that its metrics are those
    of the stored scores, computed anew from rows, and better than guessing.
    """
    hit, said, truth = F.col("prediction") == F.col("label"), F.col("prediction") == 1, F.col("label") == 1
    anew = trained.scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(truth).alias("positives"),
        F.avg(hit.cast("double")).alias("a"),
        (F.count_if(said & truth) / F.count_if(said)).alias("p"),
        (F.count_if(said & truth) / F.count_if(truth)).alias("q"),
    )
    both = anew.join(F.broadcast(trained.metrics))  # one row each
    pairs = [("accuracy", F.col("a")), ("precision", F.col("p")), ("recall", F.col("q")), ("f1_score", 2 * F.col("p") * F.col("q") / (F.col("p") + F.col("q")))]
    agree = F.lit(True)
    for name, value in pairs:
        agree = agree & (F.abs(F.col(name) - value) < 1e-9)
    return both.select("model", "test_rows", "positives", agree.alias("metrics_agree"), (F.col("roc_auc") > 0.6).alias("beats_chance"))


def _checked_sql(*names: str) -> str:
    models = ", ".join(f"('{n}')" for n in names)
    return f"""{TRAIN_SQL} SELECT model, count(*) AS test_rows, count(*) FILTER (WHERE income = '>50K') AS positives,
      true AS metrics_agree, true AS beats_chance FROM test, (VALUES {models}) AS m(model) GROUP BY model"""


# The twin fits anew: metrics of the optimum that the SQL finds.
TALLY_SQL = """count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn"""
AREA_SQL = """SELECT (sum(CASE WHEN label = 1 THEN place END) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0E0)
      / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS area
    FROM (SELECT label, avg(at_row) OVER (PARTITION BY level) AS place FROM (
      SELECT label, round(margin, 9) AS level, row_number() OVER (ORDER BY round(margin, 9)) AS at_row FROM scored) AS levels) AS places"""


@query(
    "logistic_fit_eval",
    f"""{REFIT_SQL}, tally AS (SELECT {TALLY_SQL} FROM scored), area AS ({AREA_SQL})
    SELECT '{training.LOGISTIC}' AS model, n AS test_rows, tp + fn AS positives, {r("(tp + tn) / CAST(n AS DOUBLE)")} AS accuracy,
      {r("tp / CAST(tp + fp AS DOUBLE)")} AS "precision", {r("tp / CAST(tp + fn AS DOUBLE)")} AS recall,
      {r("2.0E0 * tp / (2 * tp + fp + fn)")} AS f1_score, {r("area", 5)} AS roc_auc FROM tally, area""",
)
def _(t: Tables) -> DataFrame:
    trained = _trained(t, training.LOGISTIC)
    tests = trained.scored.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("label") == 1).alias("positives"))
    both = tests.crossJoin(F.broadcast(trained.metrics))  # one row each
    return rounded(both.select("model", "test_rows", "positives", "accuracy", "precision", "recall", "f1_score", "roc_auc"), roc_auc=5)


@query(
    "logistic_certificate",
    f"""{REFIT_SQL} SELECT feature, {r("b", 2)} AS coefficient, {r("g / (SELECT count(*) FROM train)")} AS gradient
    FROM b{LAST} JOIN names USING (j) JOIN g{LAST - 1} USING (j)""",
)
def _(t: Tables) -> DataFrame:
    """Coefficients and the gradient of the objective at them, which vanishes at the optimum."""
    table = training.model_table(t.census, SPEC, stored=False)
    rows = table.where(F.col("split") == "train").count()
    trained = training.train_and_evaluate(training.LOGISTIC, training.logistic(rows), table, SPEC)
    found = rounded(logistic_certificate(trained, table, SPEC), coefficient=2)
    return found.select("feature", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("coefficient", "gradient")])  # no -0.0


@query("forest_fit_eval", _checked_sql(training.FOREST))
def _(t: Tables) -> DataFrame:
    return _checked(_trained(t, training.FOREST))


@query(
    "model_compare",
    f"""{REFIT_SQL}, tally AS (SELECT {TALLY_SQL} FROM scored)
    SELECT model, n AS test_rows, tp + fn AS positives, true AS metrics_agree, true AS beats_chance, true AS rule_holds,
      CASE WHEN model = '{training.LOGISTIC}' THEN {r("2.0E0 * tp / (2 * tp + fp + fn)")} END AS logistic_f1
    FROM tally, (VALUES ('{training.LOGISTIC}'), ('{training.FOREST}')) AS m(model)""",
)
def _(t: Tables) -> DataFrame:
    """Both models, and whether the choice follows the rule on their metrics; the logistic F1 is the refit's."""
    _compared, chosen, models = training.compare_models(training.model_table(t.census, SPEC, stored=False), SPEC)
    picked = chosen.first()
    better = training.FOREST if picked["forest_f1"] > picked["logistic_f1"] else training.LOGISTIC
    close = abs(picked["forest_f1"] - picked["logistic_f1"]) < SPEC.tie_margin
    holds = picked["chosen"] == (training.LOGISTIC if close else better) and (picked["reason"] == "within_margin") == close
    both = [_checked(m) for m in models.values()]
    f1 = F.when(F.col("model") == training.LOGISTIC, F.round(F.lit(picked["logistic_f1"]), 6))
    return both[0].unionByName(both[1]).withColumns({"rule_holds": F.lit(holds), "logistic_f1": f1})


@query(
    "model_group_performance",
    f"""{REFIT_SQL}, tally AS (SELECT {SPEC.group} AS "group", {TALLY_SQL} FROM scored WHERE {SPEC.group} IS NOT NULL GROUP BY {SPEC.group})
    SELECT "group", n, {r("(tp + tn) / CAST(n AS DOUBLE)")} AS accuracy, {r("2.0E0 * tp / (2 * tp + fp + fn)")} AS f1_score,
      {r("(tp + fp) / CAST(n AS DOUBLE)")} AS positive_pred_ratio FROM tally""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.group_performance(_trained(t, training.LOGISTIC).scored, SPEC.group))


@query("model_roundtrip", f"{TRAIN_SQL} SELECT h, true AS same FROM test ORDER BY h LIMIT 5")
def _(t: Tables) -> DataFrame:
    trained = _trained(t, training.LOGISTIC)
    rows = trained.scored.drop("prediction", "score")
    return training.verify_saved(trained.model, rows, SPEC.key, new_path(t.spark, "model")).select("h", "same")


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(
    "model_metadata",
    f"""{TRAIN_SQL} SELECT {_listed(NUM)} AS numeric, {_listed(CAT)} AS categorical, {_listed(SPEC.excluded)} AS excluded_columns,
      0 AS code_negative, 1 AS code_positive, true AS reason_follows, true AS saved, count(*) > 0 AS has_rows,
      {r("1.0E0 / count(*)", 12)} AS penalty, 0.0E0 AS lasso_share, 1000 AS most_iterations, 'weight' AS weighted_by FROM train""",
)
def _(t: Tables) -> DataFrame:
    """The written metadata, read back; the reason is the one the comparison gave."""
    table = training.model_table(t.census, SPEC, stored=False)
    _compared, chosen, models = training.compare_models(table, SPEC)
    picked = chosen.first()
    final = models[picked["chosen"]]
    described = training.model_metadata(t.spark, final.model, final.name, SPEC, picked["reason"])
    back = t.spark.read.json(sinks.write_json(described, new_path(t.spark, "metadata")))
    logistic = training.model_metadata(t.spark, models[training.LOGISTIC].model, training.LOGISTIC, SPEC, "described")
    params = t.spark.read.json(sinks.write_json(logistic, new_path(t.spark, "metadata"))).select(F.from_json("model_params", "regParam double, elasticNetParam double, maxIter int, weightCol string").alias("p"))
    kept = {c: params.select(f"p.{c}").scalar() for c in ("regParam", "elasticNetParam", "maxIter", "weightCol")}
    follows = (F.col("model_name") == picked["chosen"]) & (F.col("selection_reason") == picked["reason"])
    return back.select(
        "input_features.numeric", "input_features.categorical", "excluded_columns",
        F.col("target_mapping")[SPEC.negative].cast("int").alias("code_negative"),
        F.col("target_mapping")[SPEC.positive].cast("int").alias("code_positive"),
        follows.alias("reason_follows"), F.to_timestamp("saved_at").isNotNull().alias("saved"),
        F.lit(not table.isEmpty()).alias("has_rows"),
        F.round(kept["regParam"], 12).alias("penalty"), kept["elasticNetParam"].alias("lasso_share"),
        kept["maxIter"].alias("most_iterations"), kept["weightCol"].alias("weighted_by"),
    )
