"""Classifier evaluation as plain aggregation over label, prediction and score columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.functions.numeric import ratio
from tallywork.operators.order import cumulate
from tallywork.sources.scratch import materialize


def _outcome_counts(label: Column, prediction: Column) -> dict[str, Column]:
    def tally(a: int, p: int) -> Column:
        return F.count_if((label == a) & (prediction == p))

    return {"tp": tally(1, 1), "fn": tally(1, 0), "fp": tally(0, 1), "tn": tally(0, 0)}


def _outcomes(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    counts = _outcome_counts(col(label), col(prediction))
    return df.groupBy(*[col(b) for b in by]).agg(*[c.alias(name) for name, c in counts.items()])


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Four cells ``actual, predicted, n`` (1 = positive), zeros included."""
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(name).alias("n"))
        for name, a, p in (("tp", 1, 1), ("fn", 1, 0), ("fp", 0, 1), ("tn", 0, 0))
    ]
    return _outcomes(df, label, prediction).select(F.inline(F.array(*cells)))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``n, accuracy, precision, recall, f1_score`` for the positive class (0 on 0/0)."""
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    n = tp + fn + fp + tn
    return _outcomes(df, label, prediction).select(
        n.alias("n"),
        ratio(tp + tn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1_score"),
    )


def class_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction",
    names: tuple[str, str] = ("0", "1"),
) -> DataFrame:
    """``class, precision, recall, f1_score, support`` for both classes, accuracy, macro and
    weighted averages."""
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    one = _outcomes(df, label, prediction).select(
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"), _f1(tp, fp, fn).alias("f1"),
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"), _f1(tn, fn, fp).alias("f0"),
        (tp + fn).alias("s1"), (tn + fp).alias("s0"), ratio(tp + tn, tp + fn + fp + tn).alias("acc"),
    )
    total = F.col("s0") + F.col("s1")

    def row(name: str, parts: Sequence[Column], support: Column) -> Column:
        p, r, f = parts
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
            support.alias("support"),
        )

    macro = [(F.col(f"{m}0") + F.col(f"{m}1")) / 2 for m in "prf"]
    weighted = [
        ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total) for m in "prf"
    ]
    return one.select(
        F.inline(
            F.array(
                row(names[0], [F.col(f"{m}0") for m in "prf"], F.col("s0")),
                row(names[1], [F.col(f"{m}1") for m in "prf"], F.col("s1")),
                row("accuracy", [F.col("acc")] * 3, total),
                row("macro avg", macro, total),
                row("weighted avg", weighted, total),
            )
        )
    )


def group_performance(
    df: DataFrame, group: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``group, n, accuracy, f1_score, positive_pred_ratio`` in one grouped pass."""
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    n = tp + fn + fp + tn
    return _outcomes(df.where(col(group).isNotNull()), label, prediction, by=(group,)).select(
        col(group).cast("string").alias("group"),
        n.alias("n"),
        ratio(tp + tn, n).alias("accuracy"),
        _f1(tp, fp, fn).alias("f1_score"),
        ratio(tp + fp, n).alias("positive_pred_ratio"),
    )


def _score_table(df: DataFrame, label: str, score: str, most: int | None) -> DataFrame:
    """One row per distinct score with class counts and running class counts."""
    counts = (
        df.select(F.lit("score").alias("column"), col(score).cast("double").alias("value"), col(label).alias("__y"))
        .where(F.col("value").isNotNull() & F.col("__y").isNotNull())
        .groupBy("column", "value")
        .agg(F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") == 0).alias("neg"))
    )
    return cumulate(materialize(counts, "score-counts"), measures=("pos", "neg"), most=most)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", most: int | None = None) -> DataFrame:
    """``positives, negatives, roc_auc``: exact, tied scores count one half."""
    table = _score_table(df, label, score, most)
    # Positives weigh the share of negatives ranked below them (ties half).
    share = (F.col("neg_before") + F.col("neg") / F.lit(2.0)) / F.col("neg_total")
    return table.agg(
        F.max("pos_total").alias("positives"),
        F.max("neg_total").alias("negatives"),
        F.when(
            (F.max("neg_total") > 0) & (F.max("pos_total") > 0),
            F.try_divide(
                F.sum(F.when(F.col("neg_total") > 0, F.col("pos") * share)), F.max("pos_total").cast("double")
            ),
        ).alias("roc_auc"),
    )


def roc_points(
    df: DataFrame, label: str = "label", score: str = "score",
    drop_collinear: bool = False, most: int | None = None,
) -> DataFrame:
    """``threshold, fpr, tpr`` by descending score, starting at (0, 0) with a NULL threshold.

    ``drop_collinear`` leaves out points in the middle of a straight run (equal class counts as
    the next lower score), which changes nothing about the curve.
    """
    table = _score_table(df, label, score, most)
    if drop_collinear:
        inside = Window.partitionBy("column", "bucket").orderBy("value")
        step = F.struct("pos", "neg")
        table = table.withColumn("__lower", F.lag(step).over(inside))
        # The next lower score may sit in an earlier bucket; its last row is that bucket's edge.
        edges = table.groupBy("column", "bucket").agg(F.max_by(step, F.col("value")).alias("__edge"))
        across = Window.partitionBy("column").orderBy("bucket")  # one row per bucket
        edges = edges.select("column", "bucket", F.lag("__edge").over(across).alias("__edge"))
        table = table.join(edges, ["column", "bucket"])
        lower = F.coalesce("__lower", "__edge")
        first = (F.col("pos_before") + F.col("pos") == F.col("pos_total")) & (
            F.col("neg_before") + F.col("neg") == F.col("neg_total")
        )
        bend = (lower["pos"] != F.col("pos")) | (lower["neg"] != F.col("neg"))
        table = table.where(first | lower.isNull() | bend)
    points = table.select(
        F.col("value").alias("threshold"),
        ratio(F.col("neg_total") - F.col("neg_before"), F.col("neg_total"), None).alias("fpr"),
        ratio(F.col("pos_total") - F.col("pos_before"), F.col("pos_total"), None).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)
