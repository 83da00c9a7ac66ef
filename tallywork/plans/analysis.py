"""The whole analysis of one table from one spec.

The cleaned table and the two frequency tables are stored once; every result below them is a
lazy DataFrame over those stores. Only model fits and stores run eagerly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col, indicator
from tallywork.modeling import training
from tallywork.operators import (
    categorical,
    charts,
    clean,
    contingency,
    correlation,
    evaluate,
    numeric,
    quality,
    ttest,
)
from tallywork.operators.frequency import numeric_frequencies
from tallywork.sources.scratch import materialize, new_path
from tallywork.sources.sinks import to_tidy
from tallywork.spec import AnalysisSpec

# Columns that identify a row of each result that goes into the report.
REPORT_KEYS: dict[str, list[str]] = {
    "data": ["item", "metric_name"],
    "clean_counts": [],
    "target": ["category"],
    "numeric_profile": ["column"],
    "numeric_by_target": ["group", "column"],
    "categorical_columns": ["column"],
    "categories": ["column", "category"],
    "top_pairs": ["column_a", "column_b"],
    "t_tests": ["column"],
    "chi_square": ["column"],
    "model_comparison": ["model"],
    "model_selection": [],
    "group_performance": ["group"],
}


@dataclass(frozen=True)
class Analysis:
    """All result tables by name, the cleaned table, and the fitted models."""

    cleaned: DataFrame
    results: dict[str, DataFrame]
    models: dict[str, training.TrainedModel] = field(default_factory=dict)


def analyze(
    raw: DataFrame,
    spec: AnalysisSpec,
    models: bool = True,
    charts_too: bool = True,
    cleaned: DataFrame | None = None,
    all_read: bool = False,
    stored_raw: bool = False,
) -> Analysis:
    """Clean, profile, test, and (optionally) chart and model one table; ``cleaned`` is its cleaned form where that is stored already.

    ``stored_raw`` tells whether ``raw`` is a scan: then rows that occur once are not moved to find the copies, and a table that
    is clean already is not stored again.

    With ``all_read`` the small tables that other results derive from are stored at once, for a caller who reads every result
    in a job of its own.
    """
    target, positive, negative = spec.target, spec.positive, spec.negative
    if cleaned is None:
        found = clean.clean_scan(raw, target, spec.numeric, as_is=True) if stored_raw else clean.clean(raw, target, spec.numeric)
        cleaned = raw if found is raw else materialize(found, "cleaned", packed=True)
    # One scan gives the counts per target, rows without one included; leaving the target out of the key gives the rest.
    stored = materialize(
        numeric_frequencies(cleaned, spec.numeric, by=(target,), keep_missing=True, exact=True, keep_ungrouped=True),
        "numeric-frequencies",
    )
    freq = stored.groupBy("column", "value", "exact").agg(F.sum("n").alias("n"))
    by_target = stored.where(col(target).isNotNull() & F.col("value").isNotNull()).select(col(target), "column", "value", "n")
    # One scan counts (column, category, label); frequencies, tests and charts of categories all derive from that.
    named = dict.fromkeys([*spec.categorical, *spec.test_categories, *spec.share_categories, *spec.rate_categories])
    pairs = materialize(contingency.label_frequencies(cleaned, list(named), target, unlabelled=True), "label-frequencies")
    label = F.col("label").cast(cleaned.schema[target].dataType)
    hits = F.when(indicator(label, positive) == 1, F.col("n")).otherwise(0)
    own = pairs.where(F.col("column").isin(*spec.categorical))
    categories = own.groupBy("column", "category").agg(F.sum("n").alias("n"), F.sum(hits).alias("positive_n"))
    categories = materialize(categories, "category-frequencies")

    def kept(table: DataFrame, label: str) -> DataFrame:
        return materialize(table, label) if all_read else table

    copies = kept(clean.duplicate_count(raw), "copies")
    pearson = kept(correlation.pearson_pairs(cleaned, spec.numeric), "pearson")
    spearman = kept(correlation.spearman_pairs(cleaned, spec.numeric, stored), "spearman")
    profile = kept(numeric.numeric_profile(cleaned, spec.numeric, freq, stored), "profile")
    results = {
        "data": quality.overview(raw, spec.key_missing, copies).withColumnRenamed("metric", "metric_name"),
        "types": quality.column_types(cleaned),
        "clean_counts": clean.clean_counts(raw, target, cleaned, copies),
        "unexpected_labels": clean.unexpected_values(cleaned, target, [positive, negative]),
        "ranges": quality.ranges(cleaned, spec.numeric),
        "missing_after_cleaning": quality.missing(cleaned),
        "target": categorical.target_distribution(cleaned, target),
        "numeric_profile": profile,
        "numeric_hints": numeric.numeric_hints(profile),
        "numeric_by_target": numeric.numeric_by_group(cleaned, spec.numeric, target, by_target),
        "categorical_columns": categorical.categorical_columns(categories, spec.sparse_share),
        "categories": categorical.value_counts(categories, spec.top_n),
        "pearson": pearson,
        "spearman": spearman,
        "rank_gap": correlation.largest_gap(pearson, spearman),
        "top_pairs": correlation.top_pairs(pearson),
        "target_correlation": correlation.target_correlation(cleaned, spec.numeric, target, positive),
        "t_tests": ttest.welch_t_tests(cleaned, spec.test_values, target, positive, negative, spec.alpha),
        "chi_square": contingency.chi_square_tests(
            cleaned, spec.test_categories, target, spec.top_n, spec.alpha, pairs
        ),
    }
    if charts_too:
        results |= _charts(cleaned, spec, pearson, stored, pairs)
    fitted: dict[str, training.TrainedModel] = {}
    if models:
        extra, fitted = model_results(cleaned, spec)
        results |= extra
    return Analysis(cleaned, results, fitted)


def _charts(cleaned: DataFrame, spec: AnalysisSpec, pearson: DataFrame, counted: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """Charts of the cleaned rows, from the stored counts of values (of the numeric columns) and of categories."""
    target = spec.target

    def values(name: str, group: str | None = None) -> DataFrame | None:
        return charts.counted_values(counted, name, group) if name in spec.numeric else None

    out = {
        "chart_classes": charts.class_bars(cleaned, target),
        "chart_heatmap": correlation.matrix_cells(pearson),
    }
    if spec.share_categories:
        out["chart_shares"] = charts.stacked_shares(
            cleaned, spec.share_categories, target, spec.top_n, spec.uncapped, pairs
        )
    if spec.rate_categories:
        out["chart_rates"] = charts.positive_rate_bars(
            cleaned, spec.rate_categories, target, spec.positive, spec.top_n, pairs
        )
    if spec.box_log:
        out["chart_log_boxes"] = charts.log_box_stats(cleaned, spec.box_log, counted if set(spec.box_log) <= set(spec.numeric) else None)
    if spec.scatter:
        columns = list(dict.fromkeys([*spec.scatter, target]))
        out["chart_scatter"] = charts.scatter_points(cleaned, columns, spec.key, spec.sample_size, spec.seed)
    for name in spec.histogram_by_target:
        out[f"chart_histogram_{name}"] = charts.histogram(cleaned, name, target, values(name, target))
        out[f"chart_density_{name}"] = charts.density_curve(cleaned, name, target, values=values(name, target))
    for name in spec.histogram:
        out[f"chart_histogram_{name}"] = charts.histogram(cleaned, name, values=values(name))
        out[f"chart_density_{name}"] = charts.density_curve(cleaned, name, values=values(name))
    for name in spec.box_by_target:
        out[f"chart_boxes_{name}"] = charts.box_stats(cleaned, name, target, values(name, target))
    return out


def model_results(cleaned: DataFrame, spec: AnalysisSpec, stored: bool = True) -> tuple[dict[str, DataFrame], dict]:
    """Result tables of the model part, and the fitted models by name; ``stored`` tells whether ``cleaned`` is a scan."""
    table = training.model_table(cleaned, spec, stored=stored)
    compared, chosen, models = training.compare_models(table, spec)
    picked = chosen.first()
    final = models[picked["chosen"]]
    out = {
        "model_comparison": compared,
        "model_selection": chosen,
        "confusion": evaluate.confusion(final.scored),
        "class_report": evaluate.class_report(final.scored, names=(spec.negative, spec.positive)),
        "roc_points": evaluate.roc_points(final.scored, drop_collinear=True),
        "model_metadata": training.model_metadata(cleaned.sparkSession, final.model, final.name, spec, picked["reason"]),
        "saved_check": training.verify_saved(
            final.model, final.scored.drop("prediction", "score"), ["row_id"], new_path(cleaned.sparkSession, "model")
        ),
    }
    if spec.group is not None:
        out["group_performance"] = evaluate.group_performance(final.scored, spec.group)
    return out, models


def report(results: dict[str, DataFrame], sections: list[str] | None = None) -> DataFrame:
    """``section, item, metric, value_double, value_string`` rows of the report's content.

    All sections are wanted unless fewer are named; ``KeyError`` tells of one that is absent.
    """
    names = list(REPORT_KEYS if sections is None else sections)
    absent = [n for n in names if n not in results]
    if absent:
        raise KeyError(f"sections without a result: {absent}")
    out = None
    for name in names:
        part = to_tidy(results[name], name, REPORT_KEYS[name])
        out = part if out is None else out.unionByName(part)
    return out
