"""The whole analysis as one tidy table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.chart_queries import chart_counts_sql
from tallywork.catalog.profile_queries import BY_TARGET_SQL, CATEGORIES_SQL, COLUMNS_SQL, PROFILE_SQL, TARGET_SQL
from tallywork.catalog.refit_sql import REFIT_SQL
from tallywork.catalog.registry import Tables, query, r, rounded
from tallywork.catalog.scan_queries import OVERVIEW_SQL
from tallywork.catalog.statistics_queries import CHI_SQUARE_SQL, TOP_PAIRS_SQL, WELCH_SQL
from tallywork.catalog.model_queries import AREA_SQL, TALLY_SQL
from tallywork.modeling.training import LOGISTIC
from tallywork.operators import evaluate
from tallywork.plans.analysis import REPORT_KEYS, analyze, model_results, report
from tallywork.plans.run import run_analysis
from tallywork.sources.sinks import write_results
from tallywork.sources.scratch import new_path

# Metrics of each reported section; the ones after the bar are text.
_SECTIONS = {
    "data": (OVERVIEW_SQL.replace("SELECT 'table' AS item, 'rows' AS metric,", "SELECT 'table' AS item, 'rows' AS metric_name,"), "value", ""),
    "clean_counts": (
        """WITH {census}, whole AS (SELECT count(*) AS n FROM census), once AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM census))
        SELECT whole.n AS rows_before, once.n AS rows_after, whole.n - once.n AS rows_removed, whole.n - once.n AS raw_duplicates FROM whole, once""",
        "rows_before rows_after rows_removed raw_duplicates",
        "",
    ),
    "target": (TARGET_SQL, "n pct imbalance_ratio", ""),
    "numeric_profile": (
        PROFILE_SQL,
        "count mean std min q1 median q3 max iqr missing missing_pct distinct_values skewness kurtosis "
        "outlier_candidates zero_pct",
        "",
    ),
    "numeric_by_target": (BY_TARGET_SQL, "mean median", ""),
    "categorical_columns": (COLUMNS_SQL, "distinct_values missing sparse_count", "mode_value"),
    "categories": (CATEGORIES_SQL, "n level_rank pct positive_n positive_pct", ""),
    "top_pairs": (TOP_PAIRS_SQL, "r", ""),
    "t_tests": (
        WELCH_SQL,
        "high_n low_n high_mean low_mean high_std low_std mean_difference t_statistic dof p_value cohens_d alpha "
        "is_significant",
        "",
    ),
    "chi_square": (
        CHI_SQUARE_SQL, "n levels labels dof chi2 small_expected_cells p_value cramers_v is_significant", ""
    ),
}


def _tidy_sql(section: str) -> str:
    body, numbers, texts = _SECTIONS[section]
    item = " || '|' || ".join(f'"{k}"' for k in REPORT_KEYS[section]) or "''"
    packs = [
        f"struct_pack(metric := '{m}', value_double := CAST(CAST(\"{m}\" AS VARCHAR) AS DOUBLE), value_string := CAST(NULL AS VARCHAR))"
        if m != "is_significant"
        else f"struct_pack(metric := '{m}', value_double := CASE WHEN {m} THEN 1.0E0 ELSE 0.0E0 END, value_string := CAST(NULL AS VARCHAR))"
        for m in numbers.split()
    ] + [
        f"struct_pack(metric := '{m}', value_double := CAST(NULL AS DOUBLE), value_string := \"{m}\")"
        for m in texts.split()
    ]
    return f"""SELECT '{section}' AS section, item, u.metric AS metric, u.value_double AS value_double,
        u.value_string AS value_string
      FROM (SELECT {item} AS item, unnest([{', '.join(packs)}]) AS u FROM ({body}) AS body_{section})"""


@query("report_tables", " UNION ALL ".join(_tidy_sql(name) for name in _SECTIONS))
def _(t: Tables) -> DataFrame:
    done = analyze(t.stored_census, SPEC, models=False, charts_too=False, stored_raw=True)
    tables = {name: rounded(done.results[name], mean=_mean_digits(name), dof=4) for name in _SECTIONS}
    path = write_results(report(tables, list(_SECTIONS)), new_path(t.spark, "report"))
    return t.spark.read.parquet(path).select("section", "item", "metric", "value_double", "value_string")


def _mean_digits(section: str) -> int:
    return 8 if section == "numeric_profile" else 6


@query("analysis_charts", chart_counts_sql())
def _(t: Tables) -> DataFrame:
    """Row counts of every chart table of the whole analysis."""
    done = analyze(t.census, SPEC, models=False)
    out = None
    for name, table in done.results.items():
        if name.startswith("chart_"):
            part = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("chart"), "n")
            out = part if out is None else out.unionByName(part)
    return out


_MODEL_METRICS = {
    "accuracy": "(tp + tn) / CAST(n AS DOUBLE)", "precision": "tp / CAST(tp + fp AS DOUBLE)", "recall": "tp / CAST(tp + fn AS DOUBLE)",
    "f1_score": "2.0E0 * tp / (2 * tp + fp + fn)",
}
_GROUP_METRICS = {k: _MODEL_METRICS[k] for k in ("accuracy", "f1_score")} | {"n": "CAST(n AS DOUBLE)", "positive_pred_ratio": "(tp + fp) / CAST(n AS DOUBLE)"}


@query(
    "report_model_tables",
    f"""{REFIT_SQL}, area AS ({AREA_SQL}), tally AS (SELECT {TALLY_SQL} FROM scored),
    groups AS (SELECT {SPEC.group} AS item, {TALLY_SQL} FROM scored WHERE {SPEC.group} IS NOT NULL GROUP BY {SPEC.group})
    SELECT 'model_selection' AS section, '' AS item, 'logistic_f1' AS metric, {r(_MODEL_METRICS["f1_score"])} AS value_double FROM tally
    UNION ALL SELECT 'model_comparison', '{LOGISTIC}', 'roc_auc', {r("area", 5)} FROM area
    """
    + " ".join(f"UNION ALL SELECT 'model_comparison', '{LOGISTIC}', '{m}', {r(e)} FROM tally" for m, e in _MODEL_METRICS.items())
    + " "
    + " ".join(f"UNION ALL SELECT 'group_performance', item, '{m}', {r(e)} FROM groups" for m, e in _GROUP_METRICS.items()),
)
def _(t: Tables) -> DataFrame:
    """The report's model sections as far as a refit can tell them: all but the forest's own figures."""
    tables, models = model_results(t.census, SPEC, stored=False)
    tables["group_performance"] = evaluate.group_performance(models[LOGISTIC].scored, SPEC.group)
    tidy = report(tables, ["model_comparison", "model_selection", "group_performance"])
    known = (
        ((F.col("section") == "model_comparison") & (F.col("item") == LOGISTIC))
        | ((F.col("section") == "model_selection") & (F.col("metric") == "logistic_f1"))
        | (F.col("section") == "group_performance")
    )
    digits = F.when(F.col("metric") == "roc_auc", F.round("value_double", 5)).otherwise(F.round("value_double", 6))
    return tidy.where(known).select("section", "item", "metric", digits.alias("value_double"))


def _stage_sql(name: str, body: str) -> str:
    return f"SELECT '{name}' AS stage, (SELECT count(*) FROM ({body}) AS body_{name}) AS n"


@query(
    "run_taken_up_again",
    " UNION ALL ".join(
        [_stage_sql(name, _SECTIONS[name][0]) for name in ("data", "target", "numeric_profile", "numeric_by_target", "categories", "t_tests", "chi_square")]
        + [_stage_sql("cleaned", "WITH {census} SELECT DISTINCT * FROM census"), _stage_sql("cleaned_csv", "WITH {census} SELECT DISTINCT * FROM census")]
        + [_stage_sql("unmatched_ranges", "SELECT 1 WHERE false")]
    ),
)
def _(t: Tables) -> DataFrame:
    """Rows of a run's stored tables, read by a second run that finds them all finished."""
    out, view = new_path(t.spark, "run"), t.stored_census
    run_analysis(view, SPEC, out, other=view, models=False, charts=False, stored_raw=True)
    tables, manifest = run_analysis(view, SPEC, out, other=view, models=False, charts=False, stored_raw=True)
    counted = {name: tables[name] for name in ("data", "target", "numeric_profile", "numeric_by_target", "categories", "t_tests", "chi_square", "cleaned")}
    counted["cleaned_csv"] = t.spark.read.csv(f"{manifest.folder}/files/cleaned_csv", header=True)
    counted["unmatched_ranges"] = tables["reconciled_ranges"].where("NOT matches")
    rows = None
    for name, table in counted.items():
        one = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows
