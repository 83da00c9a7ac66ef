"""Numeric and categorical profiles, reshaping, top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import Tables, long_sql, query, r, rounded
from tallywork.operators import categorical, charts, contingency, numeric, quality, sketches
from tallywork.operators.frequency import category_frequencies
from tallywork.sources.scratch import new_path

NUM = SPEC.numeric
CAT = SPEC.categorical


def profile_sql(columns, source: str, prefix: str) -> str:
    """SQL of the numeric profile over the long form of some columns."""
    return f"""{prefix} long AS ({long_sql(columns, source=source)}),
    s AS (
      SELECT "column", count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS lo,
             max(value) AS hi, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3, count(*) AS all_rows, count(DISTINCT value) AS distinct_values,
             skewness(value) AS skew, kurtosis(value) AS kurt,
             100.0E0 * avg(CASE WHEN value = 0 THEN 1.0E0 ELSE 0.0E0 END) AS zero_pct
      FROM long GROUP BY "column"),
    o AS (
      SELECT long."column", count(*) FILTER (WHERE value < q1 - 1.5E0 * (q3 - q1) OR value > q3 + 1.5E0 * (q3 - q1))
             AS outlier_candidates
      FROM long JOIN s ON long."column" = s."column" GROUP BY long."column")
    SELECT s."column", n AS count, {r("mean", 8)} AS mean, {r("std")} AS std, {r("lo")} AS min,
           {r("q1")} AS q1, {r("median")} AS median, {r("q3")} AS q3, {r("hi")} AS max, {r("q3 - q1")} AS iqr,
           all_rows - n AS missing, {r("100.0E0 * (all_rows - n) / all_rows")} AS missing_pct, distinct_values,
           {r("skew")} AS skewness, {r("kurt")} AS kurtosis, outlier_candidates, {r("zero_pct")} AS zero_pct
    FROM s JOIN o ON s."column" = o."column" """


PROFILE_SQL = profile_sql(NUM, "census", "WITH {census},")


@query("numeric_profile", PROFILE_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(numeric.numeric_profile(t.census, NUM), mean=8)


@query("events_profile", profile_sql(["value"], "events", "WITH"))
def _(t: Tables) -> DataFrame:
    return rounded(numeric.numeric_profile(t.read("events"), ["value"]), mean=8)


@query(
    "text_length_profile",
    profile_sql(["n_chars", "quality"], "joined", "WITH joined AS (SELECT n_chars, quality FROM documents LEFT JOIN labels USING (doc_id)),"),
)
def _(t: Tables) -> DataFrame:
    joined = t.read("documents").select("doc_id", "n_chars").join(
        t.read("labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return rounded(numeric.numeric_profile(joined, ["n_chars", "quality"]), mean=8)


@query(
    "moments",
    f"""WITH {{census}}, long AS ({long_sql(NUM)})
    SELECT "column", count(value) AS count, {r("avg(value)", 8)} AS mean, {r("stddev_samp(value)")} AS std,
           {r("min(value)")} AS min, {r("max(value)")} AS max, count(*) - count(value) AS missing,
           {r("100.0E0 * (count(*) - count(value)) / count(*)")} AS missing_pct,
           {r("skewness(value)")} AS skewness, {r("kurtosis(value)")} AS kurtosis,
           {r("100.0E0 * avg(CASE WHEN value = 0 THEN 1.0E0 ELSE 0.0E0 END)")} AS zero_pct
    FROM long GROUP BY "column" """,
)
def _(t: Tables) -> DataFrame:
    return rounded(numeric.moments(t.census, NUM), mean=8)


@query(
    "quartiles",
    f"""WITH {{census}}, long AS ({long_sql(NUM)})
    SELECT "column", {r("quantile_cont(value, 0.25)")} AS q1, {r("quantile_cont(value, 0.5)")} AS median,
           {r("quantile_cont(value, 0.75)")} AS q3,
           {r("quantile_cont(value, 0.75) - quantile_cont(value, 0.25)")} AS iqr
    FROM long GROUP BY "column" """,
)
def _(t: Tables) -> DataFrame:
    return rounded(numeric.quartiles(numeric.numeric_values(t.stored_census, NUM)))


@query(
    "outlier_counts",
    f"""WITH {{census}}, long AS ({long_sql(NUM)}),
    b AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY "column"),
    f AS (SELECT "column", q1 - 1.5E0 * (q3 - q1) AS low, q3 + 1.5E0 * (q3 - q1) AS high FROM b)
    SELECT long."column", count(DISTINCT value) AS distinct_values,
           count(*) FILTER (WHERE value < low OR value > high) AS outlier_candidates,
           {r("any_value(low)")} AS low, {r("any_value(high)")} AS high
    FROM long JOIN f ON long."column" = f."column" GROUP BY long."column" """,
)
def _(t: Tables) -> DataFrame:
    freq = numeric.stored_frequencies(t.census, NUM)
    return rounded(numeric.outliers_and_distinct(freq, numeric.quartiles(freq, weight="n")))


@query(
    "numeric_hints",
    f"""WITH {{census}}, long AS ({long_sql(NUM)}),
    s AS (
      SELECT "column", avg(value) - quantile_cont(value, 0.5) AS gap, skewness(value) AS skew,
             100.0E0 * avg(CASE WHEN value = 0 THEN 1.0E0 ELSE 0.0E0 END) AS zero_pct,
             quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM long GROUP BY "column")
    SELECT s."column", {r("any_value(gap)", 8)} AS mean_median_gap, {r("any_value(skew)")} AS skewness,
           CASE WHEN any_value(skew) > 0.5 THEN 'right' WHEN any_value(skew) < -0.5 THEN 'left' ELSE 'even' END AS skew_label,
           {r("any_value(zero_pct)")} AS zero_pct,
           count(*) FILTER (WHERE value < q1 - 1.5E0 * (q3 - q1) OR value > q3 + 1.5E0 * (q3 - q1)) AS outlier_candidates
    FROM long JOIN s ON long."column" = s."column" GROUP BY s."column" """,
)
def _(t: Tables) -> DataFrame:
    return rounded(numeric.numeric_hints(numeric.numeric_profile(t.census, NUM)), mean_median_gap=8)


BY_TARGET_SQL = f"""WITH {{census}}, long AS ({long_sql(NUM, "income")})
    SELECT income AS "group", "column", {r("avg(value)")} AS mean, {r("quantile_cont(value, 0.5)")} AS median
    FROM long GROUP BY income, "column" """


@query("numeric_by_target", BY_TARGET_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(numeric.numeric_by_group(t.census, NUM, "income"))


@query(
    "min_max",
    f"""WITH {{census}}, long AS ({long_sql(NUM)})
    SELECT "column", {r("min(value)")} AS min, {r("max(value)")} AS max FROM long GROUP BY "column" """,
)
def _(t: Tables) -> DataFrame:
    return rounded(quality.ranges(t.census, NUM))


TARGET_SQL = f"""WITH {{census}}, c AS (SELECT income, count(*) AS n FROM census GROUP BY income)
    SELECT income AS category, n, {r("100.0E0 * n / (SELECT sum(n) FROM c)")} AS pct,
           {r("CAST((SELECT max(n) FROM c) AS DOUBLE) / (SELECT min(n) FROM c)")} AS imbalance_ratio
    FROM c WHERE income IS NOT NULL"""


@query("target_distribution", TARGET_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(categorical.target_distribution(t.census, "income"))


@query(
    "class_bars",
    f"""WITH {{census}}, c AS (SELECT income, count(*) AS n FROM census GROUP BY income)
    SELECT income AS category, n, {r("100.0E0 * n / (SELECT sum(n) FROM c)")} AS pct FROM c""",
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.class_bars(t.census, "income"))


_COUNTS = f"""WITH {{census}}, long AS ({long_sql(CAT, "income", kind="VARCHAR", value="category")}),
    c AS (SELECT "column", category, count(*) AS n, count(*) FILTER (WHERE income = '>50K') AS positive_n
          FROM long WHERE category IS NOT NULL GROUP BY "column", category),
    m AS (SELECT "column", count(*) - count(category) AS missing, count(category) AS valid FROM long GROUP BY "column"),
    k AS (SELECT c.*, valid, missing, row_number() OVER (PARTITION BY c."column" ORDER BY n DESC, category) AS level_rank
          FROM c JOIN m ON c."column" = m."column")"""

CATEGORIES_SQL = f"""{_COUNTS}
    SELECT "column", category, n, level_rank, {r("100.0E0 * n / valid")} AS pct, positive_n,
           {r("100.0E0 * positive_n / n")} AS positive_pct
    FROM k WHERE level_rank <= 10"""

COLUMNS_SQL = f"""{_COUNTS}
    SELECT "column", count(*) AS distinct_values, max(category) FILTER (WHERE level_rank = 1) AS mode_value,
           any_value(missing) AS missing, count(*) FILTER (WHERE CAST(n AS DOUBLE) / valid < 0.01) AS sparse_count
    FROM k GROUP BY "column" """


@query("value_counts", CATEGORIES_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(categorical.value_counts(category_frequencies(t.census, CAT, "income", ">50K"), 10))


@query("categorical_profile_columns", COLUMNS_SQL)
def _(t: Tables) -> DataFrame:
    return categorical.categorical_profile(t.census, CAT, "income", ">50K")["columns"]


@query("categorical_profile_categories", CATEGORIES_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(categorical.categorical_profile(t.census, CAT, "income", ">50K")["categories"])


@query(
    "mode_per_column",
    f"""{_COUNTS} SELECT "column", category AS mode_value FROM k WHERE level_rank = 1""",
)
def _(t: Tables) -> DataFrame:
    return categorical.modes(category_frequencies(t.census, CAT))


@query(
    "sparse_categories",
    """WITH long AS (
      SELECT 'user_id' AS "column", CAST(user_id AS VARCHAR) AS category FROM events
      UNION ALL SELECT 'event_type', event_type FROM events),
    c AS (SELECT "column", category, count(*) AS n FROM long WHERE category IS NOT NULL GROUP BY "column", category),
    m AS (SELECT "column", count(category) AS valid FROM long GROUP BY "column")
    SELECT c."column", count(*) FILTER (WHERE CAST(n AS DOUBLE) / valid < 0.01) AS sparse_count
    FROM c JOIN m ON c."column" = m."column" GROUP BY c."column" """,
)
def _(t: Tables) -> DataFrame:
    return categorical.sparse_categories(category_frequencies(t.read("events"), ["user_id", "event_type"]))


@query(
    "category_positive_rate",
    f"""{_COUNTS} SELECT "column", category, n, positive_n, {r("100.0E0 * positive_n / n")} AS positive_pct FROM k""",
)
def _(t: Tables) -> DataFrame:
    return rounded(categorical.positive_rates(category_frequencies(t.census, CAT, "income", ">50K")))


@query("top_categories", "SELECT source AS category, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, category LIMIT 7")
def _(t: Tables) -> DataFrame:
    return categorical.top_categories(t.read("documents"), "source", 7)


_TOP_BRANDS = """top AS (SELECT brand FROM census WHERE brand IS NOT NULL GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 10)"""


@query("top_category_rows", f"WITH {{census}}, {_TOP_BRANDS} SELECT h, brand FROM census WHERE brand IN (SELECT brand FROM top)")
def _(t: Tables) -> DataFrame:
    return categorical.rows_in_top(t.census.select("h", "brand"), "brand", 10)


@query(
    "topn_other_null_to_other",
    f"""WITH {{census}}, {_TOP_BRANDS}
    SELECT h, CASE WHEN brand IN (SELECT brand FROM top) THEN brand ELSE 'Other' END AS brand FROM census""",
)
def _(t: Tables) -> DataFrame:
    return categorical.recode_top(t.census.select("h", "brand"), "brand", 10)


@query(
    "topn_other_keep_null",
    f"""WITH {{census}}, {_TOP_BRANDS}
    SELECT h, CASE WHEN brand IS NULL OR brand IN (SELECT brand FROM top) THEN brand ELSE 'Other' END AS brand, segment
    FROM census""",
)
def _(t: Tables) -> DataFrame:
    capped = categorical.recode_top(t.census.select("h", "brand", "segment"), "brand", 10, null_to_other=False)
    return categorical.recode_top(capped, "segment", 10)  # five levels: left as it is


@query(
    "melt_log1p",
    f"""WITH {{census}} SELECT 'gain' AS "column", {r("ln(1 + gain)")} AS value FROM census
    UNION ALL SELECT 'price', {r("ln(1 + price)")} FROM census""",
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.log_values(t.census, ["gain", "price"]))


_CELLS = f"""WITH {{census}}, long AS ({long_sql(["brand", "segment", "type"], "income", kind="VARCHAR", value="level")}),
    cells AS (SELECT "column", level, income AS label, count(*) AS n FROM long WHERE level IS NOT NULL GROUP BY ALL),
    lv AS (SELECT "column", level, sum(n) AS level_n FROM cells GROUP BY ALL),
    lb AS (SELECT "column", label, sum(n) AS label_n FROM cells GROUP BY ALL),
    tt AS (SELECT "column", sum(n) AS total_n FROM cells GROUP BY ALL)"""


@query(
    "crosstab",
    f"""{_CELLS} SELECT lv."column", lv.level, lb.label, coalesce(n, 0) AS n,
      {r("CAST(level_n AS DOUBLE) * label_n / total_n")} AS expected
    FROM lv JOIN lb ON lv."column" = lb."column" JOIN tt ON tt."column" = lv."column"
    LEFT JOIN cells ON cells."column" = lv."column" AND cells.level = lv.level AND cells.label = lb.label""",
)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.dense(contingency.crosstab(t.census, ["brand", "segment", "type"], "income")))


@query(
    "crosstab_normalized",
    f"""{_CELLS} SELECT lv."column", lv.level, lb.label, coalesce(n, 0) AS n, CAST(level_n AS BIGINT) AS level_n,
      {r("coalesce(n, 0) / CAST(level_n AS DOUBLE)")} AS share
    FROM lv JOIN lb ON lv."column" = lb."column"
    LEFT JOIN cells ON cells."column" = lv."column" AND cells.level = lv.level AND cells.label = lb.label""",
)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.row_shares(contingency.crosstab(t.census, ["brand", "segment", "type"], "income")))


@query(
    "crosstab_sparse",
    """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS level, event_type AS label, count(*) AS n FROM events GROUP BY ALL)
    SELECT 'user_id' AS "column", level, label, n FROM c""",
)
def _(t: Tables) -> DataFrame:
    return contingency.crosstab(t.read("events"), ["user_id"], "event_type")


@query(
    "profile_constant",
    """SELECT 'tenth' AS "column", count(*) AS count, 0.1E0 AS mean, 0.0E0 AS std, 0.0E0 AS skewness, 0.0E0 AS kurtosis, 1 AS distinct_values
    FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    """A column whose sum does not divide back to its value."""
    rows = t.read("lineitem").select((F.col("l_linenumber") * 0 + F.lit(0.1)).alias("tenth"))
    return numeric.numeric_profile(rows, ["tenth"]).select("column", "count", "mean", "std", "skewness", "kurtosis", "distinct_values")


@query(
    "profile_big_integers",
    """SELECT 'big' AS "column", count(*) AS count, count(DISTINCT o_orderkey) AS distinct_values FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Keys shifted to where a double holds every other integer only."""
    rows = t.read("orders").select((F.col("o_orderkey") + F.lit(2**53)).alias("big"))
    return numeric.numeric_profile(rows, ["big"]).select("column", "count", "distinct_values")


@query("sketch_profile")
def _(t: Tables) -> DataFrame:
    """Approximate profile of events by user, from sketches stored per event type; an estimate has no SQL twin, its error has a test."""
    path = new_path(t.spark, "sketches")
    events = t.read("events")
    sketches.add_parts(events, ["value", "user_id"], "event_type", path)
    return sketches.merge_sketches(t.spark.read.parquet(path))
