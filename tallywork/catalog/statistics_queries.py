"""Correlations and hypothesis tests."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import Tables, long_sql, query, r, rounded
from tallywork.functions.tails import chi_square_log_p_value, student_t_log_p_value
from tallywork.operators import contingency, correlation, ttest

NUM = SPEC.numeric
PAIRS = list(combinations(NUM, 2))


def _pairs_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r FROM {source}" for a, b in PAIRS
    )


def _rank_sql(columns, source: str) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0E0 AS {c}" for c in columns
    )
    return f"SELECT {ranks} FROM {source}"


_PEARSON = f"WITH {{census}}, p AS ({_pairs_sql('census')})"
_SPEARMAN = f"{_PEARSON}, ranked AS ({_rank_sql(NUM, 'census')}), s AS ({_pairs_sql('ranked')})"


@query("pearson_matrix", f"{_PEARSON} SELECT column_a, column_b, {r('r')} AS r FROM p")
def _(t: Tables) -> DataFrame:
    return rounded(correlation.pearson_pairs(t.census, NUM))


@query("spearman_matrix", f"{_SPEARMAN} SELECT column_a, column_b, {r('r')} AS r FROM s")
def _(t: Tables) -> DataFrame:
    return rounded(correlation.spearman_pairs(t.stored_census, NUM))


@query(
    "spearman_pairwise_missing",
    f"""WITH joined AS (SELECT n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
    complete AS (SELECT * FROM joined WHERE quality IS NOT NULL AND toxic IS NOT NULL),
    ranked AS ({_rank_sql(['n_chars', 'quality', 'toxic'], 'complete')})
    SELECT 'n_chars' AS column_a, 'quality' AS column_b, {r('corr(n_chars, quality)')} AS r FROM ranked
    UNION ALL SELECT 'n_chars', 'toxic', {r('corr(n_chars, toxic)')} FROM ranked
    UNION ALL SELECT 'quality', 'toxic', {r('corr(quality, toxic)')} FROM ranked""",
)
def _(t: Tables) -> DataFrame:
    joined = t.read("documents").select("doc_id", "n_chars").join(t.read("labels"), "doc_id", "left")
    return rounded(correlation.spearman_pairs(joined, ["n_chars", "quality", "toxic"]))


@query(
    "pearson_spearman_gap",
    f"""{_SPEARMAN} SELECT {r('max(abs(p.r - s.r))')} AS max_gap
    FROM p JOIN s ON p.column_a = s.column_a AND p.column_b = s.column_b""",
)
def _(t: Tables) -> DataFrame:
    pearson = correlation.pearson_pairs(t.census, NUM)
    return rounded(correlation.largest_gap(pearson, correlation.spearman_pairs(t.stored_census, NUM)))


@query(
    "target_correlation",
    "WITH {census}, f AS (SELECT *, CASE WHEN income = '>50K' THEN 1 ELSE 0 END AS flag01 FROM census) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r(f'corr({c}, flag01)')} AS r FROM f" for c in NUM),
)
def _(t: Tables) -> DataFrame:
    return rounded(correlation.target_correlation(t.census, NUM, "income", ">50K"))


TOP_PAIRS_SQL = f"""{_PEARSON} SELECT column_a, column_b, {r('r')} AS r FROM p
    ORDER BY abs(p.r) DESC, column_a, column_b LIMIT 3"""


@query("top_corr_pairs", TOP_PAIRS_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(correlation.top_pairs(correlation.pearson_pairs(t.census, NUM), 3))


@query(
    "corr_heatmap",
    f"""{_PEARSON}, names AS (SELECT column_a AS c FROM p UNION SELECT column_b FROM p)
    SELECT column_a, column_b, {r('r')} AS r FROM p
    UNION ALL SELECT column_b, column_a, {r('r')} FROM p
    UNION ALL SELECT c, c, 1.0E0 FROM names""",
)
def _(t: Tables) -> DataFrame:
    return rounded(correlation.matrix_cells(correlation.pearson_pairs(t.census, NUM)))


# Two-sided Student t tail: one minus twice Simpson's integral of the density over [0, |t|].
_T_TAIL = """greatest(0.0E0, 1.0E0 - 2.0E0 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())
      * (abs(t) / 4000.0E0) / 3.0E0 * list_sum(list_transform(range(0, 4001), lambda i:
          (CASE WHEN i = 0 OR i = 4000 THEN 1.0E0 WHEN i % 2 = 1 THEN 4.0E0 ELSE 2.0E0 END)
          * pow(1 + pow(abs(t) * i / 4000.0E0, 2) / dof, -(dof + 1) / 2))))"""

WELCH_SQL = f"""WITH {{census}}, long AS ({long_sql(SPEC.test_values, "income")}),
    g AS (
      SELECT "column",
        count(value) FILTER (WHERE income = '>50K') AS high_n, count(value) FILTER (WHERE income = '<=50K') AS low_n,
        avg(value) FILTER (WHERE income = '>50K') AS high_mean, avg(value) FILTER (WHERE income = '<=50K') AS low_mean,
        var_samp(value) FILTER (WHERE income = '>50K') AS high_var,
        var_samp(value) FILTER (WHERE income = '<=50K') AS low_var
      FROM long GROUP BY "column"),
    q AS (SELECT *, high_var / high_n AS a, low_var / low_n AS b FROM g),
    w AS (SELECT *, (high_mean - low_mean) / sqrt(a + b) AS t,
                 (a + b) * (a + b) / (a * a / (high_n - 1) + b * b / (low_n - 1)) AS dof,
                 (high_mean - low_mean) / sqrt((high_var + low_var) / 2) AS d FROM q),
    v AS (SELECT *, {_T_TAIL} AS p FROM w)
    SELECT "column", high_n, low_n, {r("high_mean")} AS high_mean, {r("low_mean")} AS low_mean,
           {r("sqrt(high_var)")} AS high_std, {r("sqrt(low_var)")} AS low_std,
           {r("high_mean - low_mean")} AS mean_difference, {r("t")} AS t_statistic, {r("dof", 4)} AS dof,
           {r("p")} AS p_value, {r("d")} AS cohens_d, 0.05E0 AS alpha, p < 0.05 AS is_significant
    FROM v"""


@query("welch_t", WELCH_SQL)
def _(t: Tables) -> DataFrame:
    return welch(t)


def welch(t: Tables) -> DataFrame:
    tests = ttest.welch_t_tests(t.census, SPEC.test_values, "income", ">50K", "<=50K")
    return rounded(tests, dof=4)


# log of the tail: Simpson's integral of the density over its angle, its largest value taken out of the sum.
_T_LOG_TAIL = """(ln(2.0E0) + lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5E0 * ln(pi()) + (dof - 1) * ln(cos(start)) + ln((stop - start) / 60000.0E0
    * list_sum(list_transform(range(0, 20001), lambda i: (CASE WHEN i = 0 OR i = 20000 THEN 1.0E0 WHEN i % 2 = 1 THEN 4.0E0 ELSE 2.0E0 END)
      * exp((dof - 1) * (ln(greatest(1.0E-300, cos(start + (stop - start) * i / 20000.0E0))) - ln(cos(start))))))))"""


@query(
    "welch_t_log_p",
    WELCH_SQL.split("v AS (SELECT *, ")[0].rstrip().rstrip(",")
    + f""", angles AS (SELECT *, atan2(abs(t), sqrt(dof)) AS start FROM w),
    ranges AS (SELECT *, least(pi() / 2, start + 60.0E0 / ((dof - 1) * greatest(tan(start), 1.0E-3))) AS stop FROM angles)
    SELECT "column", {r(_T_LOG_TAIL, 4)} AS log_p_value, row_number() OVER (ORDER BY {_T_LOG_TAIL}, "column") AS strength FROM ranges""",
)
def _(t: Tables) -> DataFrame:
    """Tests ranked by the logarithm of their p-value, strongest first; the p-values themselves underflow."""
    tests = ttest.welch_t_tests(t.census, SPEC.test_values, "income", ">50K", "<=50K")
    logs = tests.select("column", student_t_log_p_value(F.col("t_statistic"), F.col("dof")).alias("log_p_value"))
    ranked = logs.withColumn("strength", F.row_number().over(Window.orderBy("log_p_value", "column")).cast("bigint"))  # one row per tested column
    return rounded(ranked, log_p_value=4)


@query(
    "cohens_d",
    f"""WITH {{census}}, long AS ({long_sql(NUM, "income")})
    SELECT "column", {r("avg(value) FILTER (WHERE income = '>50K') - avg(value) FILTER (WHERE income = '<=50K')")} AS mean_difference,
      {r('''(avg(value) FILTER (WHERE income = '>50K') - avg(value) FILTER (WHERE income = '<=50K'))
        / sqrt((var_samp(value) FILTER (WHERE income = '>50K') + var_samp(value) FILTER (WHERE income = '<=50K')) / 2)''')} AS cohens_d
    FROM long GROUP BY "column" """,
)
def _(t: Tables) -> DataFrame:
    tests = ttest.welch_t_tests(t.census, NUM, "income", ">50K", "<=50K")
    return rounded(tests.select("column", "mean_difference", "cohens_d"))


# Upper chi-square tail: the finite sum for even degrees of freedom, Simpson's integral of the
# normal density for one degree of freedom.
_CHI_TAIL = """CASE WHEN dof % 2 = 0
      THEN exp(-chi2 / 2) * list_sum(list_transform(range(0, dof // 2), lambda i: pow(chi2 / 2, i) / gamma(i + 1)))
      ELSE greatest(0.0E0, 1.0E0 - 2.0E0 / sqrt(2 * pi()) * (sqrt(chi2) / 4000.0E0) / 3.0E0
        * list_sum(list_transform(range(0, 4001), lambda i:
          (CASE WHEN i = 0 OR i = 4000 THEN 1.0E0 WHEN i % 2 = 1 THEN 4.0E0 ELSE 2.0E0 END)
          * exp(-pow(sqrt(chi2) * i / 4000.0E0, 2) / 2)))) END"""


def chi_square_sql(long: str, prefix: str) -> str:
    """SQL of the capped chi-square tests over ``long(column, level, label)`` without NULLs."""
    return f"""{prefix} long AS ({long}),
    freq AS (SELECT "column", level, count(*) AS n FROM long WHERE level IS NOT NULL AND label IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS place FROM freq),
    capped AS (
      SELECT l."column", CASE WHEN place <= 10 THEN l.level ELSE 'Other' END AS level, label
      FROM long l JOIN ranked k ON l."column" = k."column" AND l.level = k.level WHERE label IS NOT NULL),
    cells AS (SELECT "column", level, label, count(*) AS n FROM capped GROUP BY ALL),
    lv AS (SELECT "column", level, CAST(sum(n) AS DOUBLE) AS level_n FROM cells GROUP BY ALL),
    lb AS (SELECT "column", label, CAST(sum(n) AS DOUBLE) AS label_n FROM cells GROUP BY ALL),
    tt AS (SELECT "column", CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY ALL),
    grid AS (
      SELECT lv."column", lv.level, lb.label, coalesce(cells.n, 0) AS o, level_n * label_n / tt.n AS e, tt.n AS total
      FROM lv JOIN lb ON lv."column" = lb."column" JOIN tt ON tt."column" = lv."column"
      LEFT JOIN cells ON cells."column" = lv."column" AND cells.level = lv.level AND cells.label = lb.label),
    dims AS (
      SELECT "column", any_value(total) AS n, count(DISTINCT level) AS levels, count(DISTINCT label) AS labels,
             (count(DISTINCT level) - 1) * (count(DISTINCT label) - 1) AS dof,
             count(*) FILTER (WHERE e < 5) AS small_expected_cells
      FROM grid GROUP BY "column"),
    stat AS (
      SELECT g."column", sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5E0, abs(o - e)), 2) / e
                                  ELSE pow(o - e, 2) / e END) AS chi2
      FROM grid g JOIN dims d ON g."column" = d."column" GROUP BY g."column"),
    tested AS (SELECT d.*, chi2, {_CHI_TAIL} AS p FROM dims d JOIN stat s ON d."column" = s."column")
    SELECT "column", n, levels, labels, dof, {r("chi2")} AS chi2, small_expected_cells, {r("p")} AS p_value,
           {r("sqrt(chi2 / (n * (least(levels, labels) - 1)))")} AS cramers_v, p < 0.05 AS is_significant
    FROM tested"""


CHI_SQUARE_SQL = chi_square_sql(
    long_sql(SPEC.test_categories, "income AS label", kind="VARCHAR", value="level"), "WITH {census},"
)


@query("chi_square", CHI_SQUARE_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.chi_square_tests(t.census, SPEC.test_categories, "income"))


@query(
    "chi_square_log_p",
    CHI_SQUARE_SQL.replace("income AS label", "flag AS label").split("tested AS (")[0].rstrip().rstrip(",")
    + f""" SELECT d."column", dof, {r("ln(list_sum(list_transform(range(0, dof // 2), lambda i: exp(i * ln(chi2 / 2) - lgamma(i + 1))))) - chi2 / 2", 4)} AS log_p_value
    FROM dims d JOIN stat s ON d."column" = s."column" """,
)
def _(t: Tables) -> DataFrame:
    """Tests against a three-valued label, so every number of degrees of freedom is even and the tail a finite sum."""
    tests = contingency.chi_square_tests(t.census, SPEC.test_categories, "flag")
    return rounded(tests.select("column", "dof", chi_square_log_p_value(F.col("chi2"), F.col("dof")).alias("log_p_value")), log_p_value=4)


@query(
    "chi_square_2x2",
    chi_square_sql(
        "SELECT 'quality' AS \"column\", CAST(quality AS VARCHAR) AS level, CAST(toxic AS VARCHAR) AS label FROM labels",
        "WITH",
    ),
)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.chi_square_tests(t.read("labels"), ["quality"], "toxic"))


@query(
    "chi_square_sparse",
    chi_square_sql(
        "SELECT 'user_id' AS \"column\", CAST(user_id AS VARCHAR) AS level, event_type AS label FROM events", "WITH"
    ),
)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.chi_square_tests(t.read("events"), ["user_id"], "event_type"))


@query(
    "cramers_v",
    CHI_SQUARE_SQL.replace('SELECT "column", n, levels', 'SELECT "column", cramers_v FROM (SELECT "column", n, levels') + ")",
)
def _(t: Tables) -> DataFrame:
    tests = contingency.chi_square_tests(t.census, SPEC.test_categories, "income")
    return rounded(tests.select("column", "cramers_v"))


@query(
    "expected_small_cells",
    f"""WITH cells AS (SELECT source AS level, lang AS label, count(*) AS n FROM documents GROUP BY ALL),
    lv AS (SELECT level, sum(n) AS a FROM cells GROUP BY ALL), lb AS (SELECT label, sum(n) AS b FROM cells GROUP BY ALL)
    SELECT 'source' AS "column", lv.level, lb.label, coalesce(n, 0) AS n,
           {r("CAST(a AS DOUBLE) * b / (SELECT sum(n) FROM cells)")} AS expected
    FROM lv CROSS JOIN lb LEFT JOIN cells ON cells.level = lv.level AND cells.label = lb.label""",
)
def _(t: Tables) -> DataFrame:
    return rounded(contingency.dense(contingency.crosstab(t.read("documents"), ["source"], "lang")))
