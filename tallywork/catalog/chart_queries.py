"""The numbers behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import Tables, long_sql, query, r, rounded
from tallywork.operators import charts


def _edges(values: str) -> str:
    """SQL of the automatic bins over ``v(value, grp)``."""
    return f"""WITH {{census}}, v AS ({values}),
    q AS (SELECT min(value) AS lo, max(value) AS hi, CAST(count(*) AS DOUBLE) AS n,
                 quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM v),
    w AS (SELECT *, (hi - lo) / (log2(n) + 1) AS sturges, 2 * iqr / cbrt(n) AS fd FROM q),
    b AS (SELECT lo, hi, CAST(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) AS BIGINT) AS bins FROM w),
    e AS (SELECT *, (hi - lo) / bins AS width FROM b)"""


def histogram_sql(values: str) -> str:
    return f"""{_edges(values)},
    edge AS (SELECT i AS bin, lo + i * width AS bin_low, lo + (i + 1) * width AS bin_high, i = bins - 1 AS last
             FROM e, range(0, (SELECT bins FROM e)) AS k(i)),
    counted AS (
      SELECT grp, bin, count(*) AS n FROM v JOIN edge ON value >= bin_low AND (value < bin_high OR last)
      GROUP BY grp, bin),
    groups AS (SELECT DISTINCT grp FROM v)
    SELECT groups.grp AS "group", edge.bin, {r("bin_low")} AS bin_low, {r("bin_high")} AS bin_high, coalesce(n, 0) AS n
    FROM groups CROSS JOIN edge LEFT JOIN counted ON counted.grp = groups.grp AND counted.bin = edge.bin"""


@query(
    "hist_by_group",
    histogram_sql("SELECT CAST(quantity AS DOUBLE) AS value, income AS grp FROM census"),
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.histogram(t.census, "quantity", "income"))


@query("hist", histogram_sql("SELECT price AS value, 'all' AS grp FROM census"))
def _(t: Tables) -> DataFrame:
    return rounded(charts.histogram(t.census, "price"))


@query("hist_skewed", histogram_sql("SELECT value, 'all' AS grp FROM events").replace("WITH {census}, ", "WITH "))
def _(t: Tables) -> DataFrame:
    return rounded(charts.histogram(t.read("events"), "value"))


def density_sql(values: str, prefix: str = "WITH {census},") -> str:
    return f"""{prefix} v AS ({values}),
    f AS (SELECT grp, value, count(*) AS n FROM v GROUP BY ALL),
    s AS (SELECT grp, count(*) AS m, stddev_samp(value) * pow(CAST(count(*) AS DOUBLE), -0.2E0) AS h FROM v GROUP BY grp),
    x AS (SELECT min(value) AS lo, (max(value) - min(value)) / 199.0E0 AS gap FROM v)
    SELECT f.grp AS "group", i AS point, {r("any_value(lo + i * gap)")} AS x,
           {r("sum(n * exp(-0.5E0 * pow((lo + i * gap - value) / h, 2)) / (m * h)) / sqrt(2 * pi())", 8)} AS density
    FROM f JOIN s ON f.grp = s.grp CROSS JOIN x CROSS JOIN range(0, 200) AS k(i) GROUP BY f.grp, i"""


@query("kde_curve", density_sql("SELECT CAST(quantity AS DOUBLE) AS value, income AS grp FROM census"))
def _(t: Tables) -> DataFrame:
    return rounded(charts.density_curve(t.census, "quantity", "income"), density=8)


@query("kde_curve_skewed", density_sql("SELECT value, 'all' AS grp FROM events", "WITH"))
def _(t: Tables) -> DataFrame:
    return rounded(charts.density_curve(t.read("events"), "value"), density=8)


_BOX = f"""b AS (
      SELECT grp, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
      FROM v GROUP BY grp),
    f AS (SELECT *, q1 - 1.5E0 * (q3 - q1) AS lo, q3 + 1.5E0 * (q3 - q1) AS hi FROM b),
    j AS (SELECT v.grp, value, q1, q2, q3, value >= lo AND value <= hi AS inside FROM v JOIN f ON v.grp = f.grp),
    box AS (
      SELECT grp, count(*) AS n, {r("any_value(q1)")} AS q1, {r("any_value(q2)")} AS median, {r("any_value(q3)")} AS q3,
             {r("min(value) FILTER (WHERE inside)")} AS whisker_low, {r("max(value) FILTER (WHERE inside)")} AS whisker_high,
             count(*) FILTER (WHERE NOT inside) AS fliers
      FROM j GROUP BY grp)"""


@query(
    "box_stats",
    f"""WITH {{census}}, v AS (SELECT CAST(quantity AS DOUBLE) AS value, income AS grp FROM census), {_BOX}
    SELECT grp AS "group", * EXCLUDE (grp) FROM box""",
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.box_stats(t.census, "quantity", "income"))


@query(
    "box_stats_many_groups",
    f"""WITH v AS (SELECT value, CAST(user_id AS VARCHAR) AS grp FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL),
    {_BOX} SELECT grp AS "group", * EXCLUDE (grp) FROM box""",
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.box_stats(t.read("events"), "value", "user_id"))


@query(
    "log_box_stats",
    f"""WITH {{census}}, v AS (
      SELECT ln(1 + gain) AS value, 'gain' AS grp FROM census UNION ALL SELECT ln(1 + price), 'price' FROM census),
    {_BOX} SELECT grp AS "column", * EXCLUDE (grp) FROM box""",
)
def _(t: Tables) -> DataFrame:
    return rounded(charts.log_box_stats(t.census, ["gain", "price"]))


def _capped(columns, uncapped=(), label: str = "income") -> str:
    """SQL cells with top-10 + Other; NULL goes to Other only in columns that are capped."""
    listed = ", ".join(f"'{c}'" for c in uncapped) or "''"
    return f"""WITH {{census}}, long AS ({long_sql(columns, f"{label} AS label", kind="VARCHAR", value="level")}),
    freq AS (SELECT "column", level, count(*) AS n FROM long WHERE level IS NOT NULL GROUP BY ALL),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS place,
             count(*) OVER (PARTITION BY "column") > 10 AND "column" NOT IN ({listed}) AS is_capped FROM freq),
    flags AS (SELECT "column", bool_or(is_capped) AS is_capped FROM ranked GROUP BY "column"),
    leveled AS (
      SELECT l."column", CASE WHEN flags.is_capped AND (k.place IS NULL OR k.place > 10) THEN 'Other' ELSE l.level END AS level, label
      FROM long l JOIN flags ON l."column" = flags."column"
      LEFT JOIN ranked k ON l."column" = k."column" AND l.level = k.level),
    cells AS (SELECT "column", level, label, count(*) AS n FROM leveled WHERE level IS NOT NULL AND label IS NOT NULL GROUP BY ALL),
    lv AS (SELECT "column", level, CAST(sum(n) AS BIGINT) AS level_n FROM cells GROUP BY ALL),
    lb AS (SELECT DISTINCT "column", label FROM cells)"""


def _share_sql(columns, uncapped=(), label: str = "income") -> str:
    return f"""{_capped(columns, uncapped, label)}
    SELECT lv."column", lv.level, lb.label, coalesce(n, 0) AS n, level_n,
           {r("coalesce(n, 0) / CAST(level_n AS DOUBLE)")} AS share
    FROM lv JOIN lb ON lv."column" = lb."column"
    LEFT JOIN cells ON cells."column" = lv."column" AND cells.level = lv.level AND cells.label = lb.label"""


@query("stacked_share", _share_sql(SPEC.share_categories, SPEC.uncapped))
def _(t: Tables) -> DataFrame:
    return rounded(charts.stacked_shares(t.census, SPEC.share_categories, "income", uncapped=SPEC.uncapped))


@query(
    "stacked_share_null_target",
    _share_sql(("brand", "segment"), (), "CASE WHEN size > brand_cut(brand) THEN income END").replace(
        "brand_cut(brand)", "CASE WHEN brand >= 'Brand#3' THEN 40 ELSE 5 END"
    ),
)
def _(t: Tables) -> DataFrame:
    """Most rows of the later brands have no target, yet rank them."""
    cut = F.when(F.col("brand") >= "Brand#3", 40).otherwise(5)
    rows = t.census.withColumn("income", F.when(F.col("size") > cut, F.col("income")))
    return rounded(charts.stacked_shares(rows, ("brand", "segment"), "income"))


_RATE_SQL = f"""{_capped(SPEC.rate_categories)}
    SELECT "column", level, CAST(sum(n) AS BIGINT) AS n,
           {r("sum(CASE WHEN label = '>50K' THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE)")} AS positive_rate,
           row_number() OVER (PARTITION BY "column" ORDER BY sum(CASE WHEN label = '>50K' THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE) DESC, level) AS rate_rank
    FROM cells GROUP BY "column", level ORDER BY "column", rate_rank"""


@query("positive_rate_bar", _RATE_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(charts.positive_rate_bars(t.census, SPEC.rate_categories, "income", ">50K"))


def chart_counts_sql() -> str:
    """Rows of every chart table of the whole analysis."""
    named = {
        "chart_classes": "WITH {census} SELECT DISTINCT income FROM census",
        "chart_heatmap": f"SELECT * FROM range({len(SPEC.numeric) ** 2})",
        "chart_shares": _share_sql(SPEC.share_categories, SPEC.uncapped),
        "chart_rates": _RATE_SQL,
        "chart_log_boxes": f"SELECT * FROM range({len(SPEC.box_log)})",
        "chart_scatter": f"WITH {{census}} SELECT h FROM census LIMIT {SPEC.sample_size}",
    }
    for c in SPEC.histogram_by_target:
        rows = f"SELECT CAST({c} AS DOUBLE) AS value, income AS grp FROM census"
        named |= {f"chart_histogram_{c}": histogram_sql(rows), f"chart_density_{c}": density_sql(rows)}
    for c in SPEC.histogram:
        rows = f"SELECT CAST({c} AS DOUBLE) AS value, 'all' AS grp FROM census"
        named |= {f"chart_histogram_{c}": histogram_sql(rows), f"chart_density_{c}": density_sql(rows)}
    for c in SPEC.box_by_target:
        named[f"chart_boxes_{c}"] = "WITH {census} SELECT DISTINCT income FROM census"
    return " UNION ALL ".join(f"SELECT '{name}' AS chart, count(*) AS n FROM ({sql}) AS t_{name}" for name, sql in named.items())
