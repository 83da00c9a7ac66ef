"""Splitting, sampling, and evaluation on a deterministic score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import Tables, query, r, rounded
from tallywork.operators import charts, evaluate, split

# SQL of the exact stratified split: quota per class, then the first rows in hash order.
SPLIT_SQL = """WITH {census}, hashed_rows AS (SELECT *, md5(concat_ws('|', h, '42')) AS hh FROM census),
    sizes AS (SELECT income, count(*) AS n FROM census GROUP BY income),
    want AS (SELECT ceil(sum(n) * 0.2E0) AS k, CAST(sum(n) AS DOUBLE) AS rows_n FROM sizes),
    exact AS (SELECT income, n, n * (k / rows_n) AS x, k FROM sizes, want),
    quota AS (
      SELECT income, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, income)
                                          <= k - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q FROM exact),
    placed AS (
      SELECT c.*, row_number() OVER (PARTITION BY c.income ORDER BY hh, price) AS place, q
      FROM hashed_rows c JOIN quota ON c.income = quota.income),
    split_rows AS (SELECT *, CASE WHEN place <= q THEN 'test' ELSE 'train' END AS split FROM placed)"""


def census_split(t: Tables) -> DataFrame:
    return split.stratified_split(t.stored_census, "income", SPEC.key, SPEC.test_size, SPEC.seed, ties=("price",))


@query("stratified_split_counts", f"{SPLIT_SQL} SELECT income, split, count(*) AS n FROM split_rows GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return census_split(t).groupBy("income", "split").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_split_rows", f"{SPLIT_SQL} SELECT h, quantity, income, split FROM split_rows")
def _(t: Tables) -> DataFrame:
    return census_split(t).select("h", "quantity", "income", "split")


@query(
    "fixed_sample",
    """WITH {census} SELECT h, quantity, brand, income FROM census
    ORDER BY md5(concat_ws('|', h, '42')), price LIMIT 5000""",
)
def _(t: Tables) -> DataFrame:
    return split.fixed_sample(t.census, SPEC.key, 5000, 42, ties=("price",)).select("h", "quantity", "brand", "income")


@query(
    "scatter_points",
    """WITH {census} SELECT quantity, round(price, 6) AS price, income, brand, segment, type FROM census
    ORDER BY md5(concat_ws('|', h, '42')), price LIMIT 5000""",
)
def _(t: Tables) -> DataFrame:
    columns = ["quantity", "price", "income", "brand", "segment", "type"]
    return rounded(charts.scatter_points(t.census, columns, SPEC.key, 5000, 42, ties=("price",)))


def scored(t: Tables) -> DataFrame:
    """Census rows with a score that needs no model: half weight on quantity, half on priority."""
    urgent = F.when(F.col("priority").isin("1-URGENT", "2-HIGH"), F.lit(0.5)).otherwise(F.lit(0.0))
    rows = t.census.select(
        "flag", "returned", F.when(F.col("income") == ">50K", 1).otherwise(0).alias("label"),
        (F.col("quantity") / F.lit(100.0) + urgent).alias("score"),
    )
    return rows.withColumn("prediction", F.when(F.col("score") >= 0.7, 1).otherwise(0))


_SCORED = """WITH {census}, scored0 AS (
      SELECT flag, returned, CASE WHEN income = '>50K' THEN 1 ELSE 0 END AS label,
             quantity / 100.0E0 + CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 0.5E0 ELSE 0.0E0 END AS score
      FROM census),
    scored AS (SELECT *, CASE WHEN score >= 0.7E0 THEN 1 ELSE 0 END AS prediction FROM scored0)"""

_OUTCOMES = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn"""

_O = f"{_SCORED}, o AS (SELECT {_OUTCOMES} FROM scored)"


def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0E0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


@query(
    "confusion",
    f"""{_O} SELECT 1 AS actual, 1 AS predicted, tp AS n FROM o UNION ALL SELECT 1, 0, fn FROM o
    UNION ALL SELECT 0, 1, fp FROM o UNION ALL SELECT 0, 0, tn FROM o""",
)
def _(t: Tables) -> DataFrame:
    return evaluate.confusion(scored(t))


@query(
    "binary_metrics",
    f"""{_O} SELECT tp + fn + fp + tn AS n, {r(_div('(tp + tn)', '(tp + fn + fp + tn)'))} AS accuracy,
      {r(_div('tp', '(tp + fp)'))} AS precision, {r(_div('tp', '(tp + fn)'))} AS recall,
      {r(_div('2 * tp', '(2 * tp + fp + fn)'))} AS f1_score FROM o""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.binary_metrics(scored(t)))


@query(
    "class_report",
    f"""{_O}, m AS (
      SELECT {_div('tp', '(tp + fp)')} AS p1, {_div('tp', '(tp + fn)')} AS r1, {_div('2 * tp', '(2 * tp + fp + fn)')} AS f1,
             {_div('tn', '(tn + fn)')} AS p0, {_div('tn', '(tn + fp)')} AS r0, {_div('2 * tn', '(2 * tn + fp + fn)')} AS f0,
             tp + fn AS s1, tn + fp AS s0, {_div('(tp + tn)', '(tp + fn + fp + tn)')} AS acc FROM o)
    SELECT '<=50K' AS class, {r('p0')} AS precision, {r('r0')} AS recall, {r('f0')} AS f1_score, s0 AS support FROM m
    UNION ALL SELECT '>50K', {r('p1')}, {r('r1')}, {r('f1')}, s1 FROM m
    UNION ALL SELECT 'accuracy', {r('acc')}, {r('acc')}, {r('acc')}, s0 + s1 FROM m
    UNION ALL SELECT 'macro avg', {r('(p0 + p1) / 2')}, {r('(r0 + r1) / 2')}, {r('(f0 + f1) / 2')}, s0 + s1 FROM m
    UNION ALL SELECT 'weighted avg', {r('(p0 * s0 + p1 * s1) / (s0 + s1)')}, {r('(r0 * s0 + r1 * s1) / (s0 + s1)')},
      {r('(f0 * s0 + f1 * s1) / (s0 + s1)')}, s0 + s1 FROM m""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.class_report(scored(t), names=("<=50K", ">50K")))


@query(
    "group_performance",
    f"""{_SCORED}, o AS (SELECT flag, {_OUTCOMES} FROM scored GROUP BY flag)
    SELECT flag AS "group", tp + fn + fp + tn AS n, {r(_div('(tp + tn)', '(tp + fn + fp + tn)'))} AS accuracy,
      {r(_div('2 * tp', '(2 * tp + fp + fn)'))} AS f1_score,
      {r(_div('(tp + fp)', '(tp + fn + fp + tn)'))} AS positive_pred_ratio FROM o""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.group_performance(scored(t), "flag"))


_CURVE = f"""{_SCORED}, g AS (
      SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM scored GROUP BY score),
    c AS (
      SELECT score, pos, neg, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all,
             sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
             lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg,
             row_number() OVER (ORDER BY score DESC) AS place
      FROM g)"""


@query(
    "roc_auc",
    f"""{_CURVE} SELECT CAST(any_value(p_all) AS BIGINT) AS positives, CAST(any_value(n_all) AS BIGINT) AS negatives,
      {r('sum(CAST(pos AS DOUBLE) * (neg_below + neg / 2.0E0)) / (any_value(CAST(p_all AS DOUBLE)) * any_value(n_all))')} AS roc_auc
    FROM c""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.roc_auc(scored(t)))


_POINTS = f"""SELECT {r('score')} AS threshold, {r('CAST(fp AS DOUBLE) / n_all')} AS fpr,
      {r('CAST(tp AS DOUBLE) / p_all')} AS tpr FROM c"""


@query("roc_points", f"{_CURVE} {_POINTS} UNION ALL SELECT NULL, 0.0E0, 0.0E0")
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.roc_points(scored(t)))


@query(
    "roc_points_bends",
    f"""{_CURVE} {_POINTS} WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
    UNION ALL SELECT NULL, 0.0E0, 0.0E0""",
)
def _(t: Tables) -> DataFrame:
    return rounded(evaluate.roc_points(scored(t), drop_collinear=True))
