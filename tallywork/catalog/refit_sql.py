"""SQL that finds the optimum of the penalised logistic objective anew, from the census view alone.

The objective, 1/2 |w|^2 + sum of class-weighted losses with a free intercept, has one optimum, so a fit is
proven by its values: coefficients, predictions and metrics must be those of the SQL. Newton's method
is written out step by step; each step's linear system is solved by elimination, one pivot per round of a
recursive table.
"""

from __future__ import annotations

from tallywork.catalog.census import SPEC
from tallywork.catalog.registry import long_sql
from tallywork.catalog.split_queries import SPLIT_SQL

STEPS = 9
NUM, CAT = SPEC.model_numeric, SPEC.model_categorical


def _order(columns) -> str:
    return ", ".join(f"('{c}', {i})" for i, c in enumerate(columns))


# Features as (h, j, x): slot 0 is the intercept, then scaled numbers, then one slot per category seen in train.
_FEATURES = f"""train AS (SELECT * FROM split_rows WHERE split = 'train'),
nums AS ({long_sql(NUM, "h, split", source="split_rows")}),
filled AS (
  SELECT h, split, n."column", coalesce(value, median) AS value FROM nums n
  JOIN (SELECT "column", quantile_cont(value, 0.5) AS median FROM nums WHERE split = 'train' GROUP BY "column") m ON m."column" = n."column"),
scales AS (
  SELECT "column", avg(value) AS mean, CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0E0 END AS scale
  FROM filled WHERE split = 'train' GROUP BY "column"),
words AS ({long_sql(CAT, "h, split", source="split_rows", kind="VARCHAR", value="category")}),
counted AS (SELECT "column", category, count(*) AS n FROM words WHERE split = 'train' AND category IS NOT NULL GROUP BY ALL),
modes AS (SELECT "column", category FROM counted QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, category) = 1),
numbered AS (SELECT * FROM (VALUES {_order(NUM)}) AS t("column", pos)),
listed AS (SELECT * FROM (VALUES {_order(CAT)}) AS t("column", pos)),
slots AS (
  SELECT c."column", category, {len(NUM)} + row_number() OVER (ORDER BY pos, category) AS j FROM counted c JOIN listed l ON l."column" = c."column"),
features AS MATERIALIZED (
  SELECT h, split, 0 AS j, 1.0E0 AS x FROM split_rows
  UNION ALL SELECT h, split, pos + 1, (value - mean) / scale FROM filled f JOIN scales s ON s."column" = f."column" JOIN numbered m ON m."column" = f."column"
  UNION ALL SELECT h, split, j, 1.0E0 FROM words w JOIN modes m ON m."column" = w."column"
    JOIN slots s ON s."column" = w."column" AND s.category = coalesce(w.category, m.category)),
names AS (
  SELECT 0 AS j, 'intercept' AS feature UNION ALL SELECT pos + 1, "column" FROM numbered
  UNION ALL SELECT j, "column" || '=' || category FROM slots),
classes AS (SELECT income, count(*) AS n FROM train GROUP BY income),
labels AS MATERIALIZED (
  SELECT h, split, CASE WHEN t.income = '{SPEC.positive}' THEN 1 ELSE 0 END AS y, (SELECT sum(n) FROM classes) / (2.0E0 * n) AS weight, {SPEC.group}
  FROM split_rows t JOIN classes c ON c.income = t.income),
x AS MATERIALIZED (SELECT h, j, x FROM features WHERE split = 'train'),
cells AS MATERIALIZED (SELECT a.j AS j, b.j AS k FROM names a, names b),
b0 AS MATERIALIZED (SELECT j, 0.0E0 AS b FROM names)"""


def _step(t: int) -> str:
    """One Newton step from b{t} to b{t + 1}, and the gradient g{t} at b{t}."""
    return f"""
z{t} AS (SELECT h, sum(x * b) AS z FROM x JOIN b{t} USING (j) GROUP BY h),
p{t} AS MATERIALIZED (SELECT h, weight * (1 / (1 + exp(-z)) - y) AS g, weight / ((1 + exp(-z)) * (1 + exp(z))) AS v FROM z{t} JOIN labels USING (h)),
g{t} AS MATERIALIZED (
  SELECT j, sum(g * x) + CASE WHEN j = 0 THEN 0 ELSE any_value(b) END AS g FROM x JOIN p{t} USING (h) JOIN b{t} USING (j) GROUP BY j),
c{t} AS (SELECT l.j, r.j AS k, sum(v * l.x * r.x) AS c FROM x l JOIN x r USING (h) JOIN p{t} USING (h) GROUP BY ALL),
m{t} AS MATERIALIZED (
  SELECT list(r ORDER BY j) AS m FROM (
    SELECT j, list_append(list(coalesce(c, 0) + CASE WHEN j = k AND j > 0 THEN 1 ELSE 0 END ORDER BY k), any_value(g)) AS r
    FROM cells LEFT JOIN c{t} USING (j, k) JOIN g{t} USING (j) GROUP BY j)),
e{t} AS (
  SELECT 1 AS pos, m FROM m{t}
  UNION ALL SELECT pos + 1, list_transform(m, lambda r, i: CASE WHEN i = pos THEN list_transform(r, lambda v: v / m[pos][pos])
    ELSE list_transform(r, lambda v, q: v - r[pos] / m[pos][pos] * m[pos][q]) END) FROM e{t} WHERE pos <= len(m)),
b{t + 1} AS MATERIALIZED (
  SELECT j, b - m[j + 1][-1] AS b FROM b{t}, (SELECT m FROM e{t} ORDER BY pos DESC LIMIT 1))"""


def _refit() -> str:
    steps = ",".join(_step(t) for t in range(STEPS))
    return f"{SPLIT_SQL.replace('WITH ', 'WITH RECURSIVE ', 1)},\n{_FEATURES},{steps}"


REFIT_SQL = f"""{_refit()},
scored AS MATERIALIZED (
  SELECT h, any_value(y) AS label, sum(x * b) AS margin, CASE WHEN sum(x * b) > 0 THEN 1 ELSE 0 END AS prediction, any_value({SPEC.group}) AS {SPEC.group}
  FROM features f JOIN b{STEPS} USING (j) JOIN labels l USING (h) WHERE f.split = 'test' GROUP BY h)"""
LAST = STEPS
