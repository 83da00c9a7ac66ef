"""Scans, sinks, cleaning and row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.catalog.census import KEYS, SPEC
from tallywork.catalog.registry import Tables, query, rounded
from tallywork.functions.columns import col, indicator, recode
from tallywork.functions.numeric import half_even
from tallywork.operators import categorical, clean, multisets, quality
from tallywork.operators.frequency import category_frequencies
from tallywork.operators.numeric import outlier_rows
from tallywork.sources import delimited, quarantine, sinks
from tallywork.sources.scratch import new_path, shuffles_dropped

FILE_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType() if k == "l_linenumber" else T.LongType()) for k in KEYS]
    + [
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("size", T.IntegerType()),
    ]
    + [T.StructField(c, T.StringType()) for c in ("brand", "segment", "type", "priority", "flag", "income")]
)
FILE_COLUMNS = FILE_SCHEMA.fieldNames()
LINES_PER_FILE = sinks.LINES_PER_FILE
_SQL_COLUMNS = ", ".join(FILE_COLUMNS[:-1])
_DOTTED = "CASE WHEN substr(h, 1, 1) IN ('0', '1', '2', '3', '4') THEN income || '.' ELSE income END"


def _starts(*prefixes: str) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.col("h").startswith(p)
    return hit


def _write_lines(df: DataFrame, values: dict[str, Column], label: str, short: str | None = None) -> str:
    """Comma-and-blank separated lines: '?' for NULL, some lines twice, some blank lines; five values only where ``short`` starts the key."""
    fields = [F.coalesce(values.get(c, col(c)).cast("string"), F.lit("?")) for c in FILE_COLUMNS]
    line = F.concat_ws(", ", *fields)
    if short is not None:
        line = F.when(_starts(short), F.substring_index(line, ", ", 5)).otherwise(line)
    lines = F.when(_starts("00"), F.array(line, line)).when(_starts("ff"), F.array(line, F.lit(""))).otherwise(
        F.array(line)
    )
    path = new_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.select(F.explode(lines).alias("value")).write.options(**sinks.PACKED_TEXT | {"maxRecordsPerFile": str(LINES_PER_FILE)}).text(path)
    return path


def _dotted_target() -> Column:
    return F.when(_starts("0", "1", "2", "3", "4"), F.concat("income", F.lit("."))).otherwise(F.col("income"))


def messy_file(t: Tables, view: DataFrame | None = None) -> str:
    """The census records (``view``, where they are stored already) as a headerless text file with repeated, dotted and blank lines."""
    return _write_lines(t.census if view is None else view, {"income": _dotted_target()}, "messy")


def damaged_file(t: Tables, short: str | None = None, view: DataFrame | None = None) -> str:
    """As :func:`messy_file`, with unreadable sizes, padded brands and missing keys added, and short lines on demand."""
    padded = F.when(_starts("e"), F.concat(F.lit("\t "), F.col("brand"), F.lit(" \t"))).otherwise(F.col("brand"))
    return _write_lines(
        t.census if view is None else view,
        {
            "size": F.when(_starts("f"), F.lit("many")).otherwise(F.col("size").cast("string")),
            "brand": padded,
            "l_orderkey": F.when(~_starts("dd"), F.col("l_orderkey")),
            "income": _dotted_target(),
        },
        "damaged",
        short,
    )


_RAW_SQL = f"SELECT {_SQL_COLUMNS}, {_DOTTED} AS income, h FROM census"


@query(
    "csv_strict_scan",
    f"""WITH {{census}}, raw AS ({_RAW_SQL})
    SELECT {_SQL_COLUMNS}, income FROM raw
    UNION ALL SELECT {_SQL_COLUMNS}, income FROM raw WHERE h LIKE '00%'""",
)
def _(t: Tables) -> DataFrame:
    return delimited.read_strict(t.spark, messy_file(t), FILE_SCHEMA)


_LENIENT_COLUMNS = _SQL_COLUMNS.replace("size", "CASE WHEN h LIKE 'f%' THEN NULL ELSE size END AS size")


@query(
    "csv_lenient_scan",
    f"""WITH {{census}}, raw AS (
      SELECT {_LENIENT_COLUMNS}, {_DOTTED} AS income,
             CASE WHEN h LIKE 'f%' THEN 1 ELSE 0 END AS cast_failures, h
      FROM census WHERE h NOT LIKE 'dd%')
    SELECT {_SQL_COLUMNS}, income, cast_failures FROM raw
    UNION ALL SELECT {_SQL_COLUMNS}, income, cast_failures FROM raw WHERE h LIKE '00%'""",
)
def _(t: Tables) -> DataFrame:
    return delimited.read_lenient(
        t.spark, damaged_file(t), FILE_SCHEMA, keys=["l_orderkey"], failures="cast_failures"
    )


@query("drop_all_null", "WITH {census} SELECT brand, segment FROM census WHERE brand IS NOT NULL OR segment IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return delimited.drop_all_null(t.census.select("brand", "segment"))


@query("drop_null_key", "WITH {census} SELECT h, brand, segment FROM census WHERE brand IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return delimited.drop_null_key(t.census.select("h", "brand", "segment"), ["brand"])


@query("format_clean", f"WITH {{census}} SELECT DISTINCT {_SQL_COLUMNS}, income FROM census")
def _(t: Tables) -> DataFrame:
    raw = delimited.read_strict(t.spark, messy_file(t), FILE_SCHEMA)
    return clean.clean(raw, "income", ("quantity", "price", "discount", "gain", "size"))


@query(
    "clean_counts",
    """WITH {census}, c AS (SELECT count(*) AS kept, count(*) FILTER (WHERE h LIKE '00%') AS twice FROM census),
    d AS (SELECT count(*) AS distinct_kept FROM (SELECT DISTINCT * EXCLUDE (h) FROM census))
    SELECT kept + twice AS rows_before, distinct_kept AS rows_after,
           kept + twice - distinct_kept AS rows_removed, kept + twice - distinct_kept AS raw_duplicates
    FROM c, d""",
)
def _(t: Tables) -> DataFrame:
    return clean.clean_counts(delimited.read_strict(t.spark, messy_file(t), FILE_SCHEMA), "income")


@query("csv_roundtrip", f"WITH {{census}} SELECT {_SQL_COLUMNS}, income FROM census")
def _(t: Tables) -> DataFrame:
    path = sinks.write_csv(t.census.select(*FILE_COLUMNS), new_path(t.spark, "csv"))
    return t.spark.read.schema(FILE_SCHEMA).csv(path, header=True)


@query(
    "text_normalise",
    "WITH {census} SELECT h, brand, segment, income FROM census",
)
def _(t: Tables) -> DataFrame:
    padded = t.census.select(
        "h",
        F.concat(F.lit("\t "), F.col("brand"), F.lit("  ")).alias("brand"),
        F.concat(F.lit("  "), F.col("segment")).alias("segment"),
        F.concat(F.lit(" "), F.col("income"), F.lit(".. ")).alias("income"),
    )
    return clean.normalise_text(padded, target="income")


@query("dedup_rows", "SELECT DISTINCT text, lang, source FROM documents")
def _(t: Tables) -> DataFrame:
    return clean.distinct_rows(t.read("documents").select("text", "lang", "source"))


@query(
    "duplicate_count",
    """SELECT count(*) AS row_count, count(DISTINCT text) AS distinct_rows,
              count(*) - count(DISTINCT text) AS duplicate_rows FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return clean.duplicate_count(t.read("documents"), ["text"])


@query(
    "unexpected_values",
    """WITH {census} SELECT priority AS value, count(*) AS n FROM census
    WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY priority""",
)
def _(t: Tables) -> DataFrame:
    return clean.unexpected_values(t.census, "priority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("group_filter", "WITH {census} SELECT h, flag, income FROM census WHERE flag = 'R'")
def _(t: Tables) -> DataFrame:
    return clean.equal_rows(t.census.select("h", "flag", "income"), "flag", "R")


@query(
    "complete_cases",
    "WITH {census} SELECT brand, segment, income FROM census WHERE brand IS NOT NULL AND segment IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    return clean.complete_rows(t.census, ["brand", "segment", "income"])


@query("outside_range", "WITH {census} SELECT h, price FROM census WHERE price < 1000.0E0 OR price > 100000.0E0")
def _(t: Tables) -> DataFrame:
    return clean.outside_range(t.census.select("h", "price"), "price", 1000.0, 100000.0)


@query(
    "outlier_rows",
    """WITH events_long AS (SELECT event_id, value FROM events WHERE value IS NOT NULL),
    b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events_long)
    SELECT event_id, 'value' AS "column", value FROM events_long, b
    WHERE value < q1 - 1.5E0 * (q3 - q1) OR value > q3 + 1.5E0 * (q3 - q1)""",
)
def _(t: Tables) -> DataFrame:
    return outlier_rows(t.read("events"), ["value"], ["event_id"])


@query(
    "target_recode",
    """WITH {census} SELECT h, CASE income WHEN '>50K' THEN 1 WHEN '<=50K' THEN 0 END AS label,
    CASE WHEN brand = 'Brand#2' THEN 1 ELSE 0 END AS is_brand_2 FROM census""",
)
def _(t: Tables) -> DataFrame:
    return t.census.select(
        "h", recode(F.col("income"), SPEC.target_mapping).alias("label"),
        indicator(F.col("brand"), "Brand#2").alias("is_brand_2"),
    )


@query(
    "preview_rows",
    """WITH {census} SELECT h, quantity, round(price, 6) AS price, brand, income
    FROM census ORDER BY h, price LIMIT 5""",
)
def _(t: Tables) -> DataFrame:
    return rounded(clean.first_rows(t.census.select("h", "quantity", "price", "brand", "income"), ["h", "price"], 5))


_VIEW_COLUMNS = (
    *KEYS, "h", "quantity", "price", "discount", "gain", "size", "brand", "segment", "type", "priority", "flag",
    "returned", "income",
)


OVERVIEW_SQL = (
    """WITH {census}, d AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM census))
    SELECT 'table' AS item, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM census
    UNION ALL SELECT 'table', 'columns', 17.0E0
    UNION ALL SELECT 'table', 'duplicate_rows', CAST((SELECT count(*) FROM census) - k AS DOUBLE) FROM d """
    + " ".join(
        f"UNION ALL SELECT '{c}', 'missing', CAST(count(*) - count({c}) AS DOUBLE) FROM census" for c in _VIEW_COLUMNS
    )
    + " "
    + " ".join(
        f"UNION ALL SELECT '{c}', 'missing_pct', round(100.0E0 * (count(*) - count({c})) / count(*), 6) FROM census"
        for c in SPEC.key_missing
    )
)


@query("overview_counts", OVERVIEW_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(quality.overview(t.census, SPEC.key_missing))


@query(
    "missing_rate",
    """WITH {census}
    SELECT 'brand' AS "column", count(*) - count(brand) AS missing,
           round(100.0E0 * (count(*) - count(brand)) / count(*), 6) AS missing_pct FROM census
    UNION ALL SELECT 'segment', count(*) - count(segment),
           round(100.0E0 * (count(*) - count(segment)) / count(*), 6) FROM census
    UNION ALL SELECT 'price', count(*) - count(price),
           round(100.0E0 * (count(*) - count(price)) / count(*), 6) FROM census""",
)
def _(t: Tables) -> DataFrame:
    return rounded(quality.missing(t.census, ["brand", "segment", "price"]))


@query(
    "missing_labels",
    """SELECT 'quality' AS "column", count(*) - count(quality) AS missing,
              round(100.0E0 * (count(*) - count(quality)) / count(*), 6) AS missing_pct
    FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'toxic', count(*) - count(toxic),
              round(100.0E0 * (count(*) - count(toxic)) / count(*), 6)
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(t: Tables) -> DataFrame:
    joined = t.read("documents").select("doc_id").join(t.read("labels"), "doc_id", "left")
    return rounded(quality.missing(joined, ["quality", "toxic"]))


@query(
    "reconcile",
    f"""WITH {{census}}, strict_rows AS (
      SELECT {_SQL_COLUMNS}, {_DOTTED} AS income, 1 + CAST(h LIKE '00%' AS INT) AS copies FROM census),
    lenient_rows AS (
      SELECT {_LENIENT_COLUMNS}, {_DOTTED} AS income, 1 + CAST(h LIKE '00%' AS INT) AS copies
      FROM census WHERE h NOT LIKE 'dd%'),
    a AS (
      SELECT 'rows' AS check_name, '' AS item, CAST(sum(copies) AS BIGINT) AS value FROM strict_rows
      UNION ALL SELECT 'columns', '', 15
      UNION ALL SELECT 'missing', 'brand', CAST(sum(CASE WHEN brand IS NULL THEN copies ELSE 0 END) AS BIGINT) FROM strict_rows
      UNION ALL SELECT 'missing', 'segment', CAST(sum(CASE WHEN segment IS NULL THEN copies ELSE 0 END) AS BIGINT) FROM strict_rows
      UNION ALL SELECT 'category', income, CAST(sum(copies) AS BIGINT) FROM strict_rows GROUP BY income
      UNION ALL SELECT 'distinct_rows', '', (SELECT count(*) FROM (SELECT DISTINCT {_SQL_COLUMNS}, income FROM strict_rows))),
    b AS (
      SELECT 'rows' AS check_name, '' AS item, CAST(sum(copies) AS BIGINT) AS value FROM lenient_rows
      UNION ALL SELECT 'columns', '', 15
      UNION ALL SELECT 'missing', 'brand', CAST(sum(CASE WHEN brand IS NULL THEN copies ELSE 0 END) AS BIGINT) FROM lenient_rows
      UNION ALL SELECT 'missing', 'segment', CAST(sum(CASE WHEN segment IS NULL THEN copies ELSE 0 END) AS BIGINT) FROM lenient_rows
      UNION ALL SELECT 'category', income, CAST(sum(copies) AS BIGINT) FROM lenient_rows GROUP BY income
      UNION ALL SELECT 'distinct_rows', '', (SELECT count(*) FROM (SELECT DISTINCT {_SQL_COLUMNS}, income FROM lenient_rows)))
    SELECT check_name, item, coalesce(a.value, 0) AS left_value, coalesce(b.value, 0) AS right_value,
           coalesce(a.value, 0) = coalesce(b.value, 0) AS matches
    FROM a FULL OUTER JOIN b USING (check_name, item)""",
)
def _(t: Tables) -> DataFrame:
    view = t.stored_census  # joined once for both files
    strict = delimited.read_strict(t.spark, messy_file(t, view), FILE_SCHEMA)
    lenient = delimited.read_lenient(t.spark, damaged_file(t, view=view), FILE_SCHEMA, keys=["l_orderkey"])
    return quality.reconcile(strict, lenient, SPEC.key_missing, "income")


@query(
    "csv_quarantine",
    f"""WITH {{census}}, lines AS (
      SELECT h, size, CASE WHEN h LIKE 'dd%' THEN NULL ELSE l_orderkey END AS l_orderkey, 1 + CAST(h LIKE '00%' AS INT) AS copies FROM census),
    told AS (
      SELECT '' AS "column", '{quarantine.WRONG_COUNT}' AS reason, l_orderkey, copies FROM lines WHERE h LIKE '7e%'
      UNION ALL SELECT 'size', '{quarantine.UNREADABLE}', l_orderkey, copies FROM lines WHERE h LIKE 'f%'
      UNION ALL SELECT 'l_orderkey', '{quarantine.NO_KEY}', l_orderkey, copies FROM lines WHERE h LIKE 'dd%'
      UNION ALL SELECT '', 'good', l_orderkey, copies FROM lines WHERE h NOT LIKE '7e%' AND h NOT LIKE 'f%' AND h NOT LIKE 'dd%')
    SELECT "column", reason, CAST(sum(copies) AS BIGINT) AS n, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
    FROM told GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    """Good rows, and rejected lines by column and reason with the keys that stand in their text."""
    good, rejected = quarantine.scan_with_rejects(t.spark, damaged_file(t, short="7e"), FILE_SCHEMA, keys=["l_orderkey"])
    told = rejected.select("column", "reason", F.substring_index("line", ",", 1).try_cast("bigint").alias("key"))
    both = told.unionByName(good.select(F.lit("").alias("column"), F.lit("good").alias("reason"), F.col("l_orderkey").alias("key")))
    return both.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


_COMPARED = ["l_orderkey", "l_linenumber", "quantity", "brand", "priority", "income"]


def _two_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The view, and a version of as many rows in which some differ and some stand for others."""
    left = t.stored_census.select("h", *_COMPARED)
    right = left.withColumn("quantity", F.when(_starts("abc"), F.col("quantity") + 1).otherwise(F.col("quantity")))
    right = right.withColumn("brand", F.when(_starts("0d1"), F.lit(None).cast("string")).otherwise(F.col("brand")))
    return left.drop("h"), right.drop("h")


_VERSIONS_SQL = f"""WITH {{census}}, a AS (SELECT {", ".join(_COMPARED)} FROM census),
    b AS (
      SELECT l_orderkey, l_linenumber, CASE WHEN h LIKE 'abc%' THEN quantity + 1 ELSE quantity END AS quantity,
        CASE WHEN h LIKE '0d1%' THEN NULL ELSE brand END AS brand, priority, income FROM census)"""
_DIGEST_SQL = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in _COMPARED
) + "))"


@query(
    "reconcile_ranges",
    f"""{_VERSIONS_SQL}, x AS (SELECT {_DIGEST_SQL} AS d FROM a), y AS (SELECT {_DIGEST_SQL} AS d FROM b),
    p AS (SELECT substr(d, 1, 2) AS range, count(*) AS n, list(d ORDER BY d) AS rows FROM x GROUP BY 1),
    q AS (SELECT substr(d, 1, 2) AS range, count(*) AS n, list(d ORDER BY d) AS rows FROM y GROUP BY 1)
    SELECT range, coalesce(p.n, 0) AS left_rows, coalesce(q.n, 0) AS right_rows, p.rows IS NOT DISTINCT FROM q.rows AS matches
    FROM p FULL OUTER JOIN q USING (range)""",
)
def _(t: Tables) -> DataFrame:
    """The twin compares sorted lists of digests, not sums."""
    return multisets.compare_ranges(*_two_versions(t), _COMPARED)


@query(
    "reconcile_rows",
    f"""{_VERSIONS_SQL}, p AS (SELECT *, count(*) AS n FROM a GROUP BY ALL), q AS (SELECT *, count(*) AS n FROM b GROUP BY ALL)
    SELECT coalesce(p.l_orderkey, q.l_orderkey) AS l_orderkey, coalesce(p.l_linenumber, q.l_linenumber) AS l_linenumber,
      coalesce(p.quantity, q.quantity) AS quantity, coalesce(p.brand, q.brand) AS brand, coalesce(p.priority, q.priority) AS priority,
      coalesce(p.income, q.income) AS income, coalesce(p.n, 0) AS left_n, coalesce(q.n, 0) AS right_n
    FROM p FULL OUTER JOIN q ON {" AND ".join(f"p.{c} IS NOT DISTINCT FROM q.{c}" for c in _COMPARED)}
    WHERE coalesce(p.n, 0) <> coalesce(q.n, 0)""",
)
def _(t: Tables) -> DataFrame:
    return multisets.differing_rows(*_two_versions(t), _COMPARED)


def _preview_sql() -> str:
    parts = []
    for c in _VIEW_COLUMNS:
        text = c in ("h", "brand", "segment", "type", "priority", "flag", "returned", "income")
        number, word = ("CAST(NULL AS DOUBLE)", c) if text else (f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)")
        parts.append(f"SELECT 'preview', CAST(place AS VARCHAR), '{c}', {number}, {word} FROM firsts WHERE {c} IS NOT NULL")
    return " UNION ALL ".join(parts)


@query(
    "overview_full",
    f"""WITH {{census}}, facts AS ({OVERVIEW_SQL.replace("WITH {census}", "WITH inner_d AS (SELECT 1)", 1)}),
    firsts AS (SELECT *, row_number() OVER (ORDER BY h, l_orderkey, l_linenumber) AS place FROM census QUALIFY place <= 5)
    SELECT 'facts' AS part, item, metric, value AS number, CAST(NULL AS VARCHAR) AS text FROM facts
    UNION ALL {_preview_sql()}""",
)
def _(t: Tables) -> DataFrame:
    """Facts and preview; what Spark calls a type has no twin and is left to a test."""
    return rounded(quality.overview_report(t.stored_census, ["h", "l_orderkey", "l_linenumber"], SPEC.key_missing).where("part <> 'types'"))


@query(
    "rates_half_even",
    """WITH {census}, k AS (SELECT brand AS category, count(*) AS n, count(*) FILTER (WHERE income = '>50K') AS positive_n FROM census WHERE brand IS NOT NULL GROUP BY brand)
    SELECT category, n, round_even(100.0E0 * positive_n / n, 1) AS positive_pct, CAST(round_even(CAST(n AS DECIMAL(18, 1)) / 100 * 10, 0) AS BIGINT) AS tens FROM k""",
)
def _(t: Tables) -> DataFrame:
    """Rates as a report prints them: one digit, ties to the even one."""
    rates = categorical.positive_rates(category_frequencies(t.census, ["brand"], "income", ">50K")).where("category IS NOT NULL")
    return rates.select("category", "n", half_even(F.col("positive_pct"), 1).alias("positive_pct"), half_even(F.col("n") / F.lit(10.0), 0).cast("bigint").alias("tens"))


@query(
    "checked_scan",
    f"""WITH {{census}}, raw AS ({_RAW_SQL}), twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE h LIKE '00%')
    SELECT income, count(*) AS n, sum(size) AS sizes FROM twice GROUP BY income""",
)
def _(t: Tables) -> DataFrame:
    """A scan whose needed columns, numeric types and readable values are checked before anything is counted."""
    loaded = delimited.read_lenient(t.spark, messy_file(t), FILE_SCHEMA, keys=["l_orderkey"], failures="cast_failures")
    loaded = delimited.require_readable(loaded, "cast_failures")
    loaded = delimited.require_numeric(delimited.require_columns(loaded, [*KEYS, *SPEC.numeric, "income"]), SPEC.numeric)
    return loaded.groupBy("income").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("sizes"))
