from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tallywork.catalog import scan_queries
from tallywork.operators import clean, quality
from tallywork.sources import delimited, sinks
from tallywork.sources.scratch import materialize

SCHEMA = T.StructType(
    [T.StructField("age", T.LongType()), T.StructField("job", T.StringType()), T.StructField("income", T.StringType())]
)


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text("39, Clerk, <=50K\n40, ?, >50K.\n39, Clerk, <=50K\n\n , , \n")
    return str(path)


def test_strict_scan_and_clean(spark, messy):
    raw = delimited.read_strict(spark, messy, SCHEMA)
    assert raw.count() == 3
    cleaned = clean.clean(raw, "income", ["age"])
    assert rows(cleaned, "age") == {
        39: {"age": 39, "job": "Clerk", "income": "<=50K"}, 40: {"age": 40, "job": None, "income": ">50K"}
    }
    again = clean.clean(cleaned, "income", ["age"])
    assert sorted(map(str, again.collect())) == sorted(map(str, cleaned.collect()))
    assert rows(clean.clean_counts(raw, "income")) == [
        {"rows_before": 3, "rows_after": 2, "rows_removed": 1, "raw_duplicates": 1}
    ]


def test_strict_scan_rejects_bad_numbers(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("abc, x, y\n")
    with pytest.raises(Exception):
        delimited.read_strict(spark, str(path), SCHEMA).collect()
    with pytest.raises(Exception):
        delimited.read_strict(spark, str(path), SCHEMA, na_words=["?", "NA"]).collect()


def test_lenient_scan_counts_failures(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("abc,\tX , <=50K\n7, NA, ?\n")
    got = delimited.read_lenient(spark, str(path), SCHEMA, na_words=["?", "NA"], failures="bad")
    assert rows(got, "age") == {
        None: {"age": None, "job": "X", "income": "<=50K", "bad": 1},
        7: {"age": 7, "job": None, "income": None, "bad": 0},
    }
    assert delimited.read_lenient(spark, str(path), SCHEMA, keys=["age"]).count() == 1


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert delimited.require_columns(df, ["n"]) is df
    with pytest.raises(KeyError):
        delimited.require_columns(df, ["missing"])
    assert delimited.require_numeric(df, ["n"]) is df
    with pytest.raises(TypeError):
        delimited.require_numeric(df, ["s"])
    assert [r["type"] for r in rows(quality.column_types(df))] == ["int", "string"]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    path = sinks.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.schema(df.schema).csv(path, header=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert materialize(df, "test").columns == df.columns
    tidy = sinks.to_tidy(df, "demo", ["n"])
    stored = spark.read.parquet(sinks.write_results(tidy, str(tmp_path / "results")))
    assert rows(stored, "item")["1"]["value_string"] == "a"


def test_full_outer_reconciliation(spark):
    left = spark.createDataFrame([("a", None), ("b", "x")], "t string, k string")
    right = spark.createDataFrame([("a", "x"), ("c", "x"), ("c", "x")], "t string, k string")
    got = rows(quality.reconcile(left, right, ["k"], "t"), "check_name", "item")
    assert (got["category", "c"]["left_value"], got["category", "c"]["right_value"]) == (0, 2)
    assert got["distinct_rows", ""]["matches"] is True
    assert got["rows", ""]["matches"] is False
    assert (got["missing", "k"]["left_value"], got["missing", "k"]["right_value"]) == (1, 0)


def test_written_lines_are_compressed_in_short_files(spark, monkeypatch):
    monkeypatch.setattr(scan_queries, "LINES_PER_FILE", 100)
    names = [c for c in scan_queries.FILE_COLUMNS if c not in ("l_orderkey", "brand")]
    df = spark.range(0, 450, 1, 1).select(
        F.col("id").alias("l_orderkey"), F.when(F.col("id") % 2 == 0, "b").alias("brand"), *[F.lit(1).alias(c) for c in names],
        F.when(F.col("id") == 0, "00").when(F.col("id") == 1, "ff").otherwise("a").alias("h"),
    )
    path = scan_queries._write_lines(df, {}, "lines")
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    files = [r.asDict() for r in lines.groupBy("file").count().collect()]
    assert len(files) == 5 and all(r["file"].endswith(".gz") and r["count"] <= 100 for r in files)
    assert lines.count() == 452 and lines.where("value = ''").count() == 1 and lines.where("value LIKE '0, %'").count() == 2
