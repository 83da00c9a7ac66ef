"""Headerless delimited files: a strict scan, a lenient scan, and checks on the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import col
from tallywork.functions.text import sentinel_to_null, strip


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Remove rows in which every column is NULL."""
    return df.na.drop("all")


def drop_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove rows in which a key column is NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & col(key).isNotNull()
    return df.where(condition)


def read_strict(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_words: Sequence[str] = ("?",),
    sep: str = ",",
) -> DataFrame:
    """Typed scan that fails on a short line or an unreadable number.

    Values are trimmed before the missing-value test, blank lines are skipped, and rows without
    any value are dropped.
    """
    options = dict(sep=sep, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST")
    if len(na_words) == 1:
        return drop_all_null(spark.read.schema(schema).csv(path, nullValue=na_words[0], **options))
    text = spark.read.schema(_text_schema(schema)).csv(path, **options)
    return drop_all_null(text.select(*[_cast_or_fail(sentinel_to_null(col(f.name), na_words), f) for f in schema.fields]))


def _cast_or_fail(value: Column, field: T.StructField) -> Column:
    """The typed value; an unreadable one fails the scan whatever the session's ANSI mode."""
    typed = value.try_cast(field.dataType)
    fail = F.raise_error(F.concat(F.lit(f"unreadable {field.name}: "), value)).cast(field.dataType)
    return F.when(value.isNotNull() & typed.isNull(), fail).otherwise(typed).alias(field.name)


def read_lenient(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = (),
    na_words: Sequence[str] = ("?",),
    sep: str = ",",
    failures: str | None = None,
) -> DataFrame:
    """Text scan, trimmed and cast column by column; what cannot be cast becomes NULL.

    ``failures`` names an extra column holding the number of values of the row that were present
    but unreadable. Rows without a key value are dropped.
    """
    text = spark.read.schema(_text_schema(schema)).csv(path, sep=sep, mode="PERMISSIVE")
    text = text.select(
        *[sentinel_to_null(strip(col(f.name)), na_words).alias(f.name) for f in schema.fields]
    )
    typed = [col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if failures is not None:
        bad = F.lit(0)
        for f in schema.fields:
            if not isinstance(f.dataType, T.StringType):
                bad = bad + (col(f.name).isNotNull() & col(f.name).try_cast(f.dataType).isNull()).cast("int")
        typed.append(bad.alias(failures))
    return drop_null_key(text.select(*typed), keys)


def require_readable(df: DataFrame, failures: str) -> DataFrame:
    """Raise ``ValueError`` when rows of a lenient scan hold unreadable values (``failures`` counts them)."""
    bad = df.agg(F.coalesce(F.sum(col(failures)), F.lit(0))).first()[0]
    if bad:
        raise ValueError(f"{bad} values cannot be read as numbers")
    return df.drop(failures)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``KeyError`` when a needed column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {absent}")
    return df


def require_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``TypeError`` when a column that must be numeric is not."""
    types = {f.name: f.dataType for f in df.schema.fields}
    wrong = {c: types[c].simpleString() for c in columns if not isinstance(types[c], T.NumericType)}
    if wrong:
        raise TypeError(f"not numeric: {wrong}")
    return df
