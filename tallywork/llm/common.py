"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STRIDE = 1 << 16  # copies numbered by one generated array


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def field(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def number_copies(rows: DataFrame) -> DataFrame:
    """Every row again with ``copy``, which counts from 0 over rows equal in all columns.

    Equal rows are counted before the shuffle, so one that fills a third of the table costs one record
    per task, and are written out again in strides of a bounded array.
    """
    counted = rows.groupBy(*[field(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("_n"))
    strides = counted.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_STRIDE).cast("long"))))
    last = F.least(F.col("_from") + (_STRIDE - 1), F.col("_n") - 1)
    return strides.withColumn("copy", F.explode(F.sequence(F.col("_from"), last))).drop("_n", "_from")


def sortable_long(value: Column) -> Column:
    """Sixteen hex digits in the order of the signed number; blanks for NULL, which so comes first."""
    flipped = value.cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit(" " * 16))
