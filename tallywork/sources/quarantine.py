"""A scan that keeps what it rejects: good rows and a quarantine table from one pass over the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import col
from tallywork.functions.text import sentinel_to_null, strip
from tallywork.sources.scratch import materialize

WRONG_COUNT, UNREADABLE, NO_KEY = "wrong number of values", "unreadable", "key is missing"


def scan_with_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = (),
    na_words: Sequence[str] = ("?",),
    sep: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected): the typed rows that hold up, and ``file, line, column, reason`` for the rest.

    A line is rejected when its number of values is not the schema's, when a value cannot be read as its
    column's type, or when a key is missing; it appears once for every reason, with its text as
    it stands in the file. Values are trimmed and missing-value words become NULL before they are read. Blank
    lines are skipped. A record is a line: quoted line feeds are not supported. The files are read once; the
    parsed rows are stored, with the line only where it is rejected.
    """
    names = [f.name for f in schema.fields]
    text = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file")).where(F.trim("value") != "")
    parsed = lines.select("value", "__file", F.from_csv("value", f"{text}, __corrupt string", options).alias("__row"))
    parsed = parsed.select(
        "value", "__file", F.col("__row.__corrupt").isNotNull().alias("__short"),
        *[sentinel_to_null(strip(F.col("__row")[n]), na_words).alias(n) for n in names],
    )

    def reason(column: str, why: str):
        return F.struct(F.lit(column).alias("column"), F.lit(why).alias("reason"))

    reasons = [F.when(F.col("__short"), reason("", WRONG_COUNT))]
    typed = []
    for f in schema.fields:
        read = col(f.name).try_cast(f.dataType)
        typed.append(read.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(col(f.name).isNotNull() & read.isNull(), reason(f.name, UNREADABLE)))
    reasons += [F.when(col(k).isNull() & ~F.col("__short"), reason(k, NO_KEY)) for k in keys]
    found = F.array_compact(F.array(*reasons))
    kept = parsed.select(*typed, "__file", "value", found.alias("__reasons"))
    kept = kept.withColumn("value", F.when(F.size("__reasons") > 0, F.col("value")))
    stored = materialize(kept, "scanned")
    good = stored.where(F.size("__reasons") == 0).select(*[col(n) for n in names])
    rejected = stored.where(F.size("__reasons") > 0).select(F.col("__file").alias("file"), F.col("value").alias("line"), F.inline("__reasons"))
    return good, rejected
