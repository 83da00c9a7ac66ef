"""Writers. Each writes in parallel, one file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import col


# A compressed file is read whole by one task, so it is kept short.
LINES_PER_FILE = 500_000
# Compressed text is three times smaller; the fastest level of gzip takes a fraction of the usual one's time.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(LINES_PER_FILE)}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", packed: bool = False) -> str:
    """Delimited files with a header line and no index column; ``packed`` compresses them."""
    df.write.mode(mode).option("header", True).options(**(PACKED_TEXT if packed else {})).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def write_results(results: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Tidy analysis results, one folder per section."""
    results.write.mode(mode).partitionBy("section").parquet(path)
    return path


def to_tidy(df: DataFrame, section: str, items: list[str]) -> DataFrame:
    """``(section, item, metric, value_double, value_string)`` rows from a result table.

    ``items`` are the columns that identify a row; every other column becomes one metric row.
    """
    item = F.concat_ws("|", *[F.coalesce(col(i).cast("string"), F.lit("")) for i in items]) if items else F.lit("")
    metrics = []
    for name, kind in df.dtypes:
        if name in items:
            continue
        textual = kind == "string"
        number = F.lit(None).cast("double") if textual else col(name).cast("double")
        words = col(name) if textual else F.lit(None).cast("string")
        metrics.append(
            F.struct(F.lit(name).alias("metric"), number.alias("value_double"), words.alias("value_string"))
        )
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.inline(F.array(*metrics)))
