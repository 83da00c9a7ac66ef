"""Small helpers for naming and reshaping columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a column whatever characters its name holds (``hours-per-week``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def indicator(column: Column, value: str) -> Column:
    """1 where the column equals ``value``, else 0; NULL counts as 0."""
    return F.coalesce(column == F.lit(value), F.lit(False)).cast("int")


def recode(column: Column, mapping: dict[str, int]) -> Column:
    """Replace labels by integers; labels outside the mapping become NULL."""
    out = F.lit(None).cast("int")
    for label, code in mapping.items():
        out = F.when(column == F.lit(label), F.lit(code)).otherwise(out)
    return out


def one_row_to_long(one_row: DataFrame, structs: Iterable[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Turn a wide aggregate (one struct per measured column) into one row per struct."""
    return one_row.select(*[col(k) for k in keys], F.inline(F.array(*structs)))


def unpivot_columns(
    df: DataFrame, columns: Sequence[str], as_type: str, value_name: str, ids: Sequence[str] = ()
) -> DataFrame:
    """Long form ``(ids..., column, value_name)`` reading only the named columns."""
    picked = df.select(*[col(i) for i in ids], *[col(c).cast(as_type).alias(c) for c in columns])
    return picked.unpivot([col(i) for i in ids], [col(c) for c in columns], "column", value_name)
