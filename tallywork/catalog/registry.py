"""Registry of queries: name -> (builder, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.catalog.census import CENSUS_SQL, census, key_hash, read
from tallywork.functions.columns import col
from tallywork.sources.scratch import materialize


@dataclass
class Tables:
    """What a query builder gets: the session, the input folder, and the derived views."""

    spark: SparkSession
    sf_dir: str

    def read(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @cached_property
    def census(self) -> DataFrame:
        return census(self.spark, self.sf_dir)

    @cached_property
    def stored_census(self) -> DataFrame:
        """The view written once, for queries that pass over it several times; the hash of the key is made from the stored key."""
        stored = materialize(self.census.drop("h"), "census", packed=True)
        return stored.select(*[key_hash() if c == "h" else col(c) for c in self.census.columns])


REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a builder; ``{census}`` in the SQL stands for the view's common table expressions."""

    def keep(builder: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (builder, None if sql is None else sql.replace("{census}", CENSUS_SQL))
        return builder

    return keep


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round every double (6 digits unless named) so that two engines' sums compare equal."""
    return df.select(
        *[
            F.round(col(f.name), digits.get(f.name, 6)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expression: str, digits: int = 6) -> str:
    """The SQL counterpart of :func:`rounded`; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, {digits}) + 0.0E0)"


def long_sql(columns, carry: str = "", source: str = "census", kind: str = "DOUBLE", value: str = "value") -> str:
    """UNION ALL body of the long form of some columns."""
    extra = f", {carry}" if carry else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {kind}) AS {value}{extra} FROM {source}" for c in columns
    )
