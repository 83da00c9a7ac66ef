"""Intermediate tables that survive lost executors.

A materialised table is written as Parquet and read back: lineage is cut, later reads prune columns,
and the planner sees true file sizes. Tables go to the folder named in ``spark.checkpoint.dir``; where
that is unset, below the session's warehouse, the folder in which Spark itself keeps tables.

What a written table needed on the way, the shuffle files of its job, goes as soon as it stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallywork.functions.columns import col


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"


_DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Generated methods beyond 8,000 bytes are never compiled by the JVM; Spark then evaluates expressions in smaller ones.
SHORT_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def settings(spark: SparkSession, **names: str) -> Iterator[None]:
    """Settings that hold inside the block only."""
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a write that runs inside the block are removed when it ends, not at some later garbage collection."""
    return settings(spark, **_DROP_SHUFFLES)


class Store:
    """Intermediate tables of one run, in a folder of their own that :meth:`clear` removes."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{(root or scratch_root(spark)).rstrip('/')}/tallywork-{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        """A path nobody has used before."""
        return f"{self.folder}/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
        """Write ``df`` and return a fresh scan of it; ``packed`` takes less disk for wide rows."""
        path = self.path(label)
        writer = df.write.partitionBy(*partition_by)
        with shuffles_dropped(self.spark):
            (writer.option("compression", "zstd") if packed else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*[col(c) for c in df.columns])

    def clear(self) -> None:
        """Remove the run's tables; frames that read them end here."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_SHARED: dict[str, Store] = {}


def session_store(spark: SparkSession) -> Store:
    """The store that operators use when the caller names none; its ``clear`` ends all of them."""
    return _SHARED.setdefault(spark.sparkContext.applicationId, Store(spark))


def new_path(spark: SparkSession, label: str) -> str:
    return session_store(spark).path(label)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), store: Store | None = None, packed: bool = False) -> DataFrame:
    """Write ``df`` to ``store`` (by default the session's) and return a fresh scan of it."""
    return (store or session_store(df.sparkSession)).keep(df, label, partition_by, packed)
