"""A training corpus from ``documents``: good, distinct, clean of benchmarks, mixed to weights, sharded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.common import table
from tallywork.llm.decontamination import without_leaks
from tallywork.llm.jaccard_join import first_of_each_class
from tallywork.llm.mixing import mixed_rows
from tallywork.llm.quality import fit_quality, quality_score
from tallywork.llm.sharding import shard_by_bytes
from tallywork.sources.scratch import materialize

LEAST_QUALITY = 0.3
SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Every row has a score, NULL and empty texts, rows without id, very long texts and repeated rows too, each by its own text and
    recorded length; rows of equal texts and lengths go together. Without labels of both classes every score is 0.5 and
    all stay. An empty table stays empty; further columns are carried along.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_score(docs, model) >= LEAST_QUALITY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that of least id.

    Rows equal in id and text count as one, also where they have no words; other rows without words (NULL, empty) are no
    copies and stay. A row without id goes behind those with one. Whole texts are compared, however long; an empty table
    stays empty; further columns are carried along.
    """
    return first_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go.

    NULL and empty texts hold none; repeated rows go or stay together; a row without id is told by its text. Items without words find
    nothing, and an empty benchmark or table leaves all as it is. Further columns are carried along.
    """
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, none to two times.

    A document at a source's cut is taken whole. Texts without words have no size and are taken as often as their source is gone
    through whole. NULL is a source of its own, the last. Rows equal in id, source and text are taken as often as they are
    together. An empty table stays empty; further columns are carried along.
    """
    return mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every record: (doc_id, size, text_crc32, law, shard, slot).

    A NULL text has a size of 8 and the checksum 0; repeated rows are records of their own; a text of any
    length is one record. An empty table has no shards.
    """
    return shard_by_bytes(docs, SHARDS).withColumn("law", F.lit("bytes"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# A trained classifier and a randomised join have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
