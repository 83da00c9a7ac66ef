"""Rows and tables that the tests of the corpus operators share."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        *[T.StructField(n, T.StringType()) for n in ("key", "copy", "row_key", "range", "size", "digest", "id", "leak_id", "w", "doc_key", "removed")],
    ]
)
CLASH = ("x",) * 11
LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))


def doc(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASH)


EDGES = [
    doc(1, "one two three four five six seven eight nine ten eleven twelve"),
    doc(1, "one two three four five six seven eight nine ten eleven twelve"),  # a repeated row
    doc(2, "one two three four five six seven eight nine ten eleven twelve", "b"),  # an equal text
    doc(3, None),
    doc(4, ""),
    doc(None, "no id but some words here", None),
    doc(None, None, None, None),
    doc(5, LONG, "b"),
    doc(6, "short", None),
    doc(-7, "below zero\n\nthree lines", "c"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
