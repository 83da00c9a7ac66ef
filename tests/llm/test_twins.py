"""The corpus queries that have SQL, against it, on the smallest tables."""

from __future__ import annotations

import pytest
from test_oracles import FOLDER, canonical, duck  # noqa: F401

from tallywork.llm.queries import QUERIES

TWINS = {name: (builder, sql) for name, (builder, sql) in QUERIES.items() if sql is not None}

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")


@pytest.mark.parametrize("name", sorted(TWINS))
def test_corpus_query_matches_sql(spark, duck, name):  # noqa: F811
    builder, sql = TWINS[name]
    df, result = builder(spark, str(FOLDER)), duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())
