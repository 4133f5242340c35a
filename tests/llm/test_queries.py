"""The operators' queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tramline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "labels", "benchmark"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    answer = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, answer.fetchall()))
