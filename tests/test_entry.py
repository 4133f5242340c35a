"""The driver's contract, and queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from tramline.plans import queries as transit
from tramline.plans import pipelines, scans, shared_scans  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ELEMENTS = [n for n in transit.QUERIES if n[0] == "n"]
CHECKED = [n for n in transit.QUERIES if n[0] not in "fn"] + ELEMENTS[::5] + ["f06_weekday", "f16_duration", "f30_f31_compressed_payload"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    shown = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(repr([shown(r[k]) for k in order]) for r in found)


def test_contract(spark):
    queries, sql = driver.queries(), driver.oracle_sql()
    assert set(sql) <= set(queries) and set(transit.QUERIES) <= set(queries)
    assert driver.entry(spark).columns == ["route_short_name", "active_trips"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, answer.fetchall())
