"""Every query against its SQL over the same tables."""

from __future__ import annotations

import duckdb
import pytest
from checks import SF_DIR, plan_text

import __spark_entry__ as contract
from txnsieve.plans.oracles import ORACLES
from txnsieve.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    found = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    places = [expected.columns.index(c) for c in columns]
    assert found == sorted(repr(tuple(r[i] for i in places)) for r in expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000
