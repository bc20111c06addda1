"""Every registered query against its SQL on the smallest tables."""

import datetime

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from vigilog.plans.registry import CHECK_SQL, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame):
    def text(v):
        if v is None or v is pd.NaT or v != v:
            return "NULL"
        if isinstance(v, (pd.Timestamp, datetime.datetime)):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(v)
    return sorted(tuple(text(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECK_SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(CHECK_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(CHECK_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["dimension", "key", "n"]
