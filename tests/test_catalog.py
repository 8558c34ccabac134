"""Every query with checking SQL gives the same rows in both engines at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from pricewright.plans import catalog

FOLDER = f"{check.DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{FOLDER}/*.parquet")):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    mine = check.rows_of(df.columns, df.collect())
    assert mine == check.rows_of(columns, cursor.fetchall())
    assert mine


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
