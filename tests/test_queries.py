"""Every query with SQL gives the rows that DuckDB gives from the SQL."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from gridspark.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def rows(df: pd.DataFrame) -> list:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return round(float(v), 6) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as from '{SF}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(SQL[name]).df())


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
