"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
CHECKED = sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    assert rows_of(entry.queries()[name](spark, SF).toPandas()) == rows_of(duck.execute(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
