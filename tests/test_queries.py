"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pytest

from factloom import catalogue

SF_DIR = "/root/testdata/sf0.001"
CHECKED = tuple(catalogue.ORACLE_SQL)


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    found = catalogue.QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in found.collect())
    assert rows == sorted(tuple(map(plain, r)) for r in expected)
