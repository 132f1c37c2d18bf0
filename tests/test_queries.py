"""Every query with SQL against DuckDB on the smallest tables, and the bulk of them for shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from canopy.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)
    rows = lambda t: sorted(str(tuple(r[k] for k in names)) for r in t.to_pylist())
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
