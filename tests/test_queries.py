"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


OWN = sorted(query.__name__ for query in entry._QUERIES)


def test_every_query_has_sql():
    assert set(OWN) == set(entry._SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sql, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = sql.sql(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert len(got) == len(want) > 0
    got = got[columns].sort_values(columns, ignore_index=True)
    want = want[columns].sort_values(columns, ignore_index=True)
    for column in columns:
        same = (got[column] == want[column]) | (got[column].isna() & want[column].isna())
        assert same.all(), (column, got[~same].head(3), want[~same].head(3))


def test_entry(spark):
    assert entry.entry(spark).columns == ["bookshelf", "title", "similarity_level", "place"]
