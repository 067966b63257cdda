"""Queries against their SQL, on the smallest tables."""

import os

import pytest

from skewdex.llm import queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    query = next(q for q in queries.QUERIES if q.__name__ == name)
    got, want = query(spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) == len(want) > 0
    got = got[columns].sort_values(columns, ignore_index=True)
    want = want[columns].sort_values(columns, ignore_index=True)
    same = (got == want) | (got.isna() & want.isna())  # a null is equal to a null
    assert same.all().all()
    # Pandas has no one type for whole numbers with nulls among them: those columns are told by Spark's.
    whole = [c for c in columns if not want[c].isna().any()]
    assert dict(got[whole].dtypes) == dict(want[whole].dtypes)
    nulls = {f.name: f.dataType.simpleString() for f in query(spark, SF).schema if f.name not in whole} if len(whole) < len(columns) else {}
    assert nulls == {c: "bigint" if str(want[c].dtype) == "Int64" else "string" for c in columns if c not in whole}


def test_names_and_numbers():
    assert [q.__name__.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
