"""Every registered query against its SQL, at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from collodec.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
# What is registered besides has tests of its own.
QUERIES = {name: build for name, build in contract.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    """Columns by name, rows in any order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_every_query_has_sql():
    assert catalogue.QUERIES.keys() <= SQL.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    got = comparable(result.columns, [tuple(r) for r in result.collect()])
    cursor = database.execute(SQL[name])
    expected = comparable([d[0] for d in cursor.description], cursor.fetchall())
    assert got[1] and got == expected


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 124
    totals = {r.decade: r.n for r in rows}
    assert totals == {1990: 8724, 2000: 3276}
    strongest = min(rows, key=lambda r: r.llr)
    assert (strongest.w1, strongest.w2, strongest.decade) == ("blue", "rod", 1990)
    assert (strongest.c1, strongest.c2, strongest.c12) == (413, 556, 131)
    assert strongest.llr == pytest.approx(-133.00957475509, abs=1e-8)
