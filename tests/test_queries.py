"""Every registered query against its SQL on the smallest benchmark tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from palimpsest.plans.oracle import ORACLE
from palimpsest.plans.queries import all_queries

TABLES = Path("/root/testdata/sf0.001")
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_reference_sql_has_its_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = database.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())
    assert got == expected


def test_flagship_query(spark):
    assert driver.entry(spark).count() == 314
