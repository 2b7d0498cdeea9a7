"""Every registered query against its DuckDB statement, over the whole given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import starmill
from conftest import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
FAMILIES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return connection


def _sorted(found):
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), 0 if v is None else v) for v in r))


def test_every_query_of_the_library_has_an_oracle():
    own = {*starmill.mart_names(), *(f.__name__ for f in entry._OPERATORS)}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, str(TESTDATA))
    columns = sorted(df.columns)
    got = _sorted([tuple(row[c] for c in columns) for row in df.collect()])
    result = duck.execute(entry.oracle_sql()[name])
    header = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = [dict(zip(header, row)) for row in result.fetchall()]
    assert sorted(header) == columns
    for column, kind in df.dtypes:
        assert types[column].startswith(FAMILIES[kind][:4]), (column, kind, types[column])
    assert got == _sorted([tuple(row[c] for c in columns) for row in want])
    assert got


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
