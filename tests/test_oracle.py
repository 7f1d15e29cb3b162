"""Every registered query against its DuckDB counterpart."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import oracle, queries

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()

TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def in_order(found):
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = duck.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    found = in_order(tuple(r) for r in df.select(*columns).collect())
    wanted = in_order(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert found == wanted


def test_entry(spark):
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())
    assert entry_module.entry(spark).count() > 0
