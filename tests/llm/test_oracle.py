"""The queries that SQL can express against DuckDB, over a given scale factor."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from usertide.llm import oracle, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(oracle.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    wanted = sorted(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall(), key=str)
    assert found == wanted


def test_all_are_registered():
    names = entry_module.queries()
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(entry_module.oracle_sql())


def test_some_licences_and_leaks_are_found(spark):
    assert queries.op7_licence_scan(spark, SF).where("n_notices > 0").count() > 10
    assert queries.op6_decontaminate(spark, SF).where("contaminated").count() > 10


def test_native_queries_run_no_python(spark):
    for name in ("op6_decontaminate", "op9_exact_dedup"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
