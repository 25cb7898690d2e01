"""Every query against its SQL twin in DuckDB, by rows and by column types."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tristrata.plans.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_queries_are_not_run_on_nothing(duck):
    """No twin is empty, so that no query passes by giving nothing."""
    empty = [n for n, sql in ORACLES.items() if not duck.sql(f"SELECT 1 FROM ({sql}) q LIMIT 1")]
    assert empty == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, plan, name):
    ours = QUERIES[name](spark, SF_DIR)
    for banned in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert banned not in plan(ours)
    columns = sorted(ours.columns)
    got = ours.select(*[f"`{c}`" for c in columns]).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(want.column_names) == columns
    want = want.select(columns)

    def kinds(arrow):
        return [str(f.type).replace("large_", "") for f in arrow.schema]

    assert kinds(got) == kinds(want)
    assert Counter(tuple(r.values()) for r in got.to_pylist()) == Counter(
        tuple(r.values()) for r in want.to_pylist()
    )
