"""Every registered query against its SQL on the same tables: names, row counts and exact values."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, "" if v is None else repr(v)) for v in row))


def test_every_query_has_an_oracle():
    """Those on documents have one where SQL can express them; tests/llm compares the others with plain Python."""
    assert set(entry_point.REGISTRY) == set(entry_point.ORACLES)
    assert set(entry_point.REGISTRY) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    spark_rows = in_order([tuple(row) for row in found.select(*names).collect()])
    duck_rows = in_order(wanted.fetchall())
    assert len(spark_rows) == len(duck_rows)
    assert spark_rows == duck_rows
    assert [type(v) for v in spark_rows[0]] == [type(v) for v in duck_rows[0]]


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
