"""Every registered query against its SQL oracle on the same tables."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from pacewise.plans.queries import registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_canonical(row[i]) for i in order) for row in rows)


def test_every_library_query_has_an_oracle():
    assert set(registry()) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    expected = duck.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    want = _rows(names, expected.fetchall())
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    assert got == want
    assert want


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "summary_level"
