"""Queries of this subpackage against their SQL, on whole sample tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from pacewise.llm import oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = contract.queries()[name](spark, FOLDER)
    expected = duck.execute(oracle.statements()[name])
    columns = sorted(d[0] for d in expected.description)
    place = [[d[0] for d in expected.description].index(c) for c in columns]
    assert sorted(result.columns) == columns
    assert Counter(tuple(r[c] for c in columns) for r in result.collect()) == Counter(tuple(r[i] for i in place) for r in expected.fetchall())
