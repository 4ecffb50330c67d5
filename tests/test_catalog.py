"""Every named query against its SQL on the same tables."""

import math
import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES

FOLDER = os.environ.get("DAYBOOK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return str(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)




@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    expected = duck.sql(oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    expected_rows = _rows(expected.columns, expected.fetchall())
    assert _rows(result.columns, result.collect()) == expected_rows
    assert expected_rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["transaction_date", "subsidiary", "gmv"]
    assert result.count() > 0


def test_preview_and_query_keep_their_order(spark):
    for name in ("gold_query", "gold_preview"):
        keys = [(r[0], r[1] or "") for r in queries()[name](spark, FOLDER).collect()]
        assert keys == sorted(keys)
