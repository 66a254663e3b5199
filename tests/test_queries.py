"""Every registered query against its SQL twin in DuckDB, whole tables, smallest scale."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        ([plain(r[i]) for i in order] for r in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(DATA))
    answer = duck.execute(contract.oracle_sql()[name])
    expected = table([c[0] for c in answer.description], answer.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 1
