"""Partition filters derived from bounds on their source."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.aggregates import critical_query
from millrace.operators.bounds import bounded, part_of, with_parts
from millrace.schemas import INT, LONG, TEXT
from millrace.sources.readers import read_layout
from millrace.sources.warehouse import Warehouse
from millrace.sources.writers import write_layout

PARTS = {
    "month": [part_of("y", INT, "d", "year"), part_of("m", INT, "d", "month")],
    "day": [part_of("y", INT, "d", "year"), part_of("m", INT, "d", "month"), part_of("dd", INT, "d", "day")],
    "orphan month": [part_of("m", INT, "d", "month")],
    "number": [part_of("block", LONG, "n", "floor:100")],
    "text": [part_of("head", TEXT, "s", "prefix:2")],
}


@pytest.fixture(scope="module")
def rows(spark):
    made = [(date(2022, 11, 20) + timedelta(days=3 * i), i - 50, f"{'abz'[i % 3]}{i:03d}") for i in range(150)]
    return spark.createDataFrame([*made, (None, None, None)], "d date, n int, s string")


def files_read(df):
    return df.select(F.input_file_name()).distinct().count()


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [", 1)[1].split("], PushedFilters", 1)[0]


@pytest.mark.parametrize("kind, column, low, high, seen", [
    ("month", "d", "2022-12-05", "2023-02-01", ["y", "m"]),
    ("month", "d", "2023-03-05", None, ["y", "m"]),
    ("month", "d", None, date(2022, 12, 2), ["y", "m"]),
    ("day", "d", "2022-12-30", "2023-01-02", ["y", "m", "dd"]),
    ("number", "n", -20, 33, ["block"]),
    ("text", "s", "a012", "b051", ["head"]),
])
def test_only_needed_directories_are_opened(spark, tmp_path, rows, kind, column, low, high, seen):
    parted = with_parts(rows, PARTS[kind])
    path = str(tmp_path / "layout")
    write_layout(parted, path, [f.name for f in PARTS[kind]], [column])
    stored = read_layout(spark, path, parted.schema)
    asked = bounded(stored, column, low, high)
    plain = rows.filter(" AND ".join(
        [f"{column} >= '{low}'" if low is not None and column != "n" else f"{column} >= {low}"] * (low is not None)
        + [f"{column} <= '{high}'" if column != "n" else f"{column} <= {high}"] * (high is not None)
    ))
    assert sorted(asked.select(rows.columns).collect()) == sorted(plain.collect())
    assert all(name in partition_filters(asked) for name in seen)
    assert 0 < files_read(asked) < files_read(stored)


def test_a_month_without_its_year_says_nothing(spark, rows):
    parted = with_parts(rows, PARTS["orphan month"])
    asked = bounded(parted, "d", "2022-12-05", "2023-02-01")
    assert asked.count() == rows.filter("d BETWEEN '2022-12-05' AND '2023-02-01'").count() > 0
    assert bounded(rows, "d", "2022-12-05", "2023-02-01").count() == asked.count()


@settings(max_examples=25, deadline=None)
@given(st.dates(date(2022, 10, 1), date(2024, 4, 1)), st.dates(date(2022, 10, 1), date(2024, 4, 1)))
def test_derived_filters_lose_nothing(spark, rows, low, high):
    parted = with_parts(rows, PARTS["day"])
    assert bounded(parted, "d", low, high).count() == rows.filter(F.col("d").between(low, high)).count()


def test_a_published_fact_is_pruned_by_its_date(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    fact = spark.range(60).select(
        *[
            (F.expr("date_add(DATE'2023-01-01', cast(id * 11 as int))") if f.name == "Fecha"
             else F.expr("year(date_add(DATE'2023-01-01', cast(id * 11 as int)))") if f.name == "Anio"
             else F.expr("month(date_add(DATE'2023-01-01', cast(id * 11 as int)))") if f.name == "Mes"
             else F.lit('2023-12-20').cast('date') if f.name == 'FechaCorte' else F.lit(1)).cast(f.dataType).alias(f.name)
            for f in schemas.ATTENTION_FACT.fields
        ]
    )
    wh.publish(append={"Atencion": fact}, partition_by={"Atencion": ["Anio", "Mes"]})
    stored = wh.table("Atencion", schemas.ATTENTION_FACT)
    asked = critical_query(stored, "EdadReg", 1, "Fecha", "2023-06-01", "2023-06-30", {"n": F.lit(1)})
    assert "Anio" in partition_filters(asked) and "Mes" in partition_filters(asked)
    assert asked.first()["Registros"] == fact.filter("Fecha BETWEEN '2023-06-01' AND '2023-06-30'").count() > 0
    assert files_read(bounded(stored, "Fecha", "2023-06-01", "2023-06-30")) == files_read(stored.filter("Anio = 2023 AND Mes = 6"))
