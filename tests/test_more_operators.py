"""Prefixes without a sort, collated keys, mergeable statistics, scripts, table functions, variants."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import describe_population, merged_moments, partial_moments
from millrace.operators.keys import scan_prefix
from millrace.plans.documents import find_variants, kind_at, number_at, parse_variants, variant_report
from millrace.plans.lookups import Lookup, collated_duplicates, new_members_collated, resolve_collated
from millrace.plans.run_log import LoadResult
from millrace.plans.scripts import create_lookup_table, run_lookup_script


@pytest.mark.parametrize("n", [0, 1, 7, 10, 11, 25, 30, 31, 1000])
def test_prefix_reads_only_the_files_it_needs(spark, tmp_path, n):
    for i in range(3):
        spark.range(10 * i, 10 * i + 10, numPartitions=1).write.parquet(str(tmp_path / f"part{i}"))
    scan = spark.read.parquet(*[str(tmp_path / f"part{i}") for i in range(3)])
    got = scan_prefix(scan, n)
    assert sorted(r.id for r in got.collect()) == list(range(30 if n == 0 else min(n, 30)))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    opened = got.select(F.input_file_name()).distinct().count()
    assert opened == (3 if n == 0 else min(-(-n // 10), 3))


def test_later_files_are_not_opened(spark, tmp_path):
    for i in range(3):
        spark.range(10 * i, 10 * i + 10, numPartitions=1).write.parquet(str(tmp_path / f"part{i}"))
    scan = spark.read.parquet(*[str(tmp_path / f"part{i}") for i in range(3)])
    got = scan_prefix(scan, 12)
    for file in (tmp_path / "part2").glob("*.parquet"):
        file.write_bytes(b"no parquet any more")
    assert sorted(r.id for r in got.collect()) == list(range(12))


GROUP = Lookup("Grupo", "GrupoId", "grupo")


def test_names_equal_under_a_collation_are_one_member(spark):
    rows = spark.createDataFrame([("Lima",), ("LIMA  ",), ("lima",), ("Árbol",), ("árbol",), ("Cusco",), ("  lima",)], "Nombre string")
    existing = spark.createDataFrame([(4, "cusco ")], GROUP.schema)
    fresh = new_members_collated(rows, GROUP, existing)
    assert sorted(map(tuple, fresh.collect())) == [(5, "  lima"), (6, "LIMA  "), (7, "Árbol")]
    whole = existing.unionByName(fresh)
    found = resolve_collated(rows.withColumnRenamed("Nombre", "grupo"), GROUP, whole).collect()
    assert {r.grupo: r.GrupoId for r in found} == {
        "Lima": 6, "LIMA  ": 6, "lima": 6, "Árbol": 7, "árbol": 7, "Cusco": 4, "  lima": 5}
    assert [(r.Nombre, r.filas) for r in collated_duplicates(rows, GROUP).orderBy("Nombre").collect()] == [("LIMA  ", 3), ("Árbol", 2)]
    assert new_members_collated(rows, GROUP, whole).count() == 0


def test_children_of_two_parents_stay_apart(spark):
    child = Lookup("Sede", "SedeId", "sede", parent=Lookup("Region", "RegionId", "region"))
    rows = spark.createDataFrame([(1, "A"), (1, "a "), (2, "a")], "RegionId int, Nombre string")
    none = rows.limit(0).selectExpr("1 AS SedeId", "RegionId", "Nombre")
    assert sorted((r.RegionId, r.Nombre) for r in new_members_collated(rows, child, none).collect()) == [(1, "A"), (2, "a")]


def test_merged_statistics_lose_nothing_to_a_large_mean(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 12).alias("m"), (F.lit(1e9) + F.col("id") % 7 * 0.25).alias("v")
    ).unionByName(spark.createDataFrame([(3, -1.0), (None, 2e9), (3, None)], "m bigint, v double"))
    by = {"m": F.col("m")}
    parts = [partial_moments(rows.filter(F.expr(f"pmod(hash(v, m), 3) = {i}")), "v", by) for i in range(3)]
    partials = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got, want = merged_moments(partials).first(), describe_population(rows, "v").first()
    assert (got.n, got.min, got.max) == (want.n, want.min, want.max)
    assert math.isclose(got.mean, want["mean"], rel_tol=1e-14) and math.isclose(got.stddev, want.stddev, rel_tol=1e-9)
    inner = rows.filter("m < 12")
    got = merged_moments(partials.filter("m < 12"), ["m"]).orderBy("m").collect()
    for r in got:
        one = describe_population(inner.filter(f"m = {r.m}"), "v").first()
        assert r.n == one.n and math.isclose(r.stddev, one.stddev, rel_tol=1e-6) and r["min"] == one["min"]
    assert merged_moments(partials, ["m"]).filter("m IS NULL").first().stddev == 0


def test_script_loads_counts_and_reports_errors(spark, tmp_path):
    lookup = Lookup("Cliente", "ClienteId", "cliente")
    create_lookup_table(spark, lookup, "script_cliente", str(tmp_path / "t"))
    view = lambda *names: spark.createDataFrame([(n,) for n in names], "cliente string").createOrReplaceTempView("script_stage")
    view("b", "a", None, "a")
    assert run_lookup_script(spark, lookup, "script_cliente", "script_stage") == LoadResult(2, 1, None)
    assert run_lookup_script(spark, lookup, "script_cliente", "script_stage") == LoadResult(0, 1, None)
    view("c", "a")
    assert run_lookup_script(spark, lookup, "script_cliente", "script_stage").inserted == 1
    assert sorted(map(tuple, spark.table("script_cliente").collect())) == [(1, "a"), (2, "b"), (3, "c")]
    spark.createDataFrame([(1,)], "other int").createOrReplaceTempView("script_stage")
    failed = run_lookup_script(spark, lookup, "script_cliente", "script_stage")
    assert failed.inserted == 0 and failed.partial_error == "the load was undone"
    spark.sql("DROP TABLE script_cliente")


def test_variants_of_mixed_types(spark, tmp_path):
    texts = ['{"a":{"n":5},"id":1}', '{"a":{"n":"7"},"id":2}', '{"a":{"n":{"v":9}},"id":3}', '{"a":[1],"id":4}',
             '{"a":{"n":null},"id":5}', '{"a":{"n":"x"},"id":6}', '{"a":{"n":true},"id":7}', "not json", None, "{}"]
    docs = parse_variants(spark.createDataFrame([(t,) for t in texts], "json string"), "json")
    docs.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    n, i = number_at(["$.a.n", "$.a.n.v"]), number_at(["$.id"])
    got = find_variants(stored, {"n": n >= 5}, {"id": i, "n": n, "tipo": kind_at("$.a.n")})
    assert sorted(map(tuple, got.collect())) == [(1, 5, "number"), (2, 7, "text"), (3, 9, "object")]
    report = {(r.tipo, r.valida): r.n for r in variant_report(stored, {"$.a.n": ["number", "text"]}).collect()}
    assert report == {("number", True): 1, ("text", True): 2, ("object", False): 1, ("null", False): 1,
                      ("boolean", False): 1, ("missing", False): 4}
