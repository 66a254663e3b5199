"""Keys, joins, duplicates, checks and change logs against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, audit, joins, keys, quality


def test_dense_ids_small_and_ranged_agree(spark, monkeypatch):
    names = [f"n{random.Random(i).randrange(10**6)}-{i}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "k string").repartition(7)
    expected = {n: 11 + i for i, n in enumerate(sorted(names))}
    small, size = keys.dense_ids(df, ["k"], "id", start=10)
    assert size.rows == 500
    assert {r["k"]: r["id"] for r in small.collect()} == expected
    monkeypatch.setattr(keys, "ONE_TASK_ROWS", 10)
    ranged, _ = keys.dense_ids(df, ["k"], "id", start=10)
    assert {r["k"]: r["id"] for r in ranged.collect()} == expected
    assert "Window" not in ranged._jdf.queryExecution().toString()


def test_dense_ids_of_nothing(spark):
    none, size = keys.dense_ids(spark.range(0).withColumnRenamed("id", "k"), ["k"], "id")
    assert (size.rows, none.count()) == (0, 0)


def test_continue_ids(spark):
    existing = spark.createDataFrame([(1, "a"), (7, "b")], "id long, k string")
    fresh, _ = keys.continue_ids(spark.createDataFrame([("d",), ("c",)], "k string"), existing, ["k"], "id")
    assert sorted(tuple(r) for r in fresh.collect()) == [(8, "c"), (9, "d")]


def test_first_per_key_and_appearance(spark):
    rows = [(1, "b", 3), (1, "a", 2), (1, "b", 1), (2, None, 5), (2, "z", 6)]
    df = spark.createDataFrame(rows, "k int, v string, seq long")
    first = keys.first_per_key(df, ["k"], "seq", ["v"])
    assert {r["k"]: r["v"] for r in first.collect()} == {1: "b", 2: None}
    seen = keys.first_appearance(df, ["v"], "seq")
    assert {r["v"]: r["first_seen"] for r in seen.collect()} == {"b": 1, "a": 2, None: 5, "z": 6}


def test_fold_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1, None, 3), (1, None, 2), (2, "x", 1)], "a int, b string, seq long")
    got = sorted((r["a"], r["b"], r["copies"], r["seq"]) for r in keys.fold_duplicates(df, "seq").collect())
    assert got == [(1, None, 2, 2), (2, "x", 1, 1)]


def test_source_order_and_first_rows(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("n\n" + "\n".join(str(i) for i in range(100, 0, -1)) + "\n")
    df = keys.with_source_order(spark.read.schema("n int").csv(str(path), header=True))
    assert [r["n"] for r in keys.first_rows(df, 3).collect()] == [100, 99, 98]
    assert keys.first_rows(df, 0).count() == 100


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("path", ["broadcast", "shuffle", "salted"])
def test_keyed_join_is_the_same_on_every_path(spark, monkeypatch, how, path):
    rng = random.Random(5)
    left_rows = [(i, None if i % 50 == 0 else (7 if i % 3 == 0 else rng.randrange(40))) for i in range(4000)]
    left = spark.createDataFrame(left_rows, "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 3)] + [(7, "v7")], "k int, v string")
    known = {r["k"]: r["v"] for r in right.collect()}
    size = joins.measure(right) if path == "broadcast" else None
    if path == "salted":
        assert joins.hot_hashes(left, ["k"], share=0.2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760" if path == "broadcast" else "-1")
    try:
        got = joins.keyed_join(left, right, ["k"], how, size, balance=path == "salted").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if how == "inner":
        want = [(i, known[k]) for i, k in left_rows if k in known]
    elif how == "left":
        want = [(i, known.get(k)) for i, k in left_rows]
    else:
        want = [(i, None) for i, k in left_rows if k not in known]
    assert sorted((r["i"], r["v"] if how != "left_anti" else None) for r in got) == sorted(want)


def test_null_safe_join_matches_missing_values(spark):
    left = spark.createDataFrame([(1, None, "a"), (2, 5, "a"), (3, None, None)], "i int, age int, s string")
    dim = spark.createDataFrame([(10, None, "a"), (11, 5, "a"), (12, None, None)], "id int, age int, s string")
    for size in (joins.measure(dim), None):
        got = joins.keyed_join(left, dim, ["age", "s"], "left", size, null_safe=True)
        assert {r["i"]: r["id"] for r in got.collect()} == {1: 10, 2: 11, 3: 12}


def test_hot_keys_travel_to_many_tasks(spark):
    left = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 6000, 3).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.not_yet_in(left, right, ["k"])
        tasks = joined.filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
        assert joined.count() == left.join(right, "k", "left_anti").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_orphans_by_rule_and_by_foreign_key(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert joins.orphans(child, parent, ["k"]).count() == 2
    assert joins.orphans(child, parent, ["k"], ignore_null=True).count() == 1


def test_three_valued_rules(spark):
    rows = [
        (1, "X", 10, "A", 1, 0, 1),
        (2, None, 10, "A", 1, 0, 1),
        (3, "F", 364, "D", 1, 0, 1),
        (4, "F", 365, "D", 1, 0, 1),
        (5, "F", 12, "M", 1, 0, 1),
        (6, "F", -1, "A", 1, 0, 1),
        (7, "F", 100, "A", 1, 0, 1),
        (8, "F", 5, "Z", 1, 0, 1),
        (9, "F", None, "A", 1, 0, 1),
        (10, "F", 5, None, 1, 0, 1),
        (11, "F", 5, "A", 99, 0, 1),
        (12, "F", 5, "A", 1, 3, 1),
        (13, "X", 100, "A", 1, -1, -2),
        (14, "F", 5, "A", None, 0, 1),
    ]
    cols = "StgId long, SEXO string, EDAD_REG int, TIPO_EDAD string, CODIGO_UNICO int, ATENDIDOS int, ATENCIONES int"
    df = spark.createDataFrame(rows, cols)
    parent = spark.createDataFrame([(1,)], "CODIGO_UNICO int")
    flagged = quality.with_membership(df, parent, ["CODIGO_UNICO"])
    log = quality.reject_log(flagged, quality.attention_rules(), "StgId", "p")
    got = sorted((r["StgId"], r["Campo"], r["ValorOriginal"]) for r in log.collect())
    age, code, counts = "EDAD_REG/TIPO_EDAD", "CODIGO_UNICO", "ATENDIDOS/ATENCIONES"
    assert got == sorted(
        [
            (1, "SEXO", "X"),
            (4, age, "365/D"),
            (5, age, "12/M"),
            (7, age, "100/A"),
            (8, age, "5/Z"),
            (11, code, "99"),
            (12, counts, "3/1"),
            (13, "SEXO", "X"),
            (13, age, "100/A"),
            (13, counts, "-1/-2"),
            (14, code, None),
        ],
        key=lambda r: (r[0], r[1]),
    )
    assert sum(r["Violaciones"] for r in quality.reject_counts(log).collect()) == 11


def test_constraints(spark):
    df = spark.createDataFrame([(1, "aaaa", 300), (1, None, -1), (None, "b", None)], "k int, s string, n int")
    checks = {
        "n >= 0": F.col("n") >= 0,
        **quality.not_null(["k"]),
        **quality.max_width({"s": 3}),
        **quality.castable({"n": "tinyint"}),
    }
    got = {r["regla"]: r["violaciones"] for r in quality.row_checks(df, "t", checks).collect()}
    assert got == {"n >= 0": 1, "NOT NULL k": 1, "WIDTH s <= 3": 1, "TYPE n tinyint": 1}
    assert quality.unique_check(df, "t", ["k"]).first()["violaciones"] == 1
    assert quality.unique_check(df.union(df.filter("k is null")), "t", ["k"]).first()["violaciones"] == 2
    parent = spark.createDataFrame([(2,)], "k int")
    assert quality.foreign_key_check(df, "t", ["k"], parent).first()["violaciones"] == 2
    with pytest.raises(quality.QualityError, match="NOT NULL k: 1"):
        quality.require(df, "t", checks)
    with pytest.raises(quality.QualityError, match="UNIQUE"):
        quality.require_unique(df, "t", ["k"])


def test_closed_periods(spark):
    df = spark.sql("SELECT DATE'2023-01-05' AS d UNION ALL SELECT DATE'2023-02-05'")
    closed = spark.sql("SELECT 2023 AS Anio, 2 AS Mes")
    assert quality.rows_in_closed_periods(df, closed, "d").count() == 1
    with pytest.raises(quality.QualityError):
        quality.require_open_periods(df, closed, "d")
    quality.require_open_periods(df, closed.filter("Mes = 3"), "d")


def test_change_log_and_replay(spark):
    old = spark.createDataFrame([(1, "p", 1.0), (2, "p", 2.0), (3, "p", None)], "id int, per string, m double")
    new = spark.createDataFrame([(2, "p", 2.0), (3, "q", 4.0), (4, "p", 5.0)], "id int, per string, m double")
    log = audit.change_log(old, new, "id", ["per"], ["m"], user=F.lit("u"), at=F.current_timestamp())
    got = {r["id"]: (r["Operacion"], r["per"], r["m_Anterior"], r["m_Nuevo"]) for r in log.collect()}
    assert got == {
        1: ("D", "p", 1.0, None),
        2: ("U", "p", 2.0, 2.0),
        3: ("U", "q", None, 4.0),
        4: ("I", "p", None, 5.0),
    }
    assert {"UsuarioBD", "FechaHora"} <= set(log.columns)
    changed = audit.change_log(old, new, "id", ["per"], ["m"], only_changed=True)
    assert changed.count() == 3
    replayed = audit.replay(old, log, "id", ["per"], ["m"])
    assert sorted(map(tuple, replayed.collect())) == sorted(map(tuple, new.collect()))


def test_population_deviation_and_sentinel(spark):
    df = spark.createDataFrame([(-1,), (None,), (2,), (4,)], "age int")
    assert tuple(aggregates.describe_population(df, "age").first()) == (2, 3.0, 1.0, 2, 4)


def test_small_cells_count_people_not_rows(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("b", 1), ("b", 1), ("c", 4)], "g string, n int")
    kept = aggregates.suppress_small_cells(df, ["g"], {"total": "n"}, "total", k=5)
    assert [tuple(r) for r in kept.collect()] == [("a", 5)]


def test_critical_query_pushes_its_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'a' AS k, TIMESTAMP'2023-01-31 23:00:00' AS d, 1 AS n, 'x' AS other").write.parquet(path)
    args = ("k", "a", "d", "2023-01-01", "2023-01-31", {"total": F.col("n")})
    out = aggregates.critical_query(spark.read.parquet(path), *args)
    assert out.first()["total"] == 1
    plan = out._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d" in plan and "EqualTo(k,a)" in plan
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "other" not in scan.split("ReadSchema")[1]
