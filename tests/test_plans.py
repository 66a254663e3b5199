"""Whole jobs on small hand-made records."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import QualityError
from millrace.plans import attentions, documents, published, reimbursements
from millrace.plans.run_log import RUN_TABLE, latest
from millrace.plans.star import constraint_report as star_report
from millrace.plans.star import build_star, export_star, publish_star
from millrace.session import empty_frame
from millrace.sources import readers, writers
from millrace.sources.warehouse import Warehouse
from millrace.streaming.micro_batch import attentions_loader, ingest_files

BASE = {
    "ANIO": 2023, "MES": 1, "DIA": 1, "CATEGORIA": "I-1", "RED": "NORTE", "MICRORED": "M1",
    "CODIGO_UNICO": 10, "NOMBRE_ESTACLECIMIENTO": "POSTA UNO", "PROVINCIA": "P1", "DISTRITO": "D1",
    "EDAD_REG": 4, "TIPO_EDAD": "A", "SEXO": "F", "ETNIA": "E1", "TIPO_SEGURO": "S.I.S", "UPS": "U1",
    "ATENDIDOS": 1, "ATENCIONES": 3, "FECHA_CORTE": "20231220",
}


def flat(spark, *changes, text=False):
    schema = schemas.ATTENTIONS_TEXT if text else schemas.ATTENTIONS
    as_text = {"EDAD_REG", "ATENDIDOS", "ATENCIONES"} if text else set()
    rows = []
    for change in changes:
        row = {**BASE, **change}
        rows.append(
            tuple(str(row[c]) if c in as_text and row[c] is not None else row[c] for c in schema.names)
        )
    return spark.createDataFrame(rows, schema).coalesce(1)


def numbered(df, name="src_seq"):
    return df.withColumn(name, F.monotonically_increasing_id())


def fact_table(wh):
    return wh.table(attentions.FACT_TABLE, schemas.ATTENTION_FACT)


def staged(wh, df):
    attentions.stage(wh, df)
    return wh.table(attentions.STAGING_TABLE, attentions.staging_schema())


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_star_build(spark, tmp_path, wh):
    df = flat(
        spark,
        {"EDAD_REG": -1},
        {"EDAD_REG": -1, "UPS": None, "DIA": 2},
        {"NOMBRE_ESTACLECIMIENTO": "OTRO NOMBRE", "ATENDIDOS": "abc", "ATENCIONES": -2, "MES": 5},
        {"UPS": " U1\t", "EDAD_REG": -1},
        {"DIA": 30, "MES": 2},
        {"CODIGO_UNICO": 3, "SEXO": "M"},
        text=True,
    )
    star = build_star(numbered(df))
    assert [tuple(r)[:3] for r in star.log.collect()] == [
        ("EXTRACCION", 6, 6),
        ("LIMPIEZA_DUPLICADOS", 6, 5),
        ("NORMALIZACION", 6, 4),
        ("CARGA_MODELO_DIMENSIONAL", 4, 4),
        ("FIN", 4, 4),
    ]
    assert star.log.collect()[2]["Detalle"].endswith("desconocida: 2; fechas inválidas descartadas: 1.")
    times = star.dim_tiempo.orderBy("IdTiempo").collect()
    assert [(r["IdTiempo"], r["Fecha"], r["Trimestre"], r["NombreMes"]) for r in times] == [
        (1, date(2023, 1, 1), 1, "Enero"),
        (2, date(2023, 1, 2), 1, "Enero"),
        (3, date(2023, 5, 1), 2, "Mayo"),
    ]
    places = star.dim_establecimiento.orderBy("IdEstablecimiento").collect()
    assert [(r[0], r[1], r[2]) for r in places] == [(1, 3, "POSTA UNO"), (2, 10, "POSTA UNO")]
    profiles = star.dim_paciente.orderBy("IdPaciente").collect()
    assert [(r["Edad"], r["Sexo"]) for r in profiles] == [(None, "F"), (4, "F"), (4, "M")]
    assert [tuple(r) for r in star.dim_servicio.orderBy("IdServicio").collect()] == [(1, ""), (2, "U1")]
    fact = sorted(tuple(r)[:6] for r in star.fact.collect())
    assert fact == [(1, 1, 3, 2, 1, 3), (1, 2, 1, 2, 1, 3), (2, 2, 1, 1, 1, 3), (3, 2, 2, 2, 0, 0)]

    export_star(star, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv" / "FactAtenciones"), header=True)
    assert back.count() == 4 and back.columns == star.fact.columns
    report = star_report(star).collect()
    assert len(report) > 20 and {r["violaciones"] for r in report} == {0}
    assert publish_star(star, wh)["FactAtenciones"] == 4
    with pytest.raises(writers.TargetNotEmpty):
        publish_star(star, wh)
    assert build_star(numbered(df), sample=2).fact.count() == 2


def test_loads_are_idempotent_and_logged(spark, wh):
    rows = staged(
        wh,
        flat(
            spark,
            {},
            {"ATENCIONES": 9},
            {"SEXO": "X"},
            {"SEXO": None},
            {"DIA": 2, "EDAD_REG": 120},
            {"DIA": 3, "RED": "SUR", "CODIGO_UNICO": 11},
        ),
    )
    assert attentions.load_dimensions(wh, rows).inserted == 2
    first = attentions.load_attentions(wh, rows)
    assert (first.inserted, first.rejected) == (3, 2)  # equal grains in one batch both load
    assert attentions.load_dimensions(wh, rows).inserted == 0
    second = attentions.load_attentions(wh, rows)
    assert (second.inserted, second.rejected) == (0, 2)
    ids = [r["AtencionId"] for r in fact_table(wh).collect()]
    assert len(set(ids)) == len(ids) == 3
    assert {(r["Anio"], r["Mes"]) for r in fact_table(wh).collect()} == {(2023, 1)}
    # The same microred name in two networks is two members.
    assert wh.table("Microred", attentions.MICRORED.schema).count() == 2
    states = [r["Estado"] for r in latest(wh.table(RUN_TABLE, schemas.RUN_LOG)).collect()]
    assert states == ["OK"] * 4
    assert tuple(attentions.statistics_check(wh).first()) == (6, 3, 2)
    lookups = {k.table: wh.table(k.table, k.schema) for k in attentions.SERVICES}
    where = attentions.account_for(
        rows, wh.table("Establecimiento", schemas.FACILITY), lookups, empty_frame(spark, schemas.ATTENTION_FACT)
    )
    assert where.first().asDict() == {
        "staged": 6, "rejected_rows": 2, "violations": 2, "silently_dropped": 1,
        "already_present": 0, "inserted": 3,
    }
    attentions.seed_age_units(wh)
    attentions.seed_age_units(wh)
    report = {r["regla"]: r["violaciones"] for r in attentions.model_report(wh).collect()}
    assert len(report) == 24 and set(report.values()) == {0}
    wide = rows.withColumn("TIPO_SEGURO", F.repeat(F.lit("x"), F.lit(21)))
    bad = {r["regla"]: r["violaciones"] for r in attentions.staging_report(wide).collect()}
    assert bad.pop("WIDTH TIPO_SEGURO <= 20") == 6 and set(bad.values()) == {0}
    # New rows continue ids and a single new member is added.
    more = staged(wh, flat(spark, {"DIA": 9, "UPS": "U2"})).filter("DIA = 9")
    attentions.load_dimensions(wh, more)
    assert attentions.load_attentions(wh, more, dedupe_batch=True).inserted == 1
    assert {r["UpsId"]: r["Nombre"] for r in wh.table("Ups", attentions.UPS.schema).collect()} == {1: "U1", 2: "U2"}


def test_facility_conflict_undoes_only_its_block(spark, wh):
    rows = staged(wh, flat(spark, {}, {"NOMBRE_ESTACLECIMIENTO": "OTRO"}))
    result = attentions.load_dimensions(wh, rows)
    assert result.inserted == 0 and "UNIQUE CodigoUnico" in result.partial_error
    assert wh.table("Red", attentions.RED.schema).count() == 1
    assert wh.table("Establecimiento", schemas.FACILITY).count() == 0
    states = {r["Estado"] for r in wh.table(RUN_TABLE, schemas.RUN_LOG).collect()}
    assert states == {"OK", "ERROR_PARCIAL"}
    assert attentions.load_dimensions(wh, rows, on_conflict="keep_first").inserted == 1


def test_missing_member_stops_all_lookups(spark, wh):
    with pytest.raises(QualityError, match="NOT NULL"):
        attentions.load_dimensions(wh, staged(wh, flat(spark, {"RED": None}, {})))
    assert wh.table("Ups", attentions.UPS.schema).count() == 0
    assert [r["Estado"] for r in wh.table(RUN_TABLE, schemas.RUN_LOG).collect()] == ["ERROR"]


@pytest.mark.parametrize("cause", ["bad date", "closed period"])
def test_failed_fact_load_keeps_rejects(spark, wh, cause):
    rows = staged(wh, flat(spark, {"SEXO": "X"}, {"DIA": 31, "MES": 4} if cause == "bad date" else {}))
    attentions.load_dimensions(wh, rows)
    if cause == "closed period":
        closed = readers.literal_rows(spark, [(2023, 1, date(2023, 2, 1))], schemas.CLOSED_PERIODS)
        wh.publish(append={attentions.CLOSED_TABLE: closed})
    with pytest.raises(Exception, match="DATETIME_FIELD_OUT_OF_BOUNDS|closed period"):
        attentions.load_attentions(wh, rows)
    assert fact_table(wh).count() == 0
    assert wh.table(attentions.REJECT_TABLE, schemas.REJECT_LOG).count() == 1
    last = latest(wh.table(RUN_TABLE, schemas.RUN_LOG), process=attentions.LOAD_FACT).first()
    assert (last["Estado"], last["FilasInsertadas"], last["FilasRechazadas"]) == ("ERROR", 0, 1)


REIMB = ("31/12/2025", " LIMA ", "SEDE A ", "AMB", "MESA", "Asegurado", "TITULAR", "NA", "RETIRO", " 3 ", "4", "S/ 1,225.50")


def test_reimbursements(spark, wh):
    rows = [
        REIMB,
        ("   ", *[""] * 11),
        (*REIMB[:2], "SEDE B", *REIMB[3:9], "6", "6", "S/ 9.99"),
    ]
    reimbursements.stage(wh, spark.createDataFrame(rows, schemas.REIMBURSEMENTS))
    df = wh.table(reimbursements.STAGING_TABLE, reimbursements.staging_schema())
    first = reimbursements.load_reimbursements(wh, df)
    assert (first.inserted, first.rejected) == (2, 1)
    assert reimbursements.load_reimbursements(wh, df).inserted == 0
    fact = wh.table("Reembolso", schemas.REIMBURSEMENT_FACT)
    assert sorted(r["MontoPagado"] for r in fact.collect()) == [Decimal("9.99"), Decimal("1225.50")]
    view = reimbursements.warehouse_view(wh)
    assert [(r["Sede"], r["TotalAsegurados"]) for r in view.collect()] == [("SEDE B", 6)]
    assert reimbursements.warehouse_view(wh, k=1).count() == 2
    log = reimbursements.audit_reimbursements(fact.filter("1 = 0"), fact)
    assert {r["Operacion"] for r in log.collect()} == {"I"}
    analyst = published.datasets(wh, "analyst")
    assert "vw_ReembolsosAgregado" in analyst and "Reembolso" not in analyst and RUN_TABLE not in analyst
    assert {"Reembolso", RUN_TABLE} <= set(published.register(wh, "auditor"))
    report = {r["regla"]: r["violaciones"] for r in reimbursements.model_report(wh).collect()}
    assert len(report) > 30 and set(report.values()) == {0}
    wide = {r["regla"]: r["violaciones"] for r in reimbursements.staging_report(df.withColumn("Sede", F.repeat("Sede", F.lit(30)))).collect()}
    assert wide["WIDTH Sede <= 80"] == 2
    assert reimbursements.AUDIT_TABLE not in published.datasets(wh, "auditor")  # no audience is given that log
    audit = wh.table(reimbursements.AUDIT_TABLE, schemas.REIMBURSEMENT_AUDIT)
    assert sorted((r["Operacion"], r["MontoPagado_Nuevo"]) for r in audit.collect()) == [
        ("I", Decimal("9.99")), ("I", Decimal("1225.50")),
    ]
    assert "vw_ReembolsosAgregado" not in published.datasets(wh, "auditor") and "TipoEdad" in analyst


def test_missing_period_fails_but_catalogues_stay(spark, wh):
    rows = [(None, *REIMB[1:]), REIMB]
    df = spark.createDataFrame(rows, schemas.REIMBURSEMENTS)
    with pytest.raises(QualityError, match="NOT NULL Periodo"):
        reimbursements.load_reimbursements(wh, df)
    assert wh.table("Reembolso", schemas.REIMBURSEMENT_FACT).count() == 0
    assert wh.table("Sede", reimbursements.SEDE.schema).count() == 1


def test_region_extension(spark):
    provinces = spark.createDataFrame([(1, "P1"), (2, "P2")], "ProvinciaId int, Nombre string")
    regions = spark.createDataFrame([(1, "SAN MARTIN")], "RegionId int, Nombre string")
    got = attentions.extend_with_region(provinces, regions, "SAN MARTIN")
    assert [r["RegionId"] for r in got.collect()] == [1, 1]
    with pytest.raises(QualityError):
        attentions.extend_with_region(provinces, regions, "OTRA")


def test_documents(spark, tmp_path):
    df = flat(spark, {"EDAD_REG": -1, "MICRORED": " MÁ "}, {"DIA": 31, "MES": 6, "PROVINCIA": "P2", "ATENCIONES": 8})
    docs = documents.build_documents(df)
    path = str(tmp_path / "docs")
    writers.write_documents(docs, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert any('"fecha":null' in line for line in lines)
    assert any('"fecha":{"$date":"2023-01-01T00:00:00Z"}' in line and '"edad":null' in line for line in lines)
    assert any("MÁ" in line for line in lines)
    back = readers.read_documents(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    broken = documents.document_violations(docs).collect()
    assert [tuple(r) for r in broken] == [("fecha", "required")]
    wrong = docs.withColumn("establecimiento", F.col("establecimiento").withField("codigo", F.lit("x"))).drop("ups")
    kinds = {(r["ruta"], r["regla"]) for r in documents.document_violations(wrong).collect()}
    assert {("establecimiento.codigo", "type"), ("ups", "required")} <= kinds
    assert [tuple(r) for r in documents.totals_by_province(docs).collect()] == [("P2", 8, 1), ("P1", 3, 1)]
    found = documents.find(docs, {"paciente.seguro": "S.I.S", "establecimiento.provincia": "P2"},
                           ["establecimiento.nombre", "atenciones"], limit=10)
    assert found.first().asDict(True) == {"establecimiento": {"nombre": "POSTA UNO"}, "atenciones": 8}


def test_keyed_edits(spark):
    docs = documents.build_documents(flat(spark, {}, {"DIA": 2}))
    coll = documents.with_document_id(docs, content_hash=True)
    coll, made = documents.insert_one(coll, docs.limit(1).withColumn("origen", F.lit("prueba")))
    assert coll.count() == 3
    change = {"establecimiento.categoria": "I-1 ACTUALIZADA", "actualizadoPor": "equipo"}
    coll, changed = documents.update_one(coll, made, change)
    assert changed == 1 and documents.update_one(coll, made, change)[1] == 0
    doc = documents.find(coll, {"_id": made}).first()
    assert (doc["establecimiento"]["categoria"], doc["actualizadoPor"], doc["origen"]) == ("I-1 ACTUALIZADA", "equipo", "prueba")
    coll, gone = documents.delete_one(coll, made)
    assert gone == 1 and documents.delete_one(coll, made)[1] == 0
    assert coll.count() == 2


def test_documents_are_checked_one_by_one(spark):
    good = '{"fecha":{"$date":"2023-01-01T00:00:00.000Z"},"establecimiento":{"codigo":1,"nombre":"A"},"paciente":{},"ups":"u","atendidos":1,"atenciones":2,"mas":[1]}'
    lines = [
        good, good.replace('"paciente":{}', '"paciente":{"edad":null}'), good.replace('"codigo":1', '"codigo":"1"'),
        good.replace('"ups":"u",', ""), good.replace('"ups":"u"', '"ups":null'), good.replace('"nombre":"A"', '"red":null'),
        good.replace("2023-01-01T", "2023-13-01T"), good.replace('"paciente":{}', '"paciente":{"edad":3.5}'), "{",
        good.replace('"establecimiento":{"codigo":1,"nombre":"A"},', ""),
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = {}
    for r in documents.json_violations(df, id_column="i").collect():
        got.setdefault(r["i"], set()).add((r["ruta"], r["regla"]))
    assert got == {
        2: {("establecimiento.codigo", "type")}, 3: {("ups", "required")}, 4: {("ups", "type")},
        5: {("establecimiento.nombre", "required"), ("establecimiento.red", "type")}, 6: {("fecha", "type")},
        7: {("paciente.edad", "type")}, 8: {("", "json")}, 9: {("establecimiento", "required")},
    }


def test_open_fields_and_fractions(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text(
        '{"fecha":{"$date":"2023-01-02T00:00:00.000Z"},"ups":"u","origen":"x","n":3}\n'
        '{"fecha":{"$date":"2023-99-02T00:00:00Z"},"ups":"v"}\n{"fecha":null}\n'
    )
    rows = readers.read_documents(spark, str(path), extras="extras").collect()
    assert [(r["fecha"], r["ups"], r["extras"]) for r in rows] == [
        (date(2023, 1, 2), "u", {"origen": "x", "n": "3"}), (None, "v", None), (None, None, None),
    ]
    assert readers.read_documents(spark, str(path)).first()["fecha"] == date(2023, 1, 2)


def test_delimited_both_ways(spark, tmp_path):
    import csv

    values = [("  pad ", 1), ('say "hi"', 2), ('x "y" ; z', 3), ("back\\", 4), ("", 5), (None, 6), ("line\nbreak", 7), (";", 8)]
    schema = schemas.record(a=schemas.TEXT, b=schemas.INT)
    path = tmp_path / "in.csv"
    with path.open("w", newline="") as out:
        csv.writer(out, delimiter=";").writerows([("a", "b"), *values])
    expected = [(v or None, n) for v, n in values]
    df = readers.read_delimited(spark, str(path), schema, multi_line=True)
    assert [tuple(r) for r in df.collect()] == expected
    writers.write_delimited(df, str(tmp_path / "out"), sep=";")
    back = readers.read_delimited(spark, str(tmp_path / "out"), schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == expected


def test_row_ids_of_many_tasks(spark):
    from millrace.sources.warehouse import row_id

    serials = [(t << 33) | p for t in (0, 1, 1 << 20, (1 << 20) + 1, (1 << 24) - 1) for p in (0, 1, 2, (1 << 33) - 1)]
    df = spark.createDataFrame([(s,) for s in serials], "s bigint")
    ids = [r[0] for r in df.select(row_id(F.col("s"), 100)).collect()]
    assert len(set(ids)) == len(ids) and min(ids) > 100
    with pytest.raises(Exception, match="more write tasks"):
        spark.createDataFrame([((1 << 24) << 33,)], "s bigint").select(row_id(F.col("s"), 0)).collect()


def test_closed_period_lets_a_loaded_batch_run_again(spark, wh):
    rows = staged(wh, flat(spark, {}, {"DIA": 2}))
    attentions.load_dimensions(wh, rows)
    assert attentions.load_attentions(wh, rows).inserted == 2
    closed = readers.literal_rows(spark, [(2023, 1, date(2023, 2, 1))], schemas.CLOSED_PERIODS)
    wh.publish(append={attentions.CLOSED_TABLE: closed})
    assert attentions.load_attentions(wh, rows).inserted == 0
    audit = wh.table(attentions.AUDIT_TABLE, schemas.ATTENTION_AUDIT)
    assert {(r["Operacion"], r["Atenciones_Anterior"]) for r in audit.collect()} == {("I", None)} and audit.count() == 2


def test_blank_and_unreadable_reimbursements(spark, wh):
    rows = [REIMB, ("   ", *[""] * 11), (*REIMB[:2], "SEDE B", *REIMB[3:11], "S/ uno")]
    reimbursements.stage(wh, spark.createDataFrame(rows, schemas.REIMBURSEMENTS))
    table = lambda: wh.table(reimbursements.STAGING_TABLE, reimbursements.staging_schema())
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reimbursements.load_reimbursements(wh, table())
    first = reimbursements.load_reimbursements(wh, table(), on_bad_value="reject")
    assert (first.inserted, first.rejected) == (1, 1)  # the blank row left with the run before
    assert table().count() == 2
    log = wh.table(attentions.REJECT_TABLE, schemas.REJECT_LOG).first()
    assert (log["Campo"], log["ValorOriginal"]) == ("MontoPagado", "S/ uno")


def test_reader_options(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("﻿a;b\n1;x\nzz;y\n3;w\n", encoding="utf-8")
    schema = schemas.record(a=schemas.INT, b=schemas.TEXT)
    df = readers.read_delimited(spark, str(path), schema, keep_corrupt=True).cache()
    assert [(r["a"], r["b"], r["_corrupt"]) for r in df.collect()] == [(1, "x", None), (None, "y", "zz;y"), (3, "w", None)]
    assert [r["b"] for r in readers.read_delimited(spark, str(path), schema, columns=["b"], limit=2).collect()] == ["x", "y"]


def test_warehouse_publishes_whole_loads(spark, wh):
    one = spark.range(3)
    wh.publish(append={"a": one, "b": one})
    with pytest.raises(Exception, match="boom"):
        wh.publish(append={"a": one, "b": one.select(F.raise_error(F.lit("boom")).cast("long").alias("id"))})
    assert wh.table("a", one.schema).count() == 3
    wh.publish(replace={"a": spark.range(1)})
    assert wh.table("a", one.schema).count() == 1
    wh.drop("a", one.schema)
    assert wh.table("a", one.schema).count() == 0


def test_layout_prunes_directories(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "cast(2020 + id % 3 as int) AS Anio", "cast(id % 12 + 1 as int) AS Mes", "'S' AS k")
    path = str(tmp_path / "layout")
    writers.write_layout(df, path, ["Anio", "Mes"], ["k", "id"])
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 1000
    plan = back.filter("Anio = 2021 AND Mes = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Anio" in plan


def test_jdbc_options():
    options = writers.jdbc_options("jdbc:x", "t", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "5000", "numPartitions": "8", "user": "u"}


def test_replayed_micro_batch_adds_nothing(spark, wh):
    batch = flat(spark, {}, {"SEXO": "X"}).select(*schemas.ATTENTIONS.names)
    load = attentions_loader(wh)
    staging = lambda: wh.table(attentions.STAGING_TABLE, attentions.staging_schema()).count()
    load(batch, 0)
    load(batch, 0)
    assert (staging(), fact_table(wh).count(), wh.table(attentions.REJECT_TABLE, schemas.REJECT_LOG).count()) == (2, 1, 1)
    # the same after a failure between staging and the end
    done = wh.table("MicroLote", schemas.MICRO_BATCH).filter("Estado <> 'OK'")
    wh.publish(replace={"MicroLote": readers.literal_rows(spark, [tuple(r) for r in done.collect()], schemas.MICRO_BATCH)})
    load(batch, 0)
    assert (staging(), fact_table(wh).count(), wh.table(attentions.REJECT_TABLE, schemas.REJECT_LOG).count()) == (2, 1, 1)


def test_micro_batches(spark, tmp_path, wh):
    source = tmp_path / "in"
    source.mkdir()
    header = ";".join(schemas.ATTENTIONS.names)
    line = ";".join(str(v) for v in BASE.values())
    progress = str(tmp_path / "progress")

    def run():
        q = ingest_files(spark, str(source), schemas.ATTENTIONS, attentions_loader(wh), progress)
        q.awaitTermination()

    (source / "1.csv").write_text(f"{header}\n{line}\n")
    run()
    assert fact_table(wh).count() == 1
    (source / "2.csv").write_text(f"{header}\n{line}\n{line.replace('POSTA', 'POSTA', 1).replace('2023;1;1', '2023;1;7')}\n")
    run()
    assert fact_table(wh).count() == 2


@pytest.mark.skipif("ATTENTIONS_SAMPLE" not in os.environ, reason="the 2,000-row sample file is not shipped")
def test_golden_sample(spark):
    """Known totals of the public 2,000-row sample (a ';' file named by ATTENTIONS_SAMPLE)."""
    df = readers.read_attentions(spark, os.environ["ATTENTIONS_SAMPLE"], text_numbers=True, source_order=True)
    log = build_star(df).log.collect()
    assert log[3]["Detalle"] == "DimTiempo=4, DimEstablecimiento=295, DimPaciente=585, DimServicio=27."
    assert log[4]["FilasSalida"] == 2000
