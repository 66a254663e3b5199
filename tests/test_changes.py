"""Keyed changes of published facts, added columns, bucketed tables, counts taken while writing."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.operators.quality import QualityError
from millrace.plans import attentions, reimbursements
from millrace.plans.changes import attention_model, change_facts, reimbursement_model
from millrace.queries.analytics import joined_in_place
from millrace.sources.warehouse import Warehouse
from millrace.sources.writers import attach_bucketed, write_bucketed
from tests.test_plans import flat, staged


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def fact_rows(spark, n=60):
    """A row each ten days from January 2023; ids from 0."""
    day = F.expr("date_add(DATE'2023-01-01', cast(id * 10 as int))")
    special = {"AtencionId": F.col("id"), "Fecha": day, "Anio": F.year(day), "Mes": F.month(day), "FechaCorte": day,
               "Sexo": F.lit("F"), "TipoEdad": F.lit("A"), "Atenciones": (F.col("id") % 7 + 1).cast("int")}
    return spark.range(n).select(
        *[special.get(f.name, F.lit(1)).cast(f.dataType).alias(f.name) for f in schemas.ATTENTION_FACT.fields]
    )


def loaded(spark, wh):
    wh.publish(append={"Atencion": fact_rows(spark)}, partition_by={"Atencion": ["Anio", "Mes"]}, ids={"Atencion": "AtencionId"})
    return wh.table("Atencion", schemas.ATTENTION_FACT)


def changes(spark, rows):
    return spark.createDataFrame(rows, "AtencionId bigint, Operacion string, Atenciones int, Fecha date")


def files(wh):
    return {str(p) for p in Path(wh.root, "Atencion").rglob("*.parquet")}


def test_only_touched_months_are_written_again(spark, wh):
    before = {r.AtencionId: r for r in loaded(spark, wh).collect()}
    old_files = files(wh)
    result = change_facts(wh, attention_model(), changes(spark, [
        (2, "U", 50, None), (3, "D", None, None), (4, "U", None, date(2023, 7, 7)), (9, "D", None, None),
        (777, "U", 1, None), (778, "D", None, None),
    ]))
    assert (result.updated, result.deleted, result.unmatched) == (2, 2, 2)
    assert result.partitions == [(2023, 1), (2023, 2), (2023, 4), (2023, 7)]
    stored = wh.table("Atencion", schemas.ATTENTION_FACT)
    after = {r.AtencionId: r for r in stored.collect()}
    assert set(after) == set(before) - {3, 9}
    assert after[2].Atenciones == 50 and after[4].Fecha == date(2023, 7, 7) and after[4].Mes == 7
    assert all(after[i] == before[i] for i in after if i not in (2, 4))
    # the files of other months are those of the load, and the only ones read for them
    assert old_files <= files(wh)
    new = {p.split("/batch=")[1].split("/", 1)[1].rsplit("/", 1)[0] for p in files(wh) - old_files}
    assert new == {"Anio=2023/Mes=1", "Anio=2023/Mes=2", "Anio=2023/Mes=4", "Anio=2023/Mes=7"} - {"Anio=2023/Mes=4"} | (
        new & {"Anio=2023/Mes=4"})
    read = {r[0].removeprefix("file://") for r in stored.select(F.input_file_name()).distinct().collect()}
    untouched = {p for p in old_files if not any(f"/{m}/" in p for m in ("Mes=1", "Mes=2", "Mes=4", "Mes=7")) or "Anio=2024" in p}
    assert untouched <= read and not {p for p in read & old_files if p not in untouched}

    log = wh.table("LogAuditoriaAtencion", schemas.ATTENTION_AUDIT).orderBy("AtencionId").collect()
    assert [(r.Operacion, r.AtencionId, r.Atenciones_Anterior, r.Atenciones_Nuevo, r.Fecha) for r in log] == [
        ("U", 2, before[2].Atenciones, 50, before[2].Fecha), ("D", 3, before[3].Atenciones, None, before[3].Fecha),
        ("U", 4, before[4].Atenciones, before[4].Atenciones, date(2023, 7, 7)), ("D", 9, before[9].Atenciones, None, before[9].Fecha),
    ]
    assert len({r.AuditId for r in log}) == 4 and all(r.UsuarioBD and r.FechaHora for r in log)


def test_changes_upon_changes_and_new_batches(spark, wh):
    loaded(spark, wh)
    change_facts(wh, attention_model(), changes(spark, [(0, "U", 100, None), (1, "D", None, None), (2, "D", None, None), (3, "D", None, None)]))
    more = fact_rows(spark, 1).withColumn("AtencionId", F.lit(500).cast("bigint"))
    wh.publish(append={"Atencion": more}, partition_by={"Atencion": ["Anio", "Mes"]})
    change_facts(wh, attention_model(), changes(spark, [(0, "U", 101, None), (500, "U", 102, None)]), between=("2023-01-01", "2023-01-31"))
    rows = {r.AtencionId: r.Atenciones for r in wh.table("Atencion", schemas.ATTENTION_FACT).filter("Anio = 2023 AND Mes = 1").collect()}
    assert rows == {0: 101, 500: 102}
    # nothing is touched beyond the bounds
    out = change_facts(wh, attention_model(), changes(spark, [(0, "D", None, None)]), between=("2023-06-01", None))
    assert out.unmatched == 1 and wh.table("Atencion", schemas.ATTENTION_FACT).filter("AtencionId = 0").count() == 1
    assert change_facts(wh, attention_model(), changes(spark, [])).unmatched == 0
    # a month that is emptied stays empty
    change_facts(wh, attention_model(), changes(spark, [(0, "D", None, None), (500, "D", None, None)]))
    assert wh.table("Atencion", schemas.ATTENTION_FACT).filter("Anio = 2023 AND Mes = 1").count() == 0


@pytest.mark.parametrize("rows", [
    [(1, "U", -5, None)], [(1, "X", 1, None)], [(1, "U", 1, None), (1, "D", None, None)], [(None, "D", None, None)],
    [(1, None, None, None)],
])
def test_a_bad_change_changes_nothing(spark, wh, rows):
    before = sorted(loaded(spark, wh).collect())
    with pytest.raises(QualityError):
        change_facts(wh, attention_model(), changes(spark, [(5, "D", None, None), *rows]))
    assert sorted(wh.table("Atencion", schemas.ATTENTION_FACT).collect()) == before


def test_closed_periods_stay_closed(spark, wh):
    loaded(spark, wh)
    wh.publish(append={"PeriodoCerrado": spark.createDataFrame([(2023, 2, None)], schemas.CLOSED_PERIODS)})
    for row in [(4, "D", None, None), (0, "U", None, date(2023, 2, 3))]:
        with pytest.raises(QualityError, match="closed"):
            change_facts(wh, attention_model(), changes(spark, [row]))
    assert change_facts(wh, attention_model(), changes(spark, [(0, "U", 9, None)])).updated == 1


def test_reimbursements_change_too(spark, wh):
    row = (7, date(2023, 1, 31), 1, 1, 1, 1, 1, 1, 1, 10, 12, None, 2023, 1)
    fact = spark.createDataFrame([row], schemas.REIMBURSEMENT_FACT).withColumn("MontoPagado", F.lit("5.50").cast("decimal(12,2)"))
    wh.publish(append={"Reembolso": fact}, partition_by={"Reembolso": ["Anio", "Mes"]})
    given = spark.createDataFrame([(7, "U", "9.25")], "ReembolsoId bigint, Operacion string, MontoPagado string")
    assert change_facts(wh, reimbursement_model(), given).updated == 1
    log = wh.table(reimbursements.AUDIT_TABLE, schemas.REIMBURSEMENT_AUDIT).first()
    assert (log.Operacion, str(log.MontoPagado_Anterior), str(log.MontoPagado_Nuevo)) == ("U", "5.50", "9.25")


def test_added_columns(spark, wh):
    first = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    rows = lambda *r: spark.createDataFrame(list(r), first)
    wh.publish(append={"t": rows((1, "a"), (2, "b"))})
    wh.add_column("t", "region", T.IntegerType(), 7)
    read = lambda: sorted(map(tuple, wh.table("t", wh.schema("t", first)).collect()))
    assert read() == [(1, "a", 7), (2, "b", 7)] and wh.table("t", first).columns == ["id", "name"]
    for bad in (rows((3, "c")), rows((3, "c")).withColumn("region", F.lit(None).cast("int"))):
        with pytest.raises(QualityError, match="NOT NULL region"):
            wh.publish(append={"t": bad})
    wh.publish(append={"t": rows((3, "c")).withColumn("region", F.lit(9))})
    wh.add_column("t", "note", T.StringType(), None, required=False)
    wh.publish(append={"t": rows((4, "d")).withColumn("region", F.lit(9))})
    assert read() == [(1, "a", 7, None), (2, "b", 7, None), (3, "c", 9, None), (4, "d", 9, None)]
    with pytest.raises(QualityError):
        wh.add_column("t", "late", T.IntegerType(), None)
    with pytest.raises(ValueError):
        wh.add_column("t", "note", T.StringType(), "x")


def test_provinces_get_a_region(spark, wh):
    attentions.load_dimensions(wh, staged(wh, flat(spark, {}, {"PROVINCIA": "P2", "CODIGO_UNICO": 11})))
    san_martin = attentions.add_region_to_provinces(wh, "SAN MARTIN")
    wh.publish(append={"Region": spark.createDataFrame([(san_martin + 1, "LORETO")], attentions.REGION_SCHEMA)})
    later = staged(wh, flat(spark, {}, {"PROVINCIA": "P3", "CODIGO_UNICO": 12}))
    with pytest.raises(QualityError):
        attentions.load_dimensions(wh, later)
    with pytest.raises(QualityError):
        attentions.load_dimensions(wh, later, region="NOWHERE")
    attentions.load_dimensions(wh, later, region="LORETO")
    got = {r.Nombre: r.RegionId for r in attentions.provinces(wh).collect()}
    assert got == {"P1": san_martin, "P2": san_martin, "P3": san_martin + 1}


def test_counts_are_taken_while_writing(spark, wh):
    """Publishing runs one job for the frame and one for the note; empty frames are counted too."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish", "")
    counts = wh.publish(append={"t": spark.range(1000).withColumnRenamed("id", "k")}, ids={"t": "k"})
    jobs = len(tracker.getJobIdsForGroup("publish"))
    spark.sparkContext._jsc.clearJobGroup()
    assert counts == {"t": 1000} and wh.highest_id("t") == 999 and jobs <= 2
    assert wh.publish(append={"t": spark.range(0).withColumnRenamed("id", "k")}, ids={"t": "k"}) == {"t": 0}
    from millrace.session import empty_frame

    schema = T.StructType([T.StructField("k", T.LongType())])
    assert wh.publish(append={"t": empty_frame(spark, schema)}, ids={"t": "k"}) == {"t": 0}
    assert wh.table("t", schema).count() == 1000


def test_bucketed_tables_are_joined_and_grouped_in_place(spark, tmp_path):
    orders = spark.range(500).selectExpr("id AS o_orderkey", "cast(id % 3 AS string) AS o_orderpriority")
    lines = spark.range(2000).selectExpr("id % 500 AS l_orderkey", "1.5D AS l_quantity", "DATE'2023-01-01' AS l_shipdate")
    df = joined_in_place(orders, lines)
    assert df.count() == 500 and df.agg(F.sum("n_lines")).first()[0] == 2000
    plan = joined_in_place(orders, lines)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 16 out of 16" in plan

    path = str(tmp_path / "b")
    write_bucketed(lines, "first_name", path, ["l_orderkey"], 4, ["l_shipdate"])
    again = attach_bucketed(spark, "second_name", path, lines.schema, ["l_orderkey"], 4, ["l_shipdate"])
    grouped = again.groupBy("l_orderkey").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString() and grouped.count() == 500
    one = again.filter("l_orderkey = 3")
    assert one.count() == 4
    for name in ("first_name", "second_name"):
        spark.sql(f"DROP TABLE {name}")
