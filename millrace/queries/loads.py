"""Lookup, facility and fact loads, rejects, constraints, change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.numbers import parse_number
from millrace.operators.audit import change_log, replay
from millrace.operators.joins import orphans
from millrace.operators.keys import dense_ids
from millrace.operators.quality import (
    QualityError,
    castable,
    foreign_key_check,
    max_width,
    not_null,
    reject_counts,
    row_checks,
    rows_in_closed_periods,
    unique_check,
)
from millrace.plans import attentions as att
from millrace.plans import reimbursements as reimb
from millrace.plans.changes import attention_model, change_facts
from millrace.plans.lookups import Lookup, load_lookups, new_members, new_members_collated, resolve_collated
from millrace.plans.run_log import RUN_TABLE, latest
from millrace.plans.scripts import create_lookup_table, run_lookup_script
from millrace.queries.base import query, table
from millrace.queries.frames import (
    AGE_BOUNDS_SQL,
    FACILITIES_SQL,
    STAGED_SQL,
    VALID_SQL,
    facilities,
    staged,
)
from millrace.session import empty_frame, materialize, scratch_path
from millrace.sources.readers import literal_rows
from millrace.sources.warehouse import Warehouse
from millrace.sources.writers import with_backfilled_column

_CLIENT = Lookup("Cliente", "ClienteId", "c_name")
_NATION = Lookup("Nacion", "NacionId", "n_name")
_SEGMENT = Lookup("Segmento", "SegmentoId", "c_mktsegment", parent=_NATION)


@query(
    "lookup_load",
    """
WITH existing AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer WHERE c_acctbal < 0)
SELECT CAST((SELECT count(*) FROM existing) + row_number() OVER (ORDER BY c_name) AS INT) AS "ClienteId",
       c_name AS "Nombre"
FROM customer ANTI JOIN existing USING (c_name)
""",
)
def lookup_load(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").withColumnRenamed("c_name", "Nombre")
    known = customers.filter("c_acctbal < 0").select("Nombre").distinct()
    existing, _ = dense_ids(known, ["Nombre"], "ClienteId")
    return new_members(customers, _CLIENT, existing)


@query(
    "lookup_load_composite",
    """
WITH pairs AS (SELECT DISTINCT c_nationkey + 1 AS nation, c_mktsegment AS segment FROM customer),
existing AS (SELECT DISTINCT c_nationkey + 1 AS nation, c_mktsegment AS segment FROM customer WHERE c_acctbal < 0)
SELECT CAST((SELECT count(*) FROM existing) + row_number() OVER (ORDER BY nation, segment) AS INT) AS "SegmentoId",
       CAST(nation AS INT) AS "NacionId", segment AS "Nombre"
FROM pairs ANTI JOIN existing USING (nation, segment)
""",
)
def lookup_load_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Second level of a hierarchy: the key is the parent's id and the name."""
    members = table(spark, sf, "customer").select(
        (F.col("c_nationkey") + 1).alias("NacionId"), F.col("c_mktsegment").alias("Nombre"), "c_acctbal"
    )
    known = members.filter("c_acctbal < 0").select("NacionId", "Nombre").distinct()
    existing, _ = dense_ids(known, ["NacionId", "Nombre"], "SegmentoId")
    return new_members(members, _SEGMENT, existing)


@query(
    "scripted_load",
    """
WITH existing AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer WHERE c_acctbal < 0),
fresh AS (SELECT c_name, (SELECT count(*) FROM existing) + row_number() OVER (ORDER BY c_name) AS id
          FROM customer ANTI JOIN existing USING (c_name))
SELECT CAST(id AS INT) AS "ClienteId", c_name AS "Nombre", (SELECT count(*) FROM existing) AS primera,
       (SELECT count(*) FROM fresh) AS segunda, CAST(0 AS BIGINT) AS tercera
FROM (SELECT * FROM existing UNION ALL SELECT * FROM fresh)
""",
)
def scripted_load(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the load as a SQL script, with what each inserted."""
    path = scratch_path(spark, "scripted")
    name, view = f"cliente_{path[-32:]}", f"clientes_{path[-32:]}"
    create_lookup_table(spark, _CLIENT, name, path)
    customers = table(spark, sf, "customer").select("c_name", "c_acctbal")
    inserted = []
    for rows in (customers.filter("c_acctbal < 0"), customers, customers):
        rows.createOrReplaceTempView(view)
        inserted.append(run_lookup_script(spark, _CLIENT, name, view).inserted)
    counts = [F.lit(n).cast("bigint").alias(c) for n, c in zip(inserted, ("primera", "segunda", "tercera"), strict=True)]
    return spark.table(name).select("*", *counts)


# Members spelled in several ways: in capitals or not, and with blanks at the end.
_SPELLED = """case c_custkey % 4 when 0 then lower(concat(c_mktsegment, '-', n_name))
  when 1 then concat(c_mktsegment, '-', n_name, '  ') when 2 then concat(c_mktsegment, '-', lower(n_name), ' ')
  else concat(c_mktsegment, '-', n_name) end"""


@query(
    "lookup_load_ci",
    f"""
WITH staged AS (SELECT c_custkey, c_acctbal, {_SPELLED} AS name FROM customer JOIN nation ON n_nationkey = c_nationkey),
keyed AS (SELECT *, lower(rtrim(name, ' ')) AS k FROM staged),
old AS (SELECT k, min(name) AS name FROM keyed WHERE c_acctbal < 0 GROUP BY k),
existing AS (SELECT *, row_number() OVER (ORDER BY name) AS id FROM old),
fresh AS (SELECT k, min(name) AS name FROM keyed ANTI JOIN existing USING (k) GROUP BY k),
members AS (
  SELECT k, name, id FROM existing
  UNION ALL SELECT k, name, (SELECT count(*) FROM existing) + row_number() OVER (ORDER BY name) FROM fresh)
SELECT CAST(id AS INT) AS "GrupoId", m.name AS "Nombre", count(*) AS n_rows, count(DISTINCT s.name) AS spellings
FROM members m JOIN keyed s USING (k) GROUP BY ALL
""",
)
def lookup_load_ci(spark: SparkSession, sf: str) -> DataFrame:
    """Members whose names differ in case or trailing blanks are one: load, then resolve every row."""
    group = Lookup("Grupo", "GrupoId", "grupo")
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    staged_rows = materialize(rows.select("c_custkey", "c_acctbal", F.expr(_SPELLED).alias("grupo")), "spelled")
    named = staged_rows.withColumnRenamed("grupo", "Nombre")
    nothing = empty_frame(spark, group.schema)
    existing = materialize(new_members_collated(named.filter("c_acctbal < 0"), group, nothing), "existing")
    whole = materialize(existing.unionByName(new_members_collated(named, group, existing)), "members")
    resolved = resolve_collated(staged_rows, group, whole)
    counts = resolved.groupBy("GrupoId").agg(F.count("*").alias("n_rows"), F.count_distinct("grupo").alias("spellings"))
    return whole.join(counts, "GrupoId").select("GrupoId", "Nombre", "n_rows", "spellings")


_PLACES = {
    "CODIGO_UNICO": "cast(s_suppkey as int)",
    "NOMBRE_ESTACLECIMIENTO": "s_name",
    "CATEGORIA": "concat('I-', cast(s_nationkey % 4 + 1 as varchar(5)))",
    "RED": "r_name",
    "MICRORED": "n_name",
    "PROVINCIA": "r_name",
    "DISTRITO": "n_name",
    "s_acctbal": "s_acctbal",
}
_PLACES_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _PLACES.items()) + """
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""
_FACILITY_SQL = """
cat AS (SELECT CATEGORIA, row_number() OVER (ORDER BY CATEGORIA) AS id FROM (SELECT DISTINCT CATEGORIA FROM places)),
red AS (SELECT RED, row_number() OVER (ORDER BY RED) AS id FROM (SELECT DISTINCT RED FROM places)),
micro AS (SELECT p.RED, p.MICRORED, row_number() OVER (ORDER BY r.id, p.MICRORED) AS id
          FROM (SELECT DISTINCT RED, MICRORED FROM places) p JOIN red r ON r.RED = p.RED)
"""


def _places(spark: SparkSession, sf: str) -> DataFrame:
    joined = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(*[F.expr(e).alias(n) for n, e in _PLACES.items()])


def _place_lookups(places: DataFrame) -> dict[str, DataFrame]:
    spark = places.sparkSession
    nothing = {k.table: empty_frame(spark, k.schema) for k in att.PLACES}
    return load_lookups(places, att.PLACES, nothing)[1]


@query(
    "facility_load",
    f"""
WITH places AS ({_PLACES_SQL}), {_FACILITY_SQL}
SELECT CODIGO_UNICO AS "CodigoUnico", NOMBRE_ESTACLECIMIENTO AS "Nombre", CAST(cat.id AS INT) AS "CategoriaId",
       CAST(micro.id AS INT) AS "MicroredId", CAST(micro.id AS INT) AS "DistritoId"
FROM places JOIN cat USING (CATEGORIA) JOIN micro USING (RED, MICRORED) WHERE NOT s_acctbal < 0
""",
)
def facility_load(spark: SparkSession, sf: str) -> DataFrame:
    """Facilities not loaded before (those in debt were), with their parents resolved."""
    places = materialize(_places(spark, sf), "places")
    existing = places.filter("s_acctbal < 0").select(F.col("CODIGO_UNICO").alias("CodigoUnico"))
    return att.new_facilities(places.drop("s_acctbal"), _place_lookups(places), existing)


@query(
    "facility_conflicts",
    f"""
WITH places AS ({_PLACES_SQL}), {_FACILITY_SQL}
SELECT CODIGO_UNICO AS "CodigoUnico", NOMBRE_ESTACLECIMIENTO || ' (A)' AS "Nombre",
       CAST(cat.id AS INT) AS "CategoriaId", CAST(micro.id AS INT) AS "MicroredId",
       CAST(micro.id AS INT) AS "DistritoId"
FROM places JOIN cat USING (CATEGORIA) JOIN micro USING (RED, MICRORED)
""",
)
def facility_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Every code comes with two names; the policy 'keep_first' takes one of them."""
    places = materialize(_places(spark, sf).drop("s_acctbal"), "places")
    name = F.col("NOMBRE_ESTACLECIMIENTO")
    doubled = places.withColumn(
        "NOMBRE_ESTACLECIMIENTO",
        F.explode(F.array(F.concat(name, F.lit(" (B)")), F.concat(name, F.lit(" (A)")))),
    )
    none = empty_frame(spark, schemas.FACILITY)
    return att.new_facilities(doubled, _place_lookups(places), none, on_conflict="keep_first")


# Each record once, with the list of what is wrong with it.
_REJECTS_SQL = f"""
WITH staged AS ({STAGED_SQL}), known AS ({FACILITIES_SQL}),
judged AS (
  SELECT StgId, unnest([finding FOR finding IN [
      CASE WHEN SEXO NOT IN ('F', 'M') THEN {{'f': 'SEXO', 'v': SEXO, 'm': 'Valor fuera de dominio (F/M)'}} END,
      CASE WHEN EDAD_REG NOT BETWEEN low AND high THEN {{'f': 'EDAD_REG/TIPO_EDAD',
        'v': concat(EDAD_REG, '/', TIPO_EDAD), 'm': 'Edad fuera de rango para el tipo de edad'}} END,
      CASE WHEN known."CodigoUnico" IS NULL THEN {{'f': 'CODIGO_UNICO', 'v': CAST(CODIGO_UNICO AS VARCHAR),
        'm': 'El establecimiento no existe en dbo.Establecimiento'}} END,
      CASE WHEN least(ATENDIDOS, ATENCIONES, ATENCIONES - ATENDIDOS) < 0 THEN {{'f': 'ATENDIDOS/ATENCIONES',
        'v': concat(ATENDIDOS, '/', ATENCIONES), 'm': 'Valores negativos o atenciones menor que atendidos'}} END
    ] IF finding IS NOT NULL]) AS x
  FROM staged LEFT JOIN {AGE_BOUNDS_SQL} ON unit = TIPO_EDAD LEFT JOIN known ON known."CodigoUnico" = CODIGO_UNICO),
rejects AS (SELECT StgId, x.f AS "Campo", x.v AS "ValorOriginal", x.m AS "Motivo" FROM judged)
"""


@query(
    "reject_log",
    f"""{_REJECTS_SQL} SELECT 'sp_CargarAtenciones' AS "Proceso", StgId AS "StgId", "Campo", "ValorOriginal",
    "Motivo" FROM rejects""",
)
def reject_log(spark: SparkSession, sf: str) -> DataFrame:
    return att.validate(staged(spark, sf), facilities(spark, sf))


@query(
    "reject_count",
    f"""{_REJECTS_SQL} SELECT "Campo", "Motivo", count(*) AS "Violaciones" FROM rejects GROUP BY ALL""",
)
def reject_count(spark: SparkSession, sf: str) -> DataFrame:
    return reject_counts(att.validate(staged(spark, sf), facilities(spark, sf)))


@query("orphans", "SELECT doc_id, lang, source FROM documents ANTI JOIN labels USING (doc_id)")
def documents_without_label(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return orphans(docs, table(spark, sf, "labels"), ["doc_id"])


# Lookups of the staged orders; one ethnicity was never loaded, so its rows drop silently.
_KNOWN_SQL = """
ups AS (SELECT n_name AS nombre, row_number() OVER (ORDER BY n_name) AS id FROM nation),
etnia AS (SELECT nombre, row_number() OVER (ORDER BY nombre) AS id
          FROM (SELECT DISTINCT c_mktsegment AS nombre FROM customer WHERE c_mktsegment <> 'MACHINERY')),
seguro AS (SELECT nombre, row_number() OVER (ORDER BY nombre) AS id
           FROM (SELECT DISTINCT o_orderstatus AS nombre FROM orders))"""
_BATCH_SQL = f"""
WITH staged AS ({STAGED_SQL}), known AS ({FACILITIES_SQL}), {_KNOWN_SQL},
batch AS (
  SELECT make_date(ANIO, MES, DIA) AS "Fecha", CODIGO_UNICO AS "CodigoUnico", CAST(ups.id AS INT) AS "UpsId",
    CAST(etnia.id AS INT) AS "EtniaId", CAST(seguro.id AS INT) AS "TipoSeguroId", SEXO AS "Sexo",
    EDAD_REG AS "EdadReg", TIPO_EDAD AS "TipoEdad", ATENDIDOS AS "Atendidos", ATENCIONES AS "Atenciones",
    CAST(strptime(FECHA_CORTE, '%Y%m%d') AS DATE) AS "FechaCorte", ANIO AS "Anio", MES AS "Mes"
  FROM staged JOIN known ON "CodigoUnico" = CODIGO_UNICO JOIN ups ON ups.nombre = UPS
  JOIN etnia ON etnia.nombre = ETNIA JOIN seguro ON seguro.nombre = TIPO_SEGURO
  WHERE {VALID_SQL}),
loaded AS (SELECT * FROM batch WHERE "Fecha" < DATE '1998-01-01'),
fresh AS (SELECT * FROM batch WHERE NOT EXISTS (SELECT 1 FROM loaded l
  WHERE (l."CodigoUnico", l."Fecha", l."UpsId", l."EtniaId", l."TipoSeguroId", l."Sexo", l."EdadReg", l."TipoEdad")
      = (batch."CodigoUnico", batch."Fecha", batch."UpsId", batch."EtniaId", batch."TipoSeguroId", batch."Sexo",
         batch."EdadReg", batch."TipoEdad")))"""


def _known_lookups(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    sources = {
        "Ups": table(spark, sf, "nation").select(F.col("n_name").alias("Nombre")),
        "Etnia": customers.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("Nombre")),
        "TipoSeguro": orders.select(F.col("o_orderstatus").alias("Nombre")),
    }
    ids = {k.table: k.id for k in att.SERVICES}
    return {
        name: dense_ids(df.distinct(), ["Nombre"], ids[name])[0].withColumn(ids[name], F.col(ids[name]).cast("int"))
        for name, df in sources.items()
    }


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = att.resolve_attentions(staged(spark, sf), facilities(spark, sf), _known_lookups(spark, sf))
    return materialize(rows, "batch")


@query("fact_load_first", f"{_BATCH_SQL} SELECT * FROM fresh")
def fact_load_first(spark: SparkSession, sf: str) -> DataFrame:
    """A load onto a fact that already holds everything before 1998."""
    batch = _batch(spark, sf)
    return att.new_attentions(batch, batch.filter("Fecha < DATE'1998-01-01'"))


@query(
    "fact_load_second",
    f"{_BATCH_SQL} SELECT (SELECT count(*) FROM fresh) AS first_run, CAST(0 AS BIGINT) AS second_run",
)
def fact_load_second(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch loaded twice: the second run inserts nothing."""
    batch = _batch(spark, sf)
    before = batch.filter("Fecha < DATE'1998-01-01'")
    first = materialize(att.new_attentions(batch, before), "fact")
    second = att.new_attentions(batch, before.unionByName(first))
    return first.agg(F.count("*").alias("first_run")).crossJoin(second.agg(F.count("*").alias("second_run")))


@query(
    "silent_drop",
    f"""{_REJECTS_SQL}, {_BATCH_SQL.split("known AS (" + FACILITIES_SQL + "),")[1]}
SELECT (SELECT count(*) FROM staged) AS staged,
       (SELECT count(DISTINCT StgId) FROM rejects) AS rejected_rows, (SELECT count(*) FROM rejects) AS violations,
       (SELECT count(*) FROM staged) - (SELECT count(DISTINCT StgId) FROM rejects)
         - (SELECT count(*) FROM batch) AS silently_dropped,
       (SELECT count(*) FROM batch) - (SELECT count(*) FROM fresh) AS already_present,
       (SELECT count(*) FROM fresh) AS inserted""",
)
def silent_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Where every staged row goes."""
    rows, known, lookups = staged(spark, sf), facilities(spark, sf), _known_lookups(spark, sf)
    loaded = att.resolve_attentions(rows, known, lookups).filter("Fecha < DATE'1998-01-01'")
    loaded = materialize(loaded, "loaded")
    return att.account_for(rows, known, lookups, loaded)


_REIMB = {
    "Periodo": "o_orderdate",
    "Region": "concat(' ', n_name, '  ')",
    "Sede": "concat(c_mktsegment, ' ')",
    "TipoDeAtencion": "o_orderpriority",
    "MedioDeSolicitud": "o_orderstatus",
    "Solicitante": "case when c_acctbal < 0 then 'Tercero' else 'Asegurado' end",
    "CondicionDelAsegurado": "case when c_acctbal < 1000 then 'TITULAR' else 'DERECHOHABIENTE' end",
    "Parentesco": "c_mktsegment",
    "Situacion": "case o_orderstatus when 'F' then 'RETIRO' else 'NO APLICA' end",
    "NumeroDeAsegurados": "concat(' ', cast(floor(o_totalprice / 1000) as varchar(9)), ' ')",
    "SolicitudesDeReembolso": "cast(floor(o_totalprice / 2000) as varchar(9))",
}
_REIMB_FROM = """FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""
_REIMB_NAMES = [c for c in reimb.NAMES if c != "Sede"]


def _names_sql() -> str:
    parts = []
    for c in _REIMB_NAMES:
        parts.append(
            f"t_{c} AS (SELECT n, row_number() OVER (ORDER BY n) AS id FROM "
            f"(SELECT DISTINCT trim({c}, ' ') AS n FROM kept))"
        )
    parts.append(
        "t_Sede AS (SELECT region, n, row_number() OVER (ORDER BY region, n) AS id FROM (SELECT DISTINCT r.id AS region, "
        "trim(k.Sede, ' ') AS n FROM kept k JOIN t_Region r ON r.n = trim(k.Region, ' ')))"
    )
    return ",\n".join(parts)


@query(
    "reimb_load",
    f"""
WITH kept AS (SELECT {", ".join(f"{e} AS {n}" for n, e in _REIMB.items())}, o_totalprice {_REIMB_FROM}
              WHERE o_orderstatus <> 'P'),
{_names_sql()}
SELECT CAST(Periodo AS DATE) AS "Periodo", CAST(s.id AS INT) AS "SedeId",
       CAST(t1.id AS INT) AS "TipoAtencionId", CAST(t2.id AS INT) AS "MedioSolicitudId",
       CAST(t3.id AS INT) AS "TipoSolicitanteId", CAST(t4.id AS INT) AS "CondicionAseguradoId",
       CAST(t5.id AS INT) AS "ParentescoId", CAST(t6.id AS INT) AS "SituacionAseguradoId",
       CAST(floor(o_totalprice / 1000) AS INT) AS "NumeroAsegurados",
       CAST(floor(o_totalprice / 2000) AS INT) AS "SolicitudesReembolso",
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS "MontoPagado"
FROM kept k JOIN t_Region r ON r.n = trim(k.Region, ' ')
JOIN t_Sede s ON s.region = r.id AND s.n = trim(k.Sede, ' ')
JOIN t_TipoDeAtencion t1 ON t1.n = k.TipoDeAtencion JOIN t_MedioDeSolicitud t2 ON t2.n = k.MedioDeSolicitud
JOIN t_Solicitante t3 ON t3.n = k.Solicitante JOIN t_CondicionDelAsegurado t4 ON t4.n = k.CondicionDelAsegurado
JOIN t_Parentesco t5 ON t5.n = k.Parentesco JOIN t_Situacion t6 ON t6.n = k.Situacion
""",
)
def reimb_load(spark: SparkSession, sf: str) -> DataFrame:
    """All-text staging (blank periods, padding, written money) to typed facts."""
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    period = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    written = F.concat(F.lit("S/ "), F.format_number(F.col("o_totalprice").cast("decimal(12,2)"), 2))
    text = joined.select(
        period.alias("Periodo"),
        *[F.expr(e).alias(n) for n, e in _REIMB.items() if n != "Periodo"],
        written.alias("MontoPagado"),
    )
    rows = materialize(reimb.trim_names(reimb.drop_blank(text)), "reimbursements")
    nothing = {k.table: empty_frame(spark, k.schema) for k in reimb.CATALOGUES}
    names = rows.select(*reimb.NAMES).distinct()
    _, catalogues = load_lookups(materialize(names, "names"), reimb.CATALOGUES, nothing)
    facts = reimb.resolve_reimbursements(rows, catalogues)
    return facts.drop("Anio", "Mes").withColumn("MontoPagado", F.col("MontoPagado").cast("double"))


@query(
    "constraint_report",
    """
SELECT 'customer' AS tabla, 'balance >= 0' AS regla, count(*) FILTER (c_acctbal < 0) AS violaciones FROM customer
UNION ALL SELECT 'customer', 'NOT NULL c_name', count(*) FILTER (c_name IS NULL) FROM customer
UNION ALL SELECT 'customer', 'WIDTH c_mktsegment <= 8', count(*) FILTER (length(c_mktsegment) > 8) FROM customer
UNION ALL SELECT 'orders', 'TYPE o_orderkey smallint', count(*) FILTER (TRY_CAST(o_orderkey AS SMALLINT) IS NULL) FROM orders
UNION ALL SELECT 'lineitem', 'UNIQUE l_orderkey, l_linenumber',
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'documents', 'FOREIGN KEY doc_id', (SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id))
UNION ALL SELECT 'lineitem', 'FOREIGN KEY l_orderkey',
  (SELECT count(*) FROM lineitem ANTI JOIN (SELECT o_orderkey AS l_orderkey FROM orders) USING (l_orderkey))
""",
)
def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: table(spark, sf, n) for n in ("customer", "orders", "lineitem", "documents", "labels")}
    customers = row_checks(
        t["customer"],
        "customer",
        {
            "balance >= 0": F.col("c_acctbal") >= 0,
            **not_null(["c_name"]),
            **max_width({"c_mktsegment": 8}),
        },
    )
    parts = [
        row_checks(t["orders"], "orders", castable({"o_orderkey": "smallint"})),
        unique_check(t["lineitem"], "lineitem", ["l_orderkey", "l_linenumber"]),
        foreign_key_check(t["documents"], "documents", ["doc_id"], t["labels"]),
        foreign_key_check(
            t["lineitem"], "lineitem", ["l_orderkey"], t["orders"].select(F.col("o_orderkey").alias("l_orderkey"))
        ),
    ]
    out = customers
    for part in parts:
        out = out.unionByName(part)
    return out


@query(
    "closed_period",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "Fecha" FROM orders
WHERE (year(o_orderdate), month(o_orderdate)) IN ((1996, 1), (1996, 2), (1999, 12))
""",
)
def closed_period(spark: SparkSession, sf: str) -> DataFrame:
    closed = literal_rows(
        spark, [(1996, 1, None), (1996, 2, None), (1999, 12, None)], schemas.CLOSED_PERIODS
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("Fecha"))
    return rows_in_closed_periods(orders, closed, "Fecha")


_OLD_SQL = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "Fecha", o_totalprice AS "Monto" FROM orders
  WHERE o_orderstatus <> 'P'"""
_NEW_SQL = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "Fecha",
  CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS "Monto" FROM orders
  WHERE o_orderpriority <> '5-LOW'"""


def _old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").withColumn("Fecha", F.col("o_orderdate").cast("date"))
    price = F.col("o_totalprice")
    old = orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "Fecha", price.alias("Monto"))
    doubled = F.when(F.col("o_orderstatus") == "O", price * 2).otherwise(price)
    new = orders.filter("o_orderpriority <> '5-LOW'").select("o_orderkey", "Fecha", doubled.alias("Monto"))
    return old, new


@query(
    "audit_diff",
    f"""
WITH a AS ({_OLD_SQL}), b AS ({_NEW_SQL})
SELECT CASE WHEN a.o_orderkey IS NULL THEN 'I' WHEN b.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS "Operacion",
       coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(b."Fecha", a."Fecha") AS "Fecha",
       a."Monto" AS "Monto_Anterior", b."Monto" AS "Monto_Nuevo"
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
""",
)
def audit_diff(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return change_log(old, new, "o_orderkey", ["Fecha"], ["Monto"])


@query("audit_replay", _NEW_SQL)
def audit_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The old state plus its change log is the new state."""
    old, new = _old_and_new(spark, sf)
    log = change_log(old, new, "o_orderkey", ["Fecha"], ["Monto"], only_changed=True)
    return replay(old, log, "o_orderkey", ["Fecha"], ["Monto"])


@query(
    "backfill_column",
    """
SELECT n_nationkey, n_name, (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AS "RegionId" FROM nation
""",
)
def backfill_column(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    asia = table(spark, sf, "region").filter("r_name = 'ASIA'")
    return with_backfilled_column(nations, "RegionId", asia, "r_regionkey")


@query(
    "unreadable_numbers",
    """
SELECT event_type, count(*) AS n_rows,
       count(*) FILTER (TRY_CAST(props[7:-2] AS DOUBLE) IS NULL) AS unreadable
FROM events GROUP BY event_type
""",
)
def unreadable_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional counts of text that is not a number."""
    text = F.expr("substring(props, 7, length(props) - 7)")
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.count_if(parse_number(text).isNull()).alias("unreadable")
    )


# Whole loads into a warehouse of their own, from staged orders.


def _flat_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Flat records of the orders whose rules hold, one facility per customer, no equal grains."""
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    columns = {
        "ANIO": "cast(year(o_orderdate) as int)", "MES": "cast(month(o_orderdate) as int)",
        "DIA": "cast(day(o_orderdate) as int)", "CATEGORIA": "'I-1'", "RED": "'R'", "MICRORED": "n_name",
        "CODIGO_UNICO": "cast(o_custkey as int)", "NOMBRE_ESTACLECIMIENTO": "c_name", "PROVINCIA": "'P'",
        "DISTRITO": "n_name", "EDAD_REG": "cast(o_orderkey % 90 as int)", "TIPO_EDAD": "'A'", "SEXO": "'F'",
        "ETNIA": "c_mktsegment", "TIPO_SEGURO": "o_orderpriority", "UPS": "n_name",
        "ATENDIDOS": "1", "ATENCIONES": "cast(floor(o_totalprice / 1000) + 1 as int)", "FECHA_CORTE": "'20231220'",
    }
    return joined.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def _loaded(spark: SparkSession, sf: str) -> tuple[Warehouse, DataFrame]:
    warehouse = Warehouse(spark, scratch_path(spark, "loads"))
    att.stage(warehouse, _flat_orders(spark, sf))
    staged_rows = warehouse.table(att.STAGING_TABLE, att.staging_schema())
    att.load_dimensions(warehouse, staged_rows)
    att.load_attentions(warehouse, staged_rows)
    return warehouse, staged_rows


@query(
    "load_audit",
    """
SELECT 'I' AS "Operacion", CAST(o_custkey AS INT) AS "CodigoUnico", CAST(o_orderdate AS DATE) AS "Fecha",
  CAST(NULL AS INT) AS "Atenciones_Anterior", CAST(floor(o_totalprice / 1000) + 1 AS INT) AS "Atenciones_Nuevo"
FROM orders
""",
)
def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The change log that a load publishes with its facts."""
    warehouse, _ = _loaded(spark, sf)
    return warehouse.table(att.AUDIT_TABLE, schemas.ATTENTION_AUDIT).select(
        "Operacion", "CodigoUnico", "Fecha", "Atenciones_Anterior", "Atenciones_Nuevo"
    )


@query(
    "closed_period_rerun",
    """SELECT count(*) AS facts, CAST(0 AS BIGINT) AS second_run, true AS open_rows_stop FROM orders""",
)
def closed_period_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """After every month is closed, a loaded batch runs again; a new row stops its batch."""
    warehouse, rows = _loaded(spark, sf)
    facts = warehouse.table(att.FACT_TABLE, schemas.ATTENTION_FACT)
    months = facts.select("Anio", "Mes", F.lit(None).cast("date").alias("FechaCierre")).distinct()
    warehouse.publish(append={att.CLOSED_TABLE: months})
    again = att.load_attentions(warehouse, rows).inserted
    stopped = False
    try:
        att.load_attentions(warehouse, rows.withColumn("EDAD_REG", F.col("EDAD_REG") + 1))
    except QualityError:
        stopped = True
    return warehouse.table(att.FACT_TABLE, schemas.ATTENTION_FACT).agg(F.count("*").alias("facts")).select(
        "facts", F.lit(again).cast("bigint").alias("second_run"), F.lit(stopped).alias("open_rows_stop")
    )


@query(
    "log_latest",
    """
SELECT 1 AS "LogId", 'sp_CargarDimensiones' AS "Proceso", 'OK' AS "Estado",
       count(DISTINCT o_custkey) AS "FilasInsertadas" FROM orders
UNION ALL SELECT 2, 'sp_CargarAtenciones', 'OK', count(*) FROM orders
""",
)
def log_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest runs by id, and how many facilities and facts each inserted."""
    warehouse, _ = _loaded(spark, sf)
    log = latest(warehouse.table(RUN_TABLE, schemas.RUN_LOG))
    return log.select(F.col("LogId").cast("int").alias("LogId"), "Proceso", "Estado", "FilasInsertadas")


# Changes of published facts: in 1996 some counts grow and some dates move, in 1997 some rows go.
_MERGED_SQL = """
facts AS (
  SELECT CAST(o_custkey AS INT) AS "CodigoUnico", CAST(o_orderdate AS DATE) AS old_day, CAST(o_orderkey % 90 AS INT) AS age,
    CAST(floor(o_totalprice / 1000) + 1 AS INT) AS n FROM orders),
merged AS (
  SELECT *, CASE WHEN year(old_day) = 1996 AND age % 9 IN (3, 4) THEN 'U'
                 WHEN year(old_day) = 1997 AND age % 9 = 5 THEN 'D' END AS op,
    CASE WHEN year(old_day) = 1996 AND age % 9 = 4 THEN CAST(old_day + 40 AS DATE) ELSE old_day END AS day,
    CASE WHEN year(old_day) = 1996 AND age % 9 = 3 THEN n + 10 ELSE n END AS new_n FROM facts)"""


def _merged(spark: SparkSession, sf: str) -> Warehouse:
    warehouse, _ = _loaded(spark, sf)
    facts = warehouse.table(att.FACT_TABLE, schemas.ATTENTION_FACT)
    share = F.col("EdadReg") % 9
    updates = facts.filter((F.col("Anio") == 1996) & share.isin(3, 4)).select(
        "AtencionId", F.lit("U").alias("Operacion"), F.when(share == 3, F.col("Atenciones") + 10).alias("Atenciones"),
        F.when(share == 4, F.date_add("Fecha", 40)).alias("Fecha"),
    )
    deletions = facts.filter((F.col("Anio") == 1997) & (share == 5)).select("AtencionId", F.lit("D").alias("Operacion"))
    changes = updates.unionByName(deletions, allowMissingColumns=True)
    change_facts(warehouse, attention_model(), changes, between=("1996-01-01", "1997-12-31"))
    return warehouse


@query(
    "fact_merge",
    f"""WITH {_MERGED_SQL}
SELECT "CodigoUnico", day AS "Fecha", age AS "EdadReg", new_n AS "Atenciones", CAST(year(day) AS INT) AS "Anio",
       CAST(month(day) AS INT) AS "Mes"
FROM merged WHERE op IS NULL OR op = 'U'""",
)
def fact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Updates and deletions of published facts by key; only the touched months are written again."""
    facts = _merged(spark, sf).table(att.FACT_TABLE, schemas.ATTENTION_FACT)
    return facts.select("CodigoUnico", "Fecha", "EdadReg", "Atenciones", "Anio", "Mes")


@query(
    "merge_audit",
    f"""WITH {_MERGED_SQL}
SELECT 'I' AS "Operacion", "CodigoUnico", old_day AS "Fecha", CAST(NULL AS INT) AS "Atenciones_Anterior",
       n AS "Atenciones_Nuevo" FROM facts
UNION ALL SELECT op, "CodigoUnico", day, n, CASE op WHEN 'U' THEN new_n END FROM merged WHERE op IS NOT NULL""",
)
def merge_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The change log of a load and of the changes after it, published with them."""
    return _merged(spark, sf).table(att.AUDIT_TABLE, schemas.ATTENTION_AUDIT).select(
        "Operacion", "CodigoUnico", "Fecha", "Atenciones_Anterior", "Atenciones_Nuevo"
    )


@query(
    "province_region",
    """
SELECT DISTINCT n_name AS "Provincia", CASE WHEN n_nationkey < 12 THEN 'ASIA' ELSE 'EUROPE' END AS "Region"
FROM customer JOIN nation ON n_nationkey = c_nationkey
""",
)
def province_region(spark: SparkSession, sf: str) -> DataFrame:
    """Provinces loaded before the table had a region, and after; none of them is rewritten."""
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    flat_rows = customers.select(
        *[F.lit(None if f.name in ("ANIO", "MES", "DIA") else "1").cast(f.dataType).alias(f.name)
          for f in schemas.ATTENTIONS.fields if f.name not in ("PROVINCIA", "DISTRITO", "CODIGO_UNICO")],
        F.col("n_name").alias("PROVINCIA"), F.col("n_name").alias("DISTRITO"),
        F.col("c_nationkey").cast("int").alias("CODIGO_UNICO"),
    )
    warehouse = Warehouse(spark, scratch_path(spark, "regions"))
    regions = table(spark, sf, "region").select((F.col("r_regionkey") + 1).cast("int").alias("RegionId"), F.col("r_name").alias("Nombre"))
    warehouse.publish(append={att.REGION_TABLE: regions})
    att.load_dimensions(warehouse, flat_rows.filter("CODIGO_UNICO < 12"))
    att.add_region_to_provinces(warehouse, "ASIA")
    att.load_dimensions(warehouse, flat_rows, region="EUROPE")
    named = warehouse.table(att.REGION_TABLE, att.REGION_SCHEMA).withColumnRenamed("Nombre", "Region")
    return att.provinces(warehouse).join(named, "RegionId").select(F.col("Nombre").alias("Provincia"), "Region")


def _flat_reimbursements(spark: SparkSession, sf: str) -> DataFrame:
    """All-text reimbursements, a row per order; some periods blank, some amounts unreadable."""
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    period = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    written = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("S/ x"), F.col("o_orderkey"))).otherwise(
        F.concat(F.lit("S/ "), F.format_number(F.col("o_totalprice").cast("decimal(12,2)"), 2))
    )
    return joined.select(
        period.alias("Periodo"),
        *[F.expr(e).alias(n) for n, e in _REIMB.items() if n != "Periodo"],
        written.alias("MontoPagado"),
    )


def _reimbursed(spark: SparkSession, sf: str) -> tuple[Warehouse, list]:
    """A warehouse after two runs over the same staging table, and what each returned."""
    warehouse = Warehouse(spark, scratch_path(spark, "reimb"))
    reimb.stage(warehouse, _flat_reimbursements(spark, sf))
    runs = [
        reimb.load_reimbursements(
            warehouse, warehouse.table(reimb.STAGING_TABLE, reimb.staging_schema()), on_bad_value="reject"
        )
        for _ in range(2)
    ]
    return warehouse, runs


@query(
    "reimb_rejects",
    """
SELECT 'MontoPagado' AS "Campo", 'S/ x' || o_orderkey AS "ValorOriginal", CAST(2 AS BIGINT) AS n
FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P'
""",
)
def reimb_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable amounts are logged, once in each of two runs."""
    warehouse, _ = _reimbursed(spark, sf)
    log = warehouse.table(att.REJECT_TABLE, schemas.REJECT_LOG)
    return log.groupBy("Campo", "ValorOriginal").agg(F.count("*").alias("n"))


@query(
    "blank_rows_second_run",
    """
SELECT count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW') AS inserted,
  count(*) FILTER (o_orderstatus = 'P' OR o_orderpriority = '5-LOW') AS rejected, CAST(0 AS BIGINT) AS inserted_again,
  count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority = '5-LOW') AS rejected_again,
  count(*) FILTER (o_orderstatus <> 'P') AS staged
FROM orders
""",
)
def blank_rows_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """Blank rows leave the staging table with the first run, so the second counts none."""
    warehouse, (first, second) = _reimbursed(spark, sf)
    staged_rows = warehouse.table(reimb.STAGING_TABLE, reimb.staging_schema())
    return staged_rows.agg(F.count("*").alias("staged")).select(
        F.lit(first.inserted).cast("bigint").alias("inserted"), F.lit(first.rejected).cast("bigint").alias("rejected"),
        F.lit(second.inserted).cast("bigint").alias("inserted_again"),
        F.lit(second.rejected).cast("bigint").alias("rejected_again"), "staged",
    )
