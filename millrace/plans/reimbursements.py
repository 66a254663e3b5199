"""Loading staged reimbursements (all text) into typed facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions.dates import parse_day_first
from millrace.functions.numbers import parse_int, parse_money
from millrace.functions.text import trim_spaces
from millrace.operators.aggregates import suppress_small_cells
from millrace.operators.audit import change_log
from millrace.operators.joins import keyed_join, not_yet_in
from millrace.operators.quality import (
    foreign_key_check,
    max_width,
    not_null,
    reconcile,
    require,
    row_checks,
    unique_check,
)
from millrace.plans.attentions import REJECT_TABLE, inserted_log, same_periods
from millrace.plans.lookups import Lookup, load_lookups, resolve
from millrace.plans.run_log import LoadResult, logged_run
from millrace.session import materialize
from millrace.sources.warehouse import Warehouse, identities

REGION = Lookup("Region", "RegionId", "Region")
SEDE = Lookup("Sede", "SedeId", "Sede", parent=REGION)
TIPO_ATENCION = Lookup("TipoAtencion", "TipoAtencionId", "TipoDeAtencion")
MEDIO = Lookup("MedioSolicitud", "MedioSolicitudId", "MedioDeSolicitud")
SOLICITANTE = Lookup("TipoSolicitante", "TipoSolicitanteId", "Solicitante")
CONDICION = Lookup("CondicionAsegurado", "CondicionAseguradoId", "CondicionDelAsegurado")
PARENTESCO = Lookup("Parentesco", "ParentescoId", "Parentesco")
SITUACION = Lookup("SituacionAsegurado", "SituacionAseguradoId", "Situacion")

CATALOGUES = [REGION, SEDE, TIPO_ATENCION, MEDIO, SOLICITANTE, CONDICION, PARENTESCO, SITUACION]
FACT_TABLE, STAGING_TABLE, AUDIT_TABLE = "Reembolso", "stg_Reembolsos", "LogAuditoriaReembolso"
PROCESS = "reembolsos.sp_CargarReembolsos"  # fixed value: process name in the run log

# Full grain of the fact.
GRAIN = ["Periodo", *[k.id for k in CATALOGUES if k is not REGION]]
NAMES = [k.source for k in CATALOGUES]


def staging_schema() -> T.StructType:
    return T.StructType([T.StructField("StgId", schemas.LONG), *schemas.REIMBURSEMENTS.fields])


def stage(warehouse: Warehouse, flat: DataFrame) -> int:
    """Append flat records to staging, each with its own ``StgId``."""
    after = warehouse.highest_id(STAGING_TABLE)
    rows = identities(flat.select(*schemas.REIMBURSEMENTS.names), "StgId", after)
    return warehouse.publish(append={STAGING_TABLE: rows}, ids={STAGING_TABLE: "StgId"})[STAGING_TABLE]


def drop_blank(staged: DataFrame, column: str = "Periodo") -> DataFrame:
    """Footer rows (blank period) go; a missing period stays and will stop the load."""
    return staged.filter(F.col(column).isNull() | (F.trim(column) != ""))


def trim_names(staged: DataFrame) -> DataFrame:
    return staged.withColumns({c: trim_spaces(c) for c in NAMES})


def resolve_reimbursements(
    staged: DataFrame, catalogues: dict[str, DataFrame], on_bad_value: str = "fail"
) -> DataFrame:
    """Typed facts from trimmed rows: eight lookups resolved, numbers and money parsed."""
    rows = staged
    for lookup in CATALOGUES:
        rows = resolve(rows, lookup, catalogues[lookup.table])
    day = parse_day_first("Periodo")
    money = parse_money("MontoPagado", "fail" if on_bad_value == "fail" else "null")
    return rows.select(
        day.alias("Periodo"),
        *[k.id for k in CATALOGUES if k is not REGION],
        parse_int("NumeroDeAsegurados").alias("NumeroAsegurados"),
        parse_int("SolicitudesDeReembolso").alias("SolicitudesReembolso"),
        money.alias("MontoPagado"),
        F.year(day).alias("Anio"),
        F.month(day).alias("Mes"),
        *[c for c in ("StgId",) if c in staged.columns],
    )


def money_rejects(rows: DataFrame) -> DataFrame:
    """A reject row for each amount that is no amount."""
    bad = F.col("MontoPagado").isNotNull() & parse_money("MontoPagado", "null").isNull()
    return rows.filter(bad).select(
        F.lit(PROCESS).alias("Proceso"),
        (F.col("StgId") if "StgId" in rows.columns else F.lit(None)).cast("bigint").alias("StgId"),
        F.lit("MontoPagado").alias("Campo"),
        F.col("MontoPagado").alias("ValorOriginal"),
        F.lit("Monto no valido").alias("Motivo"),
        F.date_trunc("second", F.current_timestamp()).alias("FechaRegistro"),
    )


def load_reimbursements(warehouse: Warehouse, staged: DataFrame, on_bad_value: str = "fail") -> LoadResult:
    """Drop blank rows, load catalogues, resolve and parse, skip what is loaded, insert.

    Returns rows inserted and rows discarded or rejected.  Blank rows leave the staging table
    first, so a second run counts none.  Catalogues are published before the fact and stay when
    the fact load fails.  ``on_bad_value`` is 'fail' (an unreadable amount stops the load) or
    'reject' (the row is left out, and logged and counted).  The fact, partitioned by year and
    month of its period, and its change log become visible together.
    """
    if on_bad_value not in ("fail", "reject"):
        raise ValueError(f"unknown policy: {on_bad_value}")
    with logged_run(warehouse, PROCESS) as run:
        rows = materialize(drop_blank(staged), "staged")
        run.rejected = staged.agg(
            F.count_if(F.trim("Periodo") == "").alias("n")
        ).first()["n"]
        if run.rejected and warehouse.exists(STAGING_TABLE):
            held = drop_blank(warehouse.table(STAGING_TABLE, staging_schema()))
            warehouse.publish(replace={STAGING_TABLE: materialize(held, "staging")}, ids={STAGING_TABLE: "StgId"})
        rows = trim_names(rows)
        names = materialize(rows.select(*NAMES).distinct(), "names")
        current = warehouse.tables({k.table: k.schema for k in CATALOGUES})
        fresh, _ = load_lookups(names, CATALOGUES, current)
        warehouse.publish(append=fresh)

        catalogues = warehouse.tables({k.table: k.schema for k in CATALOGUES})
        if on_bad_value == "reject":
            rejects = identities(money_rejects(rows), "ErrorId", warehouse.highest_id(REJECT_TABLE))
            run.rejected += warehouse.publish(append={REJECT_TABLE: rejects}, ids={REJECT_TABLE: "ErrorId"})[REJECT_TABLE]
            rows = rows.filter(F.col("MontoPagado").isNull() | parse_money("MontoPagado", "null").isNotNull())
        batch = materialize(resolve_reimbursements(rows, catalogues).drop("StgId"), "batch")
        required = [f for f in schemas.REIMBURSEMENT_FACT.names if f != "ReembolsoId"]
        measures = ("NumeroAsegurados", "SolicitudesReembolso", "MontoPagado")
        require(batch, FACT_TABLE, {**not_null(required), **{f"{m} >= 0": F.col(m) >= 0 for m in measures}})
        existing = warehouse.table(FACT_TABLE, schemas.REIMBURSEMENT_FACT)
        fresh_rows = not_yet_in(batch, same_periods(existing, batch), GRAIN).hint("rebalance", "Anio", "Mes")
        numbered = materialize(identities(fresh_rows, "ReembolsoId", warehouse.highest_id(FACT_TABLE)), "numbered")
        audit = inserted_log(warehouse, AUDIT_TABLE, schemas.REIMBURSEMENT_AUDIT, numbered, ["MontoPagado"])
        counts = warehouse.publish(
            append={FACT_TABLE: numbered.select(*schemas.REIMBURSEMENT_FACT.names), AUDIT_TABLE: audit},
            partition_by={FACT_TABLE: ["Anio", "Mes"]},
            ids={FACT_TABLE: "ReembolsoId", AUDIT_TABLE: "AuditId"},
        )
        run.inserted = counts[FACT_TABLE]
        return LoadResult(run.inserted, run.rejected)


def published_view(
    fact: DataFrame, sedes: DataFrame, regions: DataFrame, types: DataFrame, k: int = 5
) -> DataFrame:
    """Totals by region, office, type and period, only for cells with at least ``k`` insured.

    The fact is summed per id combination before names are joined.
    """
    per_id = fact.groupBy("SedeId", "TipoAtencionId", "Periodo").agg(
        F.sum("NumeroAsegurados").alias("TotalAsegurados"),
        F.sum("SolicitudesReembolso").alias("TotalSolicitudes"),
        F.sum("MontoPagado").alias("TotalMontoPagado"),
    )
    offices = sedes.withColumnRenamed("Nombre", "Sede")
    kinds = types.withColumnRenamed("Nombre", "TipoAtencion")
    places = regions.withColumnRenamed("Nombre", "Region")
    joined = keyed_join(per_id, offices, ["SedeId"], "inner", balance=False)
    joined = keyed_join(joined, places, ["RegionId"], "inner", balance=False)
    joined = keyed_join(joined, kinds, ["TipoAtencionId"], "inner", balance=False)
    totals = ["TotalAsegurados", "TotalSolicitudes", "TotalMontoPagado"]
    return suppress_small_cells(
        joined,
        ["Region", "Sede", "TipoAtencion", "Periodo"],
        {t: t for t in totals},
        people="TotalAsegurados",
        k=k,
    )


def warehouse_view(warehouse: Warehouse, k: int = 5) -> DataFrame:
    """The suppressed view over the published tables."""
    tables = [warehouse.table(t.table, t.schema) for t in (SEDE, REGION, TIPO_ATENCION)]
    return published_view(warehouse.table(FACT_TABLE, schemas.REIMBURSEMENT_FACT), *tables, k=k)


def audit_reimbursements(old: DataFrame, new: DataFrame, user: Column | None = None, at: Column | None = None) -> DataFrame:
    """Change log of the reimbursements fact: old and new amount per touched row."""
    return change_log(old, new, "ReembolsoId", ["Periodo"], ["MontoPagado"], user=user, at=at)


# Text widths of the staging table.
STAGING_WIDTHS = {
    "Periodo": 10, "Region": 50, "Sede": 80, "TipoDeAtencion": 100, "MedioDeSolicitud": 30, "Solicitante": 30,
    "CondicionDelAsegurado": 30, "Parentesco": 30, "Situacion": 40, "NumeroDeAsegurados": 10,
    "SolicitudesDeReembolso": 10, "MontoPagado": 20,
}


def staging_report(staged: DataFrame) -> DataFrame:
    """Staged values that are too wide."""
    return row_checks(staged, STAGING_TABLE, max_width(STAGING_WIDTHS))


def model_report(warehouse: Warehouse) -> DataFrame:
    """Violations of every constraint of the fact and of its catalogues."""
    tables = warehouse.tables(
        {FACT_TABLE: schemas.REIMBURSEMENT_FACT, **{k.table: k.schema for k in CATALOGUES}}
    )
    fact = tables[FACT_TABLE]
    checks = {
        f"CHECK {m}": F.col(m) >= 0 for m in ("NumeroAsegurados", "SolicitudesReembolso", "MontoPagado")
    } | not_null(fact.columns)
    parts = [row_checks(fact, FACT_TABLE, checks), unique_check(fact, FACT_TABLE, ["ReembolsoId"])]
    for k in CATALOGUES:
        rows = tables[k.table]
        parts += [
            row_checks(rows, k.table, not_null(rows.columns)),
            unique_check(rows, k.table, [k.id]),
            unique_check(rows, k.table, k.keys),
        ]
        if k is not REGION:
            parts.append(foreign_key_check(fact, FACT_TABLE, [k.id], rows))
        if k.parent:
            parts.append(foreign_key_check(rows, k.table, [k.parent.id], tables[k.parent.table]))
    return reduce(DataFrame.unionByName, parts)


def statistics_check(warehouse: Warehouse) -> DataFrame:
    """Rows in staging and in the fact, side by side."""
    return reconcile(
        {
            "FilasEnStaging": warehouse.table(STAGING_TABLE, staging_schema()),
            "FilasEnTablaDeHechos": warehouse.table(FACT_TABLE, schemas.REIMBURSEMENT_FACT),
        }
    )
