"""Loading staged attentions into the normalised model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions.dates import date_from_parts, parse_compact
from millrace.operators.audit import change_log
from millrace.operators.joins import not_yet_in
from millrace.operators.keys import first_per_key
from millrace.operators.quality import (
    SEXES,
    QualityError,
    attention_rules,
    broken_rules,
    castable,
    foreign_key_check,
    max_width,
    not_null,
    reconcile,
    reject_log,
    require,
    require_open_periods,
    require_unique,
    row_checks,
    unique_check,
    valid_age,
    valid_counts,
    with_membership,
)
from millrace.plans.lookups import Lookup, load_lookups, resolve
from millrace.plans.run_log import PARTIAL, LoadResult, Run, log_run, logged_run
from millrace.session import in_parallel, materialize, store_counted
from millrace.sources.readers import literal_rows
from millrace.sources.warehouse import Warehouse, identities, in_partitions
from millrace.sources.writers import with_backfilled_column

RED = Lookup("Red", "RedId", "RED")
MICRORED = Lookup("Microred", "MicroredId", "MICRORED", parent=RED)
PROVINCIA = Lookup("Provincia", "ProvinciaId", "PROVINCIA")
DISTRITO = Lookup("Distrito", "DistritoId", "DISTRITO", parent=PROVINCIA)
CATEGORIA = Lookup("CategoriaEstablecimiento", "CategoriaId", "CATEGORIA", name="Codigo")
ETNIA = Lookup("Etnia", "EtniaId", "ETNIA")
TIPO_SEGURO = Lookup("TipoSeguro", "TipoSeguroId", "TIPO_SEGURO")
UPS = Lookup("Ups", "UpsId", "UPS")

PLACES = [RED, PROVINCIA, CATEGORIA, MICRORED, DISTRITO]
SERVICES = [ETNIA, TIPO_SEGURO, UPS]

# Columns of the flat file that describe a facility.
FACILITY_SOURCE = [
    "CODIGO_UNICO",
    "NOMBRE_ESTACLECIMIENTO",
    "CATEGORIA",
    "RED",
    "MICRORED",
    "PROVINCIA",
    "DISTRITO",
]
REGION_TABLE, REGION_SCHEMA = "Region", schemas.record(RegionId=schemas.INT, Nombre=schemas.TEXT)
FACILITY_TABLE, FACT_TABLE, REJECT_TABLE = "Establecimiento", "Atencion", "LogErroresValidacion"
AUDIT_TABLE = "LogAuditoriaAtencion"
CLOSED_TABLE, STAGING_TABLE, AGE_UNIT_TABLE = "PeriodoCerrado", "stg_Atenciones", "TipoEdad"

# Process names in the run and reject logs.
LOAD_LOOKUPS, LOAD_FACT = "sp_CargarDimensiones", "sp_CargarAtenciones"

# Full grain of the fact, one row per combination.
GRAIN = [
    "CodigoUnico",
    "Fecha",
    "UpsId",
    "EtniaId",
    "TipoSeguroId",
    "Sexo",
    "EdadReg",
    "TipoEdad",
]
MAX_PERIODS = 4800


def staging_schema() -> T.StructType:
    return T.StructType([T.StructField("StgId", schemas.LONG), *schemas.ATTENTIONS.fields])


def stage(warehouse: Warehouse, flat: DataFrame) -> int:
    """Append flat records to staging, each with its own ``StgId``."""
    after = warehouse.highest_id(STAGING_TABLE)
    rows = identities(flat.select(*schemas.ATTENTIONS.names), "StgId", after)
    return warehouse.publish(append={STAGING_TABLE: rows}, ids={STAGING_TABLE: "StgId"})[STAGING_TABLE]


def new_facilities(
    combinations: DataFrame, lookups: dict[str, DataFrame], existing: DataFrame, on_conflict: str = "fail_block"
) -> DataFrame:
    """Facilities not yet loaded, with their category, network and district resolved.

    One code with two descriptions breaks the key: 'fail_block' raises, 'keep_first' keeps
    the first description in sorted order.
    """
    resolved = combinations
    for lookup in (CATEGORIA, RED, MICRORED, PROVINCIA, DISTRITO):
        resolved = resolve(resolved, lookup, lookups[lookup.table])
    rows = resolved.select(
        F.col("CODIGO_UNICO").alias("CodigoUnico"),
        F.col("NOMBRE_ESTACLECIMIENTO").alias("Nombre"),
        "CategoriaId",
        "MicroredId",
        "DistritoId",
    ).distinct()
    fresh = not_yet_in(rows, existing, ["CodigoUnico"], balance=False)
    if on_conflict == "keep_first":
        values = ["Nombre", "CategoriaId", "MicroredId", "DistritoId"]
        ranked = fresh.select("CodigoUnico", *values, F.struct(*values).alias("_rank"))
        fresh = first_per_key(ranked, ["CodigoUnico"], "_rank", values).drop("_rank")
    else:
        require(fresh, FACILITY_TABLE, not_null(fresh.columns))
        require_unique(fresh, FACILITY_TABLE, ["CodigoUnico"])
    return fresh


def load_dimensions(
    warehouse: Warehouse,
    staged: DataFrame,
    on_conflict: str = "fail_block",
    region: str | None = None,
) -> LoadResult:
    """Load eight lookups and the facilities from staging; return the number of new facilities.

    Staging is scanned twice, once per group of columns, and only distinct combinations go
    further.  Lookups and facilities become visible together.  A conflict among facilities
    (any error there) undoes that block alone and is logged as a partial error; an error among
    the lookups undoes all.  Once provinces have a region, ``region`` names that of new ones; without
    it a new province stops the load.
    """
    with logged_run(warehouse, LOAD_LOOKUPS) as run:
        places, services = in_parallel(
            [
                lambda: materialize(staged.select(*FACILITY_SOURCE).distinct(), "places"),
                lambda: materialize(staged.select(*[k.source for k in SERVICES]).distinct(), "services"),
            ]
        )
        current = warehouse.tables({k.table: k.schema for k in PLACES + SERVICES})
        (fresh, whole), (more, _) = in_parallel(
            [
                lambda: load_lookups(places, PLACES, current),
                lambda: load_lookups(services, SERVICES, current),
            ]
        )
        fresh |= more
        if region is not None and warehouse.added_columns(PROVINCIA.table):
            of = F.lit(region_id(warehouse, region)).cast("int").alias("RegionId")
            fresh[PROVINCIA.table] = fresh[PROVINCIA.table].select("*", of)
        partial = None
        seen = warehouse.version
        try:
            known = warehouse.table(FACILITY_TABLE, schemas.FACILITY)
            facilities = materialize(new_facilities(places, whole, known, on_conflict), "facilities")
            counts = warehouse.publish(append={**fresh, FACILITY_TABLE: facilities})
            run.inserted = counts[FACILITY_TABLE]
        except Exception as conflict:
            if warehouse.version != seen:  # the publication took effect before the error
                raise
            partial = str(conflict)
            warehouse.publish(append=fresh)
            block = Run(f"{LOAD_LOOKUPS}:{FACILITY_TABLE}", run.started)
            log_run(warehouse, block, PARTIAL, partial)
        return LoadResult(run.inserted, 0, partial)


def extend_with_region(provinces: DataFrame, regions: DataFrame, region: str) -> DataFrame:
    """Give every province the id of one named region; none may stay without."""
    named = regions.filter(F.col("Nombre") == region)
    extended = with_backfilled_column(provinces, "RegionId", named, "RegionId")
    require(extended, PROVINCIA.table, not_null(["RegionId"]))
    return extended


def region_id(warehouse: Warehouse, region: str) -> int:
    """The id of a region by its name, which is unique."""
    rows = warehouse.table(REGION_TABLE, REGION_SCHEMA).filter(F.col("Nombre") == region).limit(2).collect()
    if len(rows) != 1:
        raise QualityError(f"{REGION_TABLE}: {len(rows) or 'no'} rows named {region}")
    return rows[0]["RegionId"]


def add_region_to_provinces(warehouse: Warehouse, region: str) -> int:
    """Extend the provinces by ``RegionId``: those loaded so far belong to the named region, and no
    later one may be without.  The region is loaded if it is not there.  No province is rewritten."""
    known = warehouse.table(REGION_TABLE, REGION_SCHEMA)
    if known.filter(F.col("Nombre") == region).isEmpty():
        top = known.agg(F.max("RegionId")).first()[0] or 0
        warehouse.publish(append={REGION_TABLE: literal_rows(warehouse.spark, [(top + 1, region)], REGION_SCHEMA)})
    found = region_id(warehouse, region)
    warehouse.add_column(PROVINCIA.table, "RegionId", schemas.INT, found)
    return found


def provinces(warehouse: Warehouse) -> DataFrame:
    """The provinces with all columns they have by now."""
    return warehouse.table(PROVINCIA.table, warehouse.schema(PROVINCIA.table, PROVINCIA.schema))


def validate(staged: DataFrame, facilities: DataFrame, as_array: bool = False) -> DataFrame:
    """One reject row per broken rule; or each row's broken rules as an array ``v``."""
    keys = facilities.select(F.col("CodigoUnico").alias("CODIGO_UNICO"))
    flagged = with_membership(staged, keys, ["CODIGO_UNICO"])
    if as_array:
        return flagged.select(broken_rules(attention_rules()).alias("v"))
    return reject_log(flagged, attention_rules(), "StgId", LOAD_FACT)


def resolve_attentions(staged: DataFrame, facilities: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Valid rows with lookups resolved.  An impossible date stops the load; a row with an
    unknown member, or with a rule that is unknown, is left out."""
    codes = facilities.select(F.col("CodigoUnico").alias("CODIGO_UNICO"))
    rows = staged.filter(F.col("SEXO").isin(*SEXES) & valid_age() & valid_counts())
    known = with_membership(rows, codes, ["CODIGO_UNICO"])
    return resolve_members(known.filter("_known").drop("_known"), lookups)


def resolve_members(staged: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Rows of known facilities as facts: valid ones, with the ids of their members."""
    rows = staged.filter(F.col("SEXO").isin(*SEXES) & valid_age() & valid_counts())
    for lookup in SERVICES:
        rows = resolve(rows, lookup, lookups[lookup.table])
    day = date_from_parts("ANIO", "MES", "DIA", on_bad_date="fail")
    return rows.select(
        day.alias("Fecha"),
        F.col("CODIGO_UNICO").alias("CodigoUnico"),
        "UpsId",
        "EtniaId",
        "TipoSeguroId",
        F.col("SEXO").alias("Sexo"),
        F.col("EDAD_REG").alias("EdadReg"),
        F.col("TIPO_EDAD").alias("TipoEdad"),
        F.col("ATENDIDOS").alias("Atendidos"),
        F.col("ATENCIONES").alias("Atenciones"),
        parse_compact("FECHA_CORTE").alias("FechaCorte"),
        F.year(day).alias("Anio"),
        F.month(day).alias("Mes"),
    )


def same_periods(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Only the fact's partitions that the batch touches.

    The months of a batch are bounded by the calendar; beyond that bound nothing is pruned.
    """
    months = batch.select("Anio", "Mes").distinct().limit(MAX_PERIODS + 1).collect()
    if not months or len(months) > MAX_PERIODS:
        return existing
    return existing.filter(in_partitions([{"Anio": r["Anio"], "Mes": r["Mes"]} for r in months]))


def new_attentions(batch: DataFrame, existing: DataFrame, dedupe_batch: bool = False) -> DataFrame:
    """Rows whose grain is not in the fact yet.

    Only the fact is consulted, so equal grains within one batch all load, as in the
    original; ``dedupe_batch`` keeps the one with the smallest values.
    """
    fresh = not_yet_in(batch, same_periods(existing, batch), GRAIN)
    if not dedupe_batch:
        return fresh
    rest = [c for c in fresh.columns if c not in GRAIN]
    one = fresh.groupBy(*GRAIN).agg(F.min(F.struct(*rest)).alias("_v"))
    return one.select(*[F.col(c) if c in GRAIN else F.col(f"_v.{c}") for c in fresh.columns])


def load_attentions(
    warehouse: Warehouse, staged: DataFrame, dedupe_batch: bool = False, relog: bool = True
) -> LoadResult:
    """Validate, log the rejects, resolve, skip what is loaded, insert.

    ``relog`` logs the rejects of every run; without it those that are in the log stay out.

    Rejects are published first and stay when the load fails afterwards.  The fact batch,
    partitioned by year and month, and its change log become visible whole or not at all.  Only
    rows that would be inserted may not lie in a closed period: a batch that is loaded already
    runs again without harm.
    """
    with logged_run(warehouse, LOAD_FACT) as run:
        facilities = warehouse.table(FACILITY_TABLE, schemas.FACILITY)
        rejects = validate(staged, facilities).withColumn(
            "FechaRegistro", F.date_trunc("second", F.current_timestamp())
        )
        if not relog:
            logged = warehouse.table(REJECT_TABLE, schemas.REJECT_LOG).filter(F.col("Proceso") == LOAD_FACT)
            rejects = not_yet_in(rejects, logged, ["StgId", "Campo"], balance=False)
        rejects = identities(rejects, "ErrorId", warehouse.highest_id(REJECT_TABLE))
        run.rejected = warehouse.publish(append={REJECT_TABLE: rejects}, ids={REJECT_TABLE: "ErrorId"})[REJECT_TABLE]

        lookups = warehouse.tables({k.table: k.schema for k in SERVICES})
        batch = materialize(resolve_attentions(staged, facilities, lookups), "batch")
        require(batch, FACT_TABLE, not_null([*GRAIN, "Atendidos", "Atenciones", "FechaCorte"]))
        existing = warehouse.table(FACT_TABLE, schemas.ATTENTION_FACT)
        fresh = new_attentions(batch, existing, dedupe_batch)
        # Rows of a month meet in tasks of even size, a large month in several; ids are given
        # after that shuffle, in the tasks that write, so that a retried task repeats none.
        even = fresh.hint("rebalance", "Anio", "Mes")
        numbered = materialize(identities(even, "AtencionId", warehouse.highest_id(FACT_TABLE)), "numbered")
        require_open_periods(numbered, warehouse.table(CLOSED_TABLE, schemas.CLOSED_PERIODS), "Fecha")
        audit = inserted_log(warehouse, AUDIT_TABLE, schemas.ATTENTION_AUDIT, numbered, ["Atendidos", "Atenciones"])
        counts = warehouse.publish(
            append={FACT_TABLE: numbered.select(*schemas.ATTENTION_FACT.names), AUDIT_TABLE: audit},
            partition_by={FACT_TABLE: ["Anio", "Mes"]},
            ids={FACT_TABLE: "AtencionId", AUDIT_TABLE: "AuditId"},
        )
        run.inserted = counts[FACT_TABLE]
        return LoadResult(run.inserted, run.rejected)


def inserted_log(
    warehouse: Warehouse, table: str, schema: T.StructType, rows: DataFrame, values: list[str]
) -> DataFrame:
    """Change log rows of inserted ``rows``: nothing before, ``values`` after."""
    named = {f"{v}_Nuevo": F.col(v) for v in values}
    logged = rows.select(
        *[
            (
                F.lit("I") if f.name == "Operacion"
                else F.current_user() if f.name == "UsuarioBD"
                else F.date_trunc("second", F.current_timestamp()) if f.name == "FechaHora"
                else F.lit(None) if f.name.endswith("_Anterior")
                else named.get(f.name, F.col(f.name))
            ).cast(f.dataType).alias(f.name)
            for f in schema.fields
            if f.name != "AuditId"
        ]
    )
    return identities(logged, "AuditId", warehouse.highest_id(table))


def audit_attentions(old: DataFrame, new: DataFrame, user: Column | None = None, at: Column | None = None) -> DataFrame:
    """Change log of the attentions fact: old and new counts per changed row.

    Its layout is given by the log table; its behaviour follows the reimbursements log.
    """
    return change_log(
        old, new, "AtencionId", ["CodigoUnico", "Fecha"], ["Atendidos", "Atenciones"], user=user, at=at
    )


def seed_age_units(warehouse: Warehouse) -> None:
    """Publish the fixed catalogue of age units, once."""
    if not warehouse.exists(AGE_UNIT_TABLE):
        units = literal_rows(warehouse.spark, schemas.AGE_UNITS, schemas.AGE_UNIT)
        warehouse.publish(append={AGE_UNIT_TABLE: units})


def staging_report(staged: DataFrame) -> DataFrame:
    """Staged values that are too wide, or outside the small integer types of the model."""
    small = {c: "smallint" for c in ("ANIO", "EDAD_REG", "ATENDIDOS", "ATENCIONES")}
    return row_checks(staged, STAGING_TABLE, {**max_width(schemas.ATTENTION_WIDTHS), **castable(small)})


def model_report(warehouse: Warehouse) -> DataFrame:
    """Violations of every constraint of the fact: checks, NOT NULL, primary and foreign keys.

    One scan for all row checks; each foreign key reads its own column, reduced to one row
    per key before it meets the parent.
    """
    parents = {k.table: k for k in SERVICES}
    tables = warehouse.tables(
        {
            FACT_TABLE: schemas.ATTENTION_FACT,
            FACILITY_TABLE: schemas.FACILITY,
            AGE_UNIT_TABLE: schemas.AGE_UNIT,
            **{name: k.schema for name, k in parents.items()},
        }
    )
    fact = tables[FACT_TABLE]
    checks = {
        "CHECK Sexo": F.col("Sexo").isin(*SEXES),
        "CHECK EdadReg": F.col("EdadReg") >= -1,
        "CHECK Atendidos": F.col("Atendidos") >= 0,
        "CHECK Atenciones": F.col("Atenciones") >= 0,
        **not_null(fact.columns),
    }
    parts = [
        row_checks(fact, FACT_TABLE, checks),
        unique_check(fact, FACT_TABLE, ["AtencionId"]),
        foreign_key_check(fact, FACT_TABLE, ["CodigoUnico"], tables[FACILITY_TABLE]),
        foreign_key_check(fact, FACT_TABLE, ["TipoEdad"], tables[AGE_UNIT_TABLE]),
        *[foreign_key_check(fact, FACT_TABLE, [k.id], tables[n]) for n, k in parents.items()],
    ]
    return reduce(DataFrame.unionByName, parts)


def statistics_check(warehouse: Warehouse) -> DataFrame:
    """Rows in staging, in the fact, and facilities, side by side."""
    return reconcile(
        {
            "FilasEnStaging": warehouse.table(STAGING_TABLE, staging_schema()),
            "FilasEnTablaDeHechos": warehouse.table(FACT_TABLE, schemas.ATTENTION_FACT),
            "EstablecimientosTotales": warehouse.table(FACILITY_TABLE, schemas.FACILITY),
        }
    )


def account_for(staged: DataFrame, facilities: DataFrame, lookups: dict[str, DataFrame], existing: DataFrame) -> DataFrame:
    """Where every staged row goes: rejected, silently dropped, already present or inserted.

    Silently dropped are rows that break no rule but have an unknown rule value or an
    unknown lookup member.
    """
    keys = facilities.select(F.col("CodigoUnico").alias("CODIGO_UNICO"))
    flagged = with_membership(staged, keys, ["CODIGO_UNICO"])
    rules = broken_rules(attention_rules())
    judged, seen = store_counted(
        flagged.withColumn("_broken", F.size(rules)), "judged", staged=F.count(F.lit(1)),
        rejected_rows=F.count_if(F.col("_broken") > 0), violations=F.coalesce(F.sum("_broken"), F.lit(0)),
    )
    batch, valid = store_counted(
        resolve_members(judged.filter("_known").drop("_known", "_broken"), lookups), "batch", n=F.count(F.lit(1))
    )
    fresh = not_yet_in(batch, same_periods(existing, batch), GRAIN)
    counts = fresh.agg(F.count("*").alias("inserted")).select(
        *[F.lit(seen[n]).cast("bigint").alias(n) for n in ("staged", "rejected_rows", "violations")],
        F.lit(valid["n"]).cast("bigint").alias("valid"), "inserted",
    )
    return counts.select(
        "staged",
        "rejected_rows",
        "violations",
        (F.col("staged") - F.col("rejected_rows") - F.col("valid")).alias("silently_dropped"),
        (F.col("valid") - F.col("inserted")).alias("already_present"),
        "inserted",
    )
