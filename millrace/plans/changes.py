"""Keyed updates and deletions of a published fact, with their change log.

A row trigger of the original logs every insert, update and delete of a fact.  Loads log their inserts;
here rows that are already published are changed by key.  Only the (year, month) partitions that hold a
touched row are written again, and become visible together with the U and D rows of the log.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.operators.bounds import bounded
from millrace.operators.joins import keyed_join, measure
from millrace.operators.quality import QualityError, SEXES, not_null, require, require_open_periods, require_unique
from millrace.plans import attentions, reimbursements
from millrace.plans.run_log import logged_run
from millrace.session import materialize, release
from millrace.sources.warehouse import Warehouse, identities, in_partitions

UPDATE, DELETE = "U", "D"


@dataclass(frozen=True)
class FactModel:
    """A fact partitioned by year and month of ``date``, its log, and what its rows must meet."""

    table: str
    schema: T.StructType
    key: str
    date: str
    audit_table: str
    audit_schema: T.StructType
    logged: tuple[str, ...]
    checks: Mapping[str, Column] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """What an update may set."""
        return [c for c in self.schema.names if c not in (self.key, "Anio", "Mes")]


def attention_model() -> FactModel:
    counts = {f"CHECK {c}": F.col(c) >= 0 for c in ("Atendidos", "Atenciones")}
    return FactModel(
        attentions.FACT_TABLE, schemas.ATTENTION_FACT, "AtencionId", "Fecha", attentions.AUDIT_TABLE,
        schemas.ATTENTION_AUDIT, ("Atendidos", "Atenciones"),
        {"CHECK Sexo": F.col("Sexo").isin(*SEXES), "CHECK EdadReg": F.col("EdadReg") >= -1, **counts},
    )


def reimbursement_model() -> FactModel:
    measures = ("NumeroAsegurados", "SolicitudesReembolso", "MontoPagado")
    return FactModel(
        reimbursements.FACT_TABLE, schemas.REIMBURSEMENT_FACT, "ReembolsoId", "Periodo", reimbursements.AUDIT_TABLE,
        schemas.REIMBURSEMENT_AUDIT, ("MontoPagado",), {f"CHECK {m}": F.col(m) >= 0 for m in measures},
    )


@dataclass(frozen=True)
class ChangeResult:
    updated: int
    deleted: int
    unmatched: int  # changes whose key no row has
    partitions: list[tuple[int, int]]  # written again


def change_facts(
    warehouse: Warehouse, model: FactModel, changes: DataFrame, between: tuple[object, object] | None = None
) -> ChangeResult:
    """Apply ``changes`` (the key, ``Operacion`` 'U' or 'D', and any columns to set) to a published fact.

    An update sets the columns that its row gives; NULL leaves a column as it is, as no column of a
    fact may be NULL.  A key may come once.  A change that matches no row does nothing and is
    counted.  New rows must meet the fact's rules, and neither their old nor their new date may lie in
    a closed period; otherwise nothing changes.  ``between`` bounds the dates of the rows that may
    be touched, so that other partitions are not even searched.

    The fact is searched for the keys (key and partition columns, then the touched rows), the touched
    months are read and written once, and log and fact are published together.  A row whose date moves
    goes to its new month.
    """
    sets = [c for c in model.columns if c in changes.columns]
    with logged_run(warehouse, f"MODIFICACION:{model.table}") as run:
        asked = Observation()
        todo = materialize(
            changes.select(model.key, "Operacion", *[F.col(c).cast(model.schema[c].dataType).alias(c) for c in sets]).observe(
                asked, F.count(F.lit(1)).alias("n"),
                F.count_if(~F.coalesce(F.col("Operacion").isin(UPDATE, DELETE), F.lit(False))).alias("odd"),
                F.count_if(F.col(model.key).isNull()).alias("keyless"),
            ),
            "changes",
        )
        counts = asked.get
        if counts["odd"] or counts["keyless"]:
            raise QualityError(f"{model.table}: changes need a key and one of {UPDATE}, {DELETE}")
        require_unique(todo, model.table, [model.key])

        facts = warehouse.table(model.table, model.schema)
        where = facts if between is None else bounded(facts, model.date, *between)
        given = todo.select(
            model.key, F.col("Operacion").alias("_op"), *[F.col(c).alias(f"_{c}") for c in sets]
        )
        size = measure(given)
        found = Observation()
        touched = materialize(
            keyed_join(where, given, [model.key], right_size=size).observe(
                found, F.count_if(F.col("_op") == UPDATE).alias("u"), F.count_if(F.col("_op") == DELETE).alias("d")
            ),
            "touched",
        )
        hit = found.get
        run.inserted = 0
        if not hit["u"] + hit["d"]:
            release(todo, touched)
            return ChangeResult(0, 0, counts["n"], [])

        after = with_changes(touched, model, sets)
        updated = after.filter(F.col("_op") == UPDATE)
        require(updated, model.table, {**not_null(model.columns), **model.checks})
        dates = touched.select(model.date).unionByName(updated.select(model.date))
        require_open_periods(dates, warehouse.table(attentions.CLOSED_TABLE, schemas.CLOSED_PERIODS), model.date)
        months = touched.select("Anio", "Mes").unionByName(updated.select("Anio", "Mes")).distinct().collect()
        partitions = sorted((r["Anio"], r["Mes"]) for r in months)  # bounded by the calendar
        named = [{"Anio": y, "Mes": m} for y, m in partitions]

        inside = facts.filter(in_partitions(named))
        side = touched.select(model.key, "_op", *[f"_{c}" for c in sets])
        rewritten = with_changes(
            keyed_join(inside, side, [model.key], "left", right_size=measure(side)), model, sets
        ).filter(F.coalesce(F.col("_op") != DELETE, F.lit(True)))
        log = identities(
            change_rows(touched, model, sets), "AuditId", warehouse.highest_id(model.audit_table)
        )
        warehouse.publish(
            amend={model.table: (rewritten.select(*model.schema.names).hint("rebalance", "Anio", "Mes"), named)},
            append={model.audit_table: log},
            partition_by={model.table: ["Anio", "Mes"]},
            ids={model.table: model.key, model.audit_table: "AuditId"},
        )
        release(todo, touched)
        return ChangeResult(hit["u"], hit["d"], counts["n"] - hit["u"] - hit["d"], partitions)


def with_changes(rows: DataFrame, model: FactModel, sets: list[str]) -> DataFrame:
    """``rows`` as they are after the changes beside them (``_op`` and a ``_column`` for each one set)."""
    new = {c: F.when(F.col("_op") == UPDATE, F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in sets}
    changed = rows.withColumns(new)
    if model.date in sets:
        changed = changed.withColumns({"Anio": F.year(model.date), "Mes": F.month(model.date)})
    return changed


def change_rows(touched: DataFrame, model: FactModel, sets: list[str]) -> DataFrame:
    """The change log of touched rows: what a row trigger writes for an update or a deletion.

    Old and new values stand side by side already, so nothing is joined.
    """
    before = touched.withColumns({f"{v}_Anterior": F.col(v) for v in model.logged})
    after = with_changes(before, model, sets)
    named = {
        **{f"{v}_Nuevo": F.when(F.col("_op") == UPDATE, F.col(v)) for v in model.logged},
        "Operacion": F.col("_op"), "UsuarioBD": F.current_user(),
        "FechaHora": F.date_trunc("second", F.current_timestamp()),
    }
    return after.select(
        *[
            named.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in model.audit_schema.fields
            if f.name != "AuditId"
        ]
    )
