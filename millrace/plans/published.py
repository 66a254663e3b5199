"""Which datasets each audience is given, and under which view names.

This lists and registers frames; enforcing access is the platform's job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace import schemas
from millrace.plans import attentions, reimbursements
from millrace.plans.run_log import RUN_TABLE
from millrace.sources.warehouse import Warehouse

# Analysts get the attentions fact with its lookups and the suppressed view; never staging,
# logs or detailed reimbursements.  Auditors get the logs, the closed periods and both facts.
_ANALYST = {
    **{k.table: k.schema for k in (*attentions.PLACES, *attentions.SERVICES)},
    attentions.AGE_UNIT_TABLE: schemas.AGE_UNIT,
    attentions.FACILITY_TABLE: schemas.FACILITY,
    attentions.FACT_TABLE: schemas.ATTENTION_FACT,
}
_AUDITOR = {
    attentions.AUDIT_TABLE: schemas.ATTENTION_AUDIT,
    RUN_TABLE: schemas.RUN_LOG,
    attentions.REJECT_TABLE: schemas.REJECT_LOG,
    attentions.CLOSED_TABLE: schemas.CLOSED_PERIODS,
    attentions.FACT_TABLE: schemas.ATTENTION_FACT,
    reimbursements.FACT_TABLE: schemas.REIMBURSEMENT_FACT,
}


def datasets(warehouse: Warehouse, audience: str) -> dict[str, DataFrame]:
    """Frames for 'analyst' or 'auditor' by view name."""
    if audience == "auditor":
        return warehouse.tables(_AUDITOR)
    if audience != "analyst":
        raise ValueError(f"unknown audience: {audience}")
    return {**warehouse.tables(_ANALYST), "vw_ReembolsosAgregado": reimbursements.warehouse_view(warehouse)}


def register(warehouse: Warehouse, audience: str) -> list[str]:
    """Register the audience's frames as temporary views; returns their names."""
    frames = datasets(warehouse, audience)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)
