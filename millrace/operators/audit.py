"""Change logs between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_log(
    old: DataFrame,
    new: DataFrame,
    key: str,
    carry: Sequence[str],
    values: Sequence[str],
    only_changed: bool = False,
    user: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """I / U / D rows with the old and new ``values``, from one full outer join on a unique key.

    ``old`` holds the touched rows before the change, ``new`` after it.  A row in both is a
    'U' even when no value changed, as a row trigger reports it; ``only_changed`` drops
    those, for comparing whole snapshots.  Used for reimbursements (amount) and, by analogy,
    for attentions (two counts).
    """
    before = old.select(
        key, F.struct(*carry, *values).alias("_o")
    )
    after = new.select(
        F.col(key).alias("_key"), F.struct(*carry, *values).alias("_n")
    )
    both = before.join(after, F.col(key) == F.col("_key"), "full_outer")
    operation = (
        F.when(F.col("_o").isNull(), "I").when(F.col("_n").isNull(), "D").otherwise("U")
    )
    log = both.select(
        operation.alias("Operacion"),
        F.coalesce(key, "_key").alias(key),
        *[
            F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c)
            for c in carry
        ],
        *[
            c
            for v in values
            for c in (F.col(f"_o.{v}").alias(f"{v}_Anterior"), F.col(f"_n.{v}").alias(f"{v}_Nuevo"))
        ],
    )
    if only_changed:
        same = F.lit(True)
        for v in values:
            same = same & F.col(f"{v}_Anterior").eqNullSafe(F.col(f"{v}_Nuevo"))
        log = log.filter(~((F.col("Operacion") == "U") & same))
    if user is not None:
        log = log.withColumn("UsuarioBD", user)
    if at is not None:
        log = log.withColumn("FechaHora", F.date_trunc("second", at))
    return log


def replay(old: DataFrame, log: DataFrame, key: str, carry: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Apply a change log (at most one row per key) to the old state."""
    changes = log.select(
        F.col(key).alias("_key"),
        "Operacion",
        F.struct(
            *carry, *[F.col(f"{v}_Nuevo").alias(v) for v in values]
        ).alias("_n"),
    )
    both = old.select(key, F.struct(*carry, *values).alias("_o")).join(
        changes, F.col(key) == F.col("_key"), "full_outer"
    )
    kept = both.filter(F.col("Operacion").isNull() | (F.col("Operacion") != "D"))
    return kept.select(
        F.coalesce(key, "_key").alias(key),
        *[
            F.when(F.col("Operacion").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c)
            for c in (*carry, *values)
        ],
    )
