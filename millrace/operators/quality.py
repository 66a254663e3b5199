"""Data-quality rules.  Every check is a job that returns the rows (or counts) in breach.

SQL's three-valued logic is kept on purpose: a rule whose value is NULL is unknown, so the
row is not reported by that rule, and a load filter with the same rule does not pass it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import concat_blank
from millrace.operators.joins import Size, keyed_join, orphans


class QualityError(ValueError):
    """A batch broke a constraint that stops the load."""


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a row in breach; ``value`` is what the log shows of it."""

    field: str
    broken: Column
    value: Column
    reason: str


# Age units with the inclusive range of ages each one allows.
AGE_RANGES = {"D": (0, 364), "M": (0, 11), "A": (-1, 99)}
SEXES = ("F", "M")


def valid_age(unit: str = "TIPO_EDAD", age: str = "EDAD_REG") -> Column:
    """The age lies in the range of its unit."""
    cases = [
        (F.col(unit) == u) & F.col(age).between(low, high) for u, (low, high) in AGE_RANGES.items()
    ]
    return reduce(lambda a, b: a | b, cases)


def valid_counts(people: str = "ATENDIDOS", events: str = "ATENCIONES") -> Column:
    return (F.col(people) >= 0) & (F.col(events) >= 0) & (F.col(events) >= F.col(people))


def attention_rules(facility_known: str = "_known") -> list[Rule]:
    """The four rules of the attentions load.  Field tags and reasons are fixed values."""
    return [
        Rule("SEXO", ~F.col("SEXO").isin(*SEXES), F.col("SEXO"), "Valor fuera de dominio (F/M)"),
        Rule(
            "EDAD_REG/TIPO_EDAD",
            ~valid_age(),
            concat_blank("EDAD_REG", F.lit("/"), "TIPO_EDAD"),
            "Edad fuera de rango para el tipo de edad",
        ),
        Rule(
            "CODIGO_UNICO",
            F.col(facility_known).isNull(),
            F.col("CODIGO_UNICO").cast("string"),
            "El establecimiento no existe en dbo.Establecimiento",
        ),
        Rule(
            "ATENDIDOS/ATENCIONES",
            (F.col("ATENDIDOS") < 0)
            | (F.col("ATENCIONES") < 0)
            | (F.col("ATENCIONES") < F.col("ATENDIDOS")),
            concat_blank("ATENDIDOS", F.lit("/"), "ATENCIONES"),
            "Valores negativos o atenciones menor que atendidos",
        ),
    ]


def with_membership(
    df: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    flag: str = "_known",
    parent_size: Size | None = None,
) -> DataFrame:
    """Mark the rows whose key exists in ``parent`` (true, else NULL).

    ``parent`` holds each key once, so no row is lost or doubled.
    """
    known = parent.select(*keys).withColumn(flag, F.lit(True))
    return keyed_join(df, known, keys, "left", parent_size, balance=False)


def broken_rules(rules: Sequence[Rule]) -> Column:
    """The rules that a row breaks, as an array of (Campo, ValorOriginal, Motivo)."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    r.broken,
                    F.struct(
                        F.lit(r.field).alias("Campo"),
                        r.value.cast("string").alias("ValorOriginal"),
                        F.lit(r.reason).alias("Motivo"),
                    ),
                )
                for r in rules
            ]
        )
    )


def reject_log(df: DataFrame, rules: Sequence[Rule], id_column: str, process: str) -> DataFrame:
    """One row per broken rule (not per record), in a single scan of ``df``."""
    found = broken_rules(rules)
    return df.select(F.col(id_column).cast("bigint").alias("StgId"), F.explode(found).alias("v")).select(
        F.lit(process).alias("Proceso"), "StgId", "v.Campo", "v.ValorOriginal", "v.Motivo"
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Violations per rule.  Their sum is the rejected count: a row may count twice."""
    return rejects.groupBy("Campo", "Motivo").agg(F.count("*").alias("Violaciones"))


def _report(table: str, rule: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(table).alias("tabla"),
        F.lit(rule).alias("regla"),
        F.col("n").cast("bigint").alias("violaciones"),
    )


def row_checks(df: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Violations of per-row conditions (CHECK, NOT NULL, width, range), all in one scan.

    A condition that is unknown for a row passes, as a CHECK constraint does.
    """
    counted = df.agg(*[F.count_if(~c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("regla"), F.col(f"c{i}").alias("violaciones"))
            for i, name in enumerate(checks)
        ]
    )
    return counted.select(F.lit(table).alias("tabla"), F.inline(pairs))


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    return {f"NOT NULL {c}": F.col(c).isNotNull() for c in columns}


def max_width(widths: Mapping[str, int]) -> dict[str, Column]:
    return {f"WIDTH {c} <= {n}": F.length(F.col(c)) <= n for c, n in widths.items()}


def castable(types: Mapping[str, str]) -> dict[str, Column]:
    """The value survives a cast to the narrow type."""
    return {
        f"TYPE {c} {t}": F.col(c).isNull() | F.col(c).try_cast(t).isNotNull()
        for c, t in types.items()
    }


def unique_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; NULL counts as a value."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("c")).filter("c > 1")
    return _report(table, f"UNIQUE {', '.join(keys)}", repeated.agg(F.count("*").alias("n")))


def foreign_key_check(
    child: DataFrame,
    table: str,
    keys: Sequence[str],
    parent: DataFrame,
    parent_size: Size | None = None,
) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    The child is reduced to one row per key first, so only keys and counts are joined.
    """
    per_key = child.groupBy(*keys).agg(F.count("*").alias("n"))
    lost = orphans(per_key, parent, keys, parent_size, ignore_null=True, balance=False)
    return _report(
        table, f"FOREIGN KEY {', '.join(keys)}", lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    )


def require(df: DataFrame, table: str, checks: Mapping[str, Column]) -> None:
    """Stop the batch when any per-row condition is broken."""
    broken = [r for r in row_checks(df, table, checks).collect() if r["violaciones"]]
    if broken:
        text = "; ".join(f"{r['regla']}: {r['violaciones']}" for r in broken)
        raise QualityError(f"{table}: {text}")


def require_unique(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Stop the batch when a key would be held by two rows."""
    found = unique_check(df, table, keys).first()
    if found["violaciones"]:
        raise QualityError(f"{table}: {found['regla']}: {found['violaciones']}")


def rows_in_closed_periods(df: DataFrame, closed: DataFrame, date: str) -> DataFrame:
    """Rows whose (year, month) is closed.  The closed list is at most one row per month."""
    months = closed.select(F.col("Anio").alias("_y"), F.col("Mes").alias("_m")).distinct()
    day = F.col(date)
    return df.join(months, (F.year(day) == F.col("_y")) & (F.month(day) == F.col("_m")), "left_semi")


def require_open_periods(df: DataFrame, closed: DataFrame, date: str) -> None:
    """One row in a closed period blocks the whole batch."""
    if not rows_in_closed_periods(df.select(date), closed, date).isEmpty():
        raise QualityError("the batch holds rows of a closed period")


def reconcile(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several frames side by side, as uncorrelated scalar subqueries."""
    spark = next(iter(counts.values())).sparkSession
    parts = ", ".join(f"(SELECT count(*) FROM {{{name}}}) AS {name}" for name in counts)
    return spark.sql(f"SELECT {parts}", **counts)
