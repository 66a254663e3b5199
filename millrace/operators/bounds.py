"""Partition predicates from bounds on the column that partitions are made of.

A layout declares in its schema what a partition column is made from: ``part_of("Anio", INT, "Fecha",
"year")`` is a field whose metadata says so, and metadata travel with the frame (``readers.read_layout``
and the warehouse put them on what they read).  ``bounded`` then turns bounds on the source column into a filter on the partition columns as
well, so that a scan opens only the directories it needs, whoever asks.

Parts of a date are ordered as the date is: year, then month, then day.  ``floor:<width>`` of a number and
``prefix:<n>`` of a text are each ordered as their source.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PARTS = ("year", "month", "day")


def part_of(name: str, kind: T.DataType, source: str, part: str) -> T.StructField:
    """A field that holds ``part`` of the column ``source``."""
    if part not in DATE_PARTS and not part.startswith(("floor:", "prefix:")):
        raise ValueError(f"unknown part: {part}")
    return T.StructField(name, kind, True, {"part_of": source, "part": part})


def part_value(source: Column, part: str) -> Column:
    """What a partition column holds, as an expression over its source."""
    if part in DATE_PARTS:
        return getattr(F, part)(source)
    kind, _, width = part.partition(":")
    if kind == "floor":
        return F.floor(source / F.lit(float(width))).cast("bigint")
    return F.substring(source, 1, int(width))


def with_parts(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """``df`` with the declared partition columns, which keep their declaration."""
    return df.select(
        *[c for c in df.columns if c not in {f.name for f in fields}],
        *[
            part_value(F.col(f.metadata["part_of"]), f.metadata["part"]).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in fields
        ],
    )


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, with the declarations that a scan drops from partition columns."""
    return df.select(
        *[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in schema.fields]
    )


def declared_parts(schema: T.StructType, source: str) -> dict[str, str]:
    """Columns that are parts of ``source``, by part."""
    found = {}
    for f in schema.fields:
        if f.metadata.get("part_of") == source:
            found.setdefault(f.metadata["part"], f.name)
    return found


def _day(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value[:10])


def _from_first(columns: list[Column], values: list[int], low: bool) -> Column:
    """Whether a tuple of columns is at least (or at most) a tuple of values, in order of places."""
    beyond = columns[0] > values[0] if low else columns[0] < values[0]
    equal = columns[0] == values[0]
    if len(columns) == 1:
        return beyond | equal
    return beyond | (equal & _from_first(columns[1:], values[1:], low))


def derived_predicate(
    schema: T.StructType, source: str, low: object = None, high: object = None
) -> Column | None:
    """What bounds on ``source`` (either may be None) say of its declared parts; None if nothing."""
    parts = declared_parts(schema, source)
    out: list[Column] = []
    dated = []
    for part in DATE_PARTS:  # a month says something only below its year
        if part not in parts:
            break
        dated.append(part)
    for value, is_low in ((low, True), (high, False)):
        if value is None:
            continue
        if dated:
            day = _day(value)
            out.append(_from_first([F.col(parts[p]) for p in dated], [getattr(day, p) for p in dated], is_low))
        for part, name in parts.items():
            kind, _, width = part.partition(":")
            if kind == "floor":
                edge = int(float(value) // float(width))
            elif kind == "prefix":
                edge = str(value)[: int(width)]
            else:
                continue
            out.append(F.col(name) >= F.lit(edge) if is_low else F.col(name) <= F.lit(edge))
    if not out:
        return None
    whole = out[0]
    for more in out[1:]:
        whole = whole & more
    return whole


def bounded(df: DataFrame, column: str, low: object = None, high: object = None) -> DataFrame:
    """Rows with ``low <= column <= high``, with the partition filter that this implies.

    Dates may be given as text.  A NULL is outside any bounds.  Of rows whose declared parts
    contradict their source the answer may leave some out, as a pruned scan would.
    """
    dated = any(p in DATE_PARTS for p in declared_parts(df.schema, column)) or any(
        isinstance(v, date) for v in (low, high)
    )
    value = F.col(column).cast("date") if dated else F.col(column)
    edge = lambda v: F.lit(_day(v)) if dated else F.lit(v)
    kept = df
    if low is not None:
        kept = kept.filter(value >= edge(low))
    if high is not None:
        kept = kept.filter(value <= edge(high))
    derived = derived_predicate(df.schema, column, low, high)
    return kept if derived is None else kept.filter(derived)
