"""Idempotent loading of lookup tables: insert the staged members that are not there yet."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import keyed_join, not_yet_in
from millrace.operators.keys import continue_ids
from millrace.schemas import INT, TEXT
from millrace.session import in_parallel


@dataclass(frozen=True)
class Lookup:
    """A lookup table: surrogate ``id``, natural ``name`` taken from the staged column
    ``source``, and for a two-level hierarchy the ``parent`` lookup whose id is part of the key."""

    table: str
    id: str
    source: str
    name: str = "Nombre"
    parent: Lookup | None = None

    @property
    def keys(self) -> list[str]:
        return [self.parent.id, self.name] if self.parent else [self.name]

    @property
    def schema(self) -> T.StructType:
        parts = [T.StructField(self.id, INT)]
        if self.parent:
            parts.append(T.StructField(self.parent.id, INT))
        return T.StructType([*parts, T.StructField(self.name, TEXT)])


def resolve(df: DataFrame, lookup: Lookup, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Add the lookup's id to ``df``, joining on the natural name (and the parent's id).

    An inner join drops rows with an unknown member, as the loads require.  The lookup is
    read from files, so the optimizer broadcasts it only when its true size is small;
    otherwise both sides shuffle and adaptive execution splits a skewed member.
    """
    side = rows.select(lookup.id, *lookup.keys).withColumnRenamed(lookup.name, lookup.source)
    on = [lookup.parent.id, lookup.source] if lookup.parent else [lookup.source]
    return keyed_join(df, side, on, how, balance=False)


def new_members(staged: DataFrame, lookup: Lookup, existing: DataFrame) -> DataFrame:
    """Staged members absent from ``existing``, with ids that continue after its highest.

    ``staged`` holds the natural key columns of the lookup.  A missing name breaks the NOT
    NULL rule of the table and stops the batch.
    """
    members = staged.select(*lookup.keys).distinct()
    fresh = not_yet_in(members, existing, lookup.keys, balance=False)
    numbered, _ = continue_ids(fresh, existing, lookup.keys, lookup.id)
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in lookup.schema.fields])


def load_lookups(
    staged: DataFrame, lookups: list[Lookup], existing: Mapping[str, DataFrame]
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Load lookups, parents before children and otherwise side by side.

    ``staged`` may be any frame with the source columns; pass one already reduced to its
    distinct combinations.  Returns the new rows per table and the whole tables after the load.
    """
    fresh: dict[str, DataFrame] = {}
    whole: dict[str, DataFrame] = {}

    def load(lookup: Lookup) -> None:
        source = staged
        if lookup.parent:
            pairs = staged.select(lookup.parent.source, lookup.source).distinct()
            source = resolve(pairs, lookup.parent, whole[lookup.parent.table])
        named = source.withColumnRenamed(lookup.source, lookup.name)
        before = existing[lookup.table].select(*lookup.schema.names)
        fresh[lookup.table] = new_members(named, lookup, before)
        whole[lookup.table] = before.unionByName(fresh[lookup.table])

    in_parallel([lambda k=k: load(k) for k in lookups if not k.parent])
    in_parallel([lambda k=k: load(k) for k in lookups if k.parent])
    return fresh, whole


# Keys under a collation: names that differ in case or in blanks at the end are one member.

COLLATION = "UNICODE_CI_RTRIM"


def under(name: str, collation: str = COLLATION) -> Column:
    """A text column that compares, joins and groups by a collation."""
    return F.collate(F.col(name), collation)


def one_spelling(staged: DataFrame, lookup: Lookup, collation: str = COLLATION) -> DataFrame:
    """Each member of ``staged`` once, in the smallest of its spellings (by code point)."""
    parents = lookup.keys[:-1]
    return staged.groupBy(*parents, under(lookup.name, collation).alias("_as")).agg(
        F.min(lookup.name).alias(lookup.name)
    ).drop("_as")


def _same(lookup: Lookup, left: str, right: str, collation: str) -> Column:
    """Whether the keys of two aliased frames are equal."""
    equal = under(f"{left}.{lookup.name}", collation) == under(f"{right}.{lookup.name}", collation)
    for parent in lookup.keys[:-1]:
        equal = equal & (F.col(f"{left}.{parent}") == F.col(f"{right}.{parent}"))
    return equal


def new_members_collated(staged: DataFrame, lookup: Lookup, existing: DataFrame, collation: str = COLLATION) -> DataFrame:
    """``new_members`` where names are equal under a collation.

    A member that is there in any spelling is not new, and keeps the one it has.
    """
    members = one_spelling(staged.select(*lookup.keys), lookup, collation)
    fresh = members.alias("s").join(existing.alias("e"), _same(lookup, "s", "e", collation), "left_anti")
    numbered, _ = continue_ids(fresh, existing, lookup.keys, lookup.id)
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in lookup.schema.fields])


def resolve_collated(df: DataFrame, lookup: Lookup, rows: DataFrame, how: str = "inner", collation: str = COLLATION) -> DataFrame:
    """``resolve`` where names are equal under a collation; ``df`` keeps its own spelling."""
    named = df.withColumnRenamed(lookup.source, lookup.name).alias("s")
    side = rows.select(lookup.id, *lookup.keys).alias("e")
    joined = named.join(side, _same(lookup, "s", "e", collation), how)
    return joined.select(
        *[F.col(f"s.{c}").alias(lookup.source if c == lookup.name else c) for c in named.columns], F.col(f"e.{lookup.id}")
    )


def collated_duplicates(rows: DataFrame, lookup: Lookup, collation: str = COLLATION) -> DataFrame:
    """Members that a unique key under the collation would refuse, with their number of spellings."""
    return rows.groupBy(*lookup.keys[:-1], under(lookup.name, collation).alias("_as")).agg(
        F.min(lookup.name).alias(lookup.name), F.count("*").alias("filas")
    ).drop("_as").filter("filas > 1")
