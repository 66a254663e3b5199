"""Joins that stay balanced at scale.

A side is broadcast only after its size has been measured.  Beyond that bound the join
shuffles, and keys that carry a large share of the left rows are spread over as many
tasks as their share asks for: the left copies by a hash of the whole row, the (unique)
right row by replication.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import store_counted

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.02
#: Pieces of a hot key for each partition that its rows would fill; several, as they are hashed.
PIECES = 4


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def row_bytes(df: DataFrame) -> tuple[int, Column]:
    """Bytes of a row in memory: a fixed part and an expression for its texts and nested values."""
    lengths = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            lengths.append(F.octet_length(F.col(f.name)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            lengths.append(F.octet_length(F.to_json(F.struct(f.name))))
    variable = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in lengths], F.lit(0))
    return 8 * (len(df.columns) + 1), variable.cast("bigint")


def measure(df: DataFrame) -> Size:
    """Rows and bytes in memory of a frame, by one aggregate over it."""
    fixed, variable = row_bytes(df)
    row = df.agg(F.count("*").alias("n"), F.sum(variable).alias("v")).first()
    return Size(row["n"], row["n"] * fixed + (row["v"] or 0))


def store_measured(df: DataFrame, name: str, more: Mapping[str, Column] | None = None) -> tuple[DataFrame, Size, dict]:
    """A stored frame, its size in memory and ``more`` aggregates, measured by the tasks that write it."""
    fixed, variable = row_bytes(df)
    named = {f"more_{n}": c for n, c in (more or {}).items()}
    stored, seen = store_counted(df, name, n=F.count(F.lit(1)), v=F.sum(variable), **named)
    return stored, Size(seen["n"], seen["n"] * fixed + (seen["v"] or 0)), {n: seen[f"more_{n}"] for n in more or {}}


def fits_broadcast(size: Size | None, limit: int = BROADCAST_BYTES) -> bool:
    return size is not None and size.bytes <= limit


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[int, int]:
    """Hashes of the keys that hold at least ``share`` of the rows (at most 1/share of them),
    each with the number of pieces to spread it over.

    One pass with a heavy-hitter sketch: tasks send sketches of fixed size, not keys.  The
    answer only decides where rows travel, never which rows are in the result.
    """
    row = (
        df.select(_hash(keys).alias("h"))
        .agg(F.expr("approx_top_k(h, 128, 4096)").alias("top"), F.count("*").alias("n"))
        .first()
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {
        t["item"]: PIECES * max(1, -(-t["count"] * tasks // row["n"]))
        for t in (row["top"] or [])
        if t["count"] >= max(share * row["n"], 1000)
    }


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    right_size: Size | None = None,
    null_safe: bool = False,
    balance: bool = True,
) -> DataFrame:
    """Join ``left`` to a ``right`` that holds each key once.

    ``right_size`` is a measurement of ``right`` (see ``measure``); within the bound the
    right side is broadcast and the left side does not move.  ``balance`` looks for hot
    left keys before shuffling; leave it off when the keys are known to be spread.
    Right key columns are dropped, so the result has the left columns and the right payload.
    """
    if fits_broadcast(right_size):
        left_in, right_in = left, F.broadcast(right)
        on = list(keys)
    else:
        hot = hot_hashes(left, keys) if balance else {}
        left_in, right_in, on = left, right, list(keys)
        if hot:
            pieces = F.lit(1)
            for key_hash, n in hot.items():
                pieces = F.when(_hash(keys) == F.lit(key_hash), n).otherwise(pieces)
            whole_row = F.xxhash64(*[F.col(c) for c in left.columns])
            left_in = left.withColumn("_salt", F.pmod(whole_row, pieces).cast("int"))
            right_in = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
            on = on + ["_salt"]
    if null_safe:
        renamed = right_in
        for k in on:
            renamed = renamed.withColumnRenamed(k, f"_r_{k}")
        match = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on]
        )
        joined = left_in.join(renamed, match, how)
        joined = joined.drop(*[f"_r_{k}" for k in on])
    else:
        joined = left_in.join(right_in, on, how)
    return joined.drop("_salt") if "_salt" in on else joined


def not_yet_in(
    staged: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    existing_size: Size | None = None,
    balance: bool = True,
) -> DataFrame:
    """Rows of ``staged`` whose key is absent from ``existing`` (a NULL key is never present).

    ``existing`` may repeat its keys: they are reduced to one each, combining within each
    task first, so a pile of copies on either side does not land in one task.
    """
    known = existing.select(*keys).distinct()
    return keyed_join(staged, known, keys, "left_anti", existing_size, balance=balance)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_size: Size | None = None,
    ignore_null: bool = False,
    balance: bool = True,
) -> DataFrame:
    """Child rows with no parent.  A foreign key ignores NULL; an existence rule reports it."""
    rows = child
    if ignore_null:
        rows = rows.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return not_yet_in(rows, parent, keys, parent_size, balance)


def top_per_outer_row(
    outer: DataFrame,
    inner: DataFrame,
    outer_key: str,
    inner_key: str,
    order_by: Sequence[Column],
    n: int = 1,
) -> DataFrame:
    """Apply a per-row lookup: the best ``n`` inner rows for each outer row, as a lateral join."""
    matching = inner.where(F.col(inner_key) == F.col(outer_key).outer())
    return outer.lateralJoin(matching.orderBy(*order_by).limit(n))
