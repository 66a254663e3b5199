"""Surrogate keys, first rows and source order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import Size, store_measured
from millrace.operators.quality import QualityError
from millrace.session import materialize

ONE_TASK_ROWS = 200_000
_ROW_BITS = 33


def with_source_order(df: DataFrame, name: str = "src_seq") -> DataFrame:
    """Number rows in the order the scan delivers them (unique and rising, with gaps).

    Apply directly to a file scan.  Within a file the numbers follow the file.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def first_rows(df: DataFrame, n: int, order_by: str | Sequence[str] = "src_seq") -> DataFrame:
    """The first ``n`` rows in source order; 0 keeps all."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order).limit(n) if n > 0 else df


def scan_prefix(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a Parquet scan in file order (files by path, rows as they lie), unsorted.

    Rows are counted by file, from the files' footers; so the file and the place in it where the ``n``-th row
    lies are known.  Files beyond are not opened, and no row moves.  Apply directly to a scan; 0 keeps all.
    """
    if n <= 0:
        return df
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    whole, left = [], n
    # one row a file
    for r in df.groupBy(path.alias("path")).agg(F.count("*").alias("n")).orderBy("path").toLocalIterator():
        if left <= r["n"]:
            break
        whole.append(r["path"])
        left -= r["n"]
    else:
        return df
    last = (path == F.lit(r["path"])) & (place < F.lit(left))
    chosen = df.filter(path.isin([*whole, r["path"]]))
    return chosen.filter(path.isin(whole) | last) if whole else chosen.filter(last)


def dense_ids(
    keys: DataFrame, order_by: Sequence[str | Column], id_name: str, start: int | DataFrame = 0,
    required: Sequence[str] = (),
) -> tuple[DataFrame, Size]:
    """Number distinct ``keys`` ``start + 1, start + 2, ...`` in sorted order.

    The keys are written once and measured while they are.  A small set (at most ``ONE_TASK_ROWS``) is
    numbered by a window in one task.  A larger one is range-partitioned and sorted, each row
    keeping its position within its partition, and written so; the driver then sees only one
    count per partition, and the id is the running count before the partition plus the
    position.  Returns the numbered frame and its measured size.  ``start`` may be a frame of one
    number, read with the keys and not before.  A NULL in a ``required`` column, counted by the same
    tasks, is an error.
    """
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    stored, size, nulls = store_measured(keys, "keys", {c: F.count_if(F.col(c).isNull()) for c in required})
    broken = {c: n for c, n in nulls.items() if n}
    if broken:
        raise QualityError("; ".join(f"NOT NULL {c}: {n}" for c, n in broken.items()))
    if isinstance(start, DataFrame):
        numbered, size = _numbered(stored, order, id_name, 0, size)
        top = start.toDF("_top")
        moved = numbered.crossJoin(F.broadcast(top))  # one row
        return moved.withColumn(id_name, F.col(id_name) + F.coalesce("_top", F.lit(0))).drop("_top"), size
    return _numbered(stored, order, id_name, start, size)


def _numbered(
    stored: DataFrame, order: Sequence[Column], id_name: str, start: int, size: Size
) -> tuple[DataFrame, Size]:
    if size.rows <= ONE_TASK_ROWS:
        position = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return stored.select((position + start).alias(id_name), *stored.columns), size
    return _range_numbered(stored, order, id_name, start), size


def _range_numbered(keys: DataFrame, order: Sequence[Column], id_name: str, start: int) -> DataFrame:
    placed = (
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "keys")
    part = F.shiftright(F.col("_pos"), _ROW_BITS)
    counts = dict(stored.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], start
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    within = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = F.element_at(
        F.array(*[F.lit(o).cast("bigint") for o in offsets or [start]]), part.cast("int") + 1
    )
    return stored.select((before + within + 1).cast("bigint").alias(id_name), *keys.columns)


def continue_ids(
    new_keys: DataFrame, existing: DataFrame, order_by: Sequence[str | Column], id_name: str
) -> tuple[DataFrame, Size]:
    """Number new members after the highest id in use; none of what they are ordered by may be NULL."""
    top = existing.agg(F.max(id_name).cast("bigint"))
    named = [c for c in order_by if isinstance(c, str)]
    return dense_ids(new_keys, order_by, id_name, start=top, required=named)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The ``values`` of the first row of each key in the given order.

    One aggregate: each task keeps the earliest row of a key, and so does the final step; among
    rows at the same position the smallest.  No group is ever gathered in one task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    best = df.groupBy(*keys).agg(F.min(F.struct(rank.alias("_first"), *values)).alias("_v"))
    first = ["_v._first"] if len(order) == 1 else [f"_v._first.{c}" for c in order]
    return best.select(
        *keys,
        *[F.col(f"_v.{v}").alias(v) for v in values],
        *[F.col(path).alias(c) for path, c in zip(first, order, strict=True)],
    )


def first_appearance(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Distinct ``keys`` (NULL is a member) with the position at which each first appears."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(*keys).agg(F.min(rank).alias("first_seen"))


def fold_duplicates(
    df: DataFrame, order_by: str | Sequence[str] | None = None, copies: str = "copies"
) -> DataFrame:
    """Exact-duplicate removal over all columns but the ordering ones, with a copy count.

    NULL equals NULL.  Copies are combined within each task before the shuffle.
    """
    order = [] if order_by is None else [order_by] if isinstance(order_by, str) else list(order_by)
    values = [c for c in df.columns if c not in order]
    aggs = [F.count("*").alias(copies)]
    if len(order) == 1:
        aggs.append(F.min(order[0]).alias(order[0]))
    elif order:
        aggs.append(F.min(F.struct(*order)).alias("_first"))
    folded = df.groupBy(*values).agg(*aggs)
    if len(order) > 1:
        folded = folded.select(*values, copies, *[F.col(f"_first.{c}") for c in order])
    return folded
