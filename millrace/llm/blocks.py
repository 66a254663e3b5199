"""Stored blocks of vectors, and jobs in which blocks of queries meet blocks of candidates."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import keyed_join, measure
from millrace.session import materialize

#: Query blocks that one task takes past a held block.
TOGETHER = 8


def dump(**arrays: np.ndarray) -> bytes:
    """Arrays by name as one value of a binary column."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def load(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as file:
        return {name: file[name] for name in file.files}


def dense(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column of doubles, shorter ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    values = np.asarray(lists.flatten(), float)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of longs without nulls."""
    return np.asarray(column, np.int64)


def one_row(names: list[str], values: list, types: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def dealt(rows: DataFrame, group: str, most: int) -> DataFrame:
    """``rows`` with ``piece``: each group is dealt by a hash of ``row`` into pieces of some ``most`` rows.

    A group of any size comes apart, so a hot one does not lie in one task.
    """
    counts = materialize(
        rows.groupBy(group).agg(F.ceil(F.count("*") / F.lit(float(most))).cast("bigint").alias("pieces")), "counts"
    )
    return keyed_join(rows, counts, [group], right_size=measure(counts)).withColumn("piece", F.pmod(F.xxhash64("row"), "pieces")).drop("pieces")


def meet(
    held: DataFrame, asked: DataFrame, pairs: DataFrame,
    run: Callable[[dict, dict], dict[str, np.ndarray] | None], schema: str, prepare: Callable[[bytes], dict] = load,
) -> DataFrame:
    """What ``run(held block, asked block)`` gives for every one of ``pairs`` (``held``, ``asked``).

    ``held`` and ``asked`` have a block's name and its ``data``.  A held block is sent once for
    each ``TOGETHER`` or so asked blocks; those stream past it, so that a task needs room for one of
    each, and a held block that meets many others is worked on by many tasks.
    """
    lanes = max(-(-asked.count() // TOGETHER), 1)
    to = pairs.withColumn("lane", F.pmod(F.xxhash64("asked"), F.lit(lanes)))
    first = to.select("held", "lane").distinct().join(held.select("held", "data"), "held")
    then = to.join(asked.select("asked", "data"), "asked")
    both = first.select("held", "lane", F.lit(0).alias("kind"), "data").unionByName(
        then.select("held", "lane", F.lit(1).alias("kind"), "data")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                place, kind = (batch.column(0)[at].as_py(), batch.column(1)[at].as_py()), batch.column(2)[at].as_py()
                data = batch.column(3)[at].as_py()
                if kind == 0:
                    name, block = place, prepare(data)
                    continue
                if place != name:
                    raise ValueError(f"no block {place} before those that meet it")
                found = run(block, load(data))
                if found is not None:
                    yield pa.RecordBatch.from_pydict(found)

    return both.repartition("held", "lane").sortWithinPartitions("held", "lane", "kind").mapInArrow(work, schema)
