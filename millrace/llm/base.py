"""What the operators share: registry, word rules, row keys, shared files."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, suppress
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import empty_frame, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def driver_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """The driver's few rows as a frame.

    Spark sends Python rows through Python workers of the executors, others than those of Arrow
    functions; they and their daemon stay and keep their memory.  Arrow columns need none.
    """
    shape = StructType.fromDDL(schema)
    if not rows:
        return empty_frame(spark, shape)
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, shape.names), shape)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(key: Column, modulus: int, remainder: int = 2) -> Column:
    """Whether a row belongs to the fold that is not learned from (a null key counts as '')."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus == remainder


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space: space, tab to carriage return."""
    return text.lower().split() if text else []


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


@dataclass(frozen=True)
class Words:
    """The words of some texts: each different one once, and where each word is among these."""

    distinct: pa.Array  # binary
    at: np.ndarray
    sizes: np.ndarray  # words by text


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """Words between ASCII white space of a string column, A-Z lower-cased if wanted; null has none.

    The split runs on Arrow buffers, so that Python sees a word of many texts once.
    """
    plain = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
    sizes, values = np.asarray(lists.value_lengths(), np.int64), lists.flatten()
    told = values.dictionary_encode()
    at, distinct = np.asarray(told.indices, np.int64), told.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()  # what a split leaves at the ends
    if empty >= 0:
        kept = at != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        at = at[kept]
        at -= at > empty
        distinct = pa.concat_arrays([distinct.slice(0, empty), distinct.slice(empty + 1)])
    return Words(distinct.cast(pa.large_binary() if pa.types.is_large_string(distinct.type) else pa.binary()), at, sizes)


def with_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """``values`` of the words of some texts, with ``end`` after each text."""
    out = np.full(len(values) + len(sizes), end, values.dtype)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    out[inner] = values
    return out


def small_parts(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches with ``most`` bytes of text in a column, or little more."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for a, b in slices((n + 1 for n in lengths), most):
            yield batch.slice(a, b - a)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, most: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows and some ``most`` bytes for the jobs within: less is held on
    both sides of a Python worker's pipe.  The session's own settings come back at the end; results are the
    same with any."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": most}
    before = {}
    for name in wanted:
        with suppress(Exception):  # older versions have no bound in bytes
            before[name] = spark.conf.get(name)  # given a default, this would pass over Spark's own
    for name, value in before.items():
        plain = value.lower().rstrip("b")
        now = int(plain) if plain.isdigit() else 0  # unbounded, or in other units
        spark.conf.set(name, str(min(wanted[name], now) if now > 0 else wanted[name]))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


_MODEL: list = [None, None]


def model_of(make: Callable | None = None, *given: object) -> object:
    """``make(*given)``, kept for this worker's next tasks that ask for the same.

    A worker goes on from one operator to the next and keeps the model of one only: what another
    operator left goes first.  Operators without a model call this with nothing.
    """
    if _MODEL[0] != (make, *given):
        _MODEL[:] = [None, None]
        give_back()
        if make is not None:
            _MODEL[:] = [(make, *given), make(*given)]
    return _MODEL[1]


def give_back() -> None:
    """Return what Arrow and the C library hold unused to the system, at the end of a task: its
    worker waits for others, maybe of another operator."""
    pa.default_memory_pool().release_unused()
    trim = _malloc_trim()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _malloc_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``most`` or little more."""
    start, total, end = 0, 0, 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, made longer until it clashes with no column (case is ignored)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def put_file(path: str, content: bytes | Iterable[bytes]) -> int:
    """Write a file of the shared store from within a task; returns its bytes.

    It appears under its name only when whole, so that a task that is run twice leaves one
    whole file.
    """
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    draft = f"{place}.{uuid.uuid4().hex}.tmp"
    written = 0
    with store.open_output_stream(draft) as out:
        for part in [content] if isinstance(content, bytes) else content:
            out.write(part)
            written += len(part)
    store.move(draft, place)
    return written


def open_file(path: str) -> pa.NativeFile:
    """A file of the shared store, for reads at any offset."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        store, place = fs.FileSystem.from_uri(path)
        return store.open_input_file(place)
    return fs.LocalFileSystem().open_input_file(path)
