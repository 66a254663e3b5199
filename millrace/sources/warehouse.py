"""Tables made of published batches.

Each load writes its rows to new batch folders.  One append of a few rows to the
``published`` table then makes every batch of that load visible together, so a reader never
sees half a load, and a failed load leaves only unreferenced folders.  Large facts grow by
batches.  A batch may also amend a table: it holds the new contents of some partitions, and those of
earlier batches are passed over from then on, without a rewrite of anything else.  A column may be added:
earlier batches then read as holding its stored value.  Small tables may be replaced.  One writer at a
time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.bounds import declared
from millrace.operators.quality import QualityError
from millrace.schemas import FLAG, LONG, TEXT, record
from millrace.session import empty_frame, in_parallel

#: Room for 16.7 million write tasks in one batch.
TASK_BITS = 24

#: ``amends``: the partitions whose earlier rows a batch replaces; ``adds``: a column added to a table.
_PUBLISHED = record(version=LONG, tabla=TEXT, batch=TEXT, replaces=FLAG, top=LONG, amends=TEXT, adds=TEXT)

Partition = Mapping[str, object]


@dataclass(frozen=True)
class AddedColumn:
    """A column that a table has since a version; ``value`` is what rows of earlier batches hold."""

    name: str
    kind: T.DataType
    value: object
    required: bool
    version: int

    @property
    def literal(self) -> Column:
        return F.lit(self.value).cast(self.kind)


def in_partitions(partitions: Sequence[Partition]) -> Column:
    """Whether a row lies in one of some partitions (all named by the same columns)."""
    by_head: dict[tuple, list] = {}
    for p in partitions:
        *head, last = p.items()
        by_head.setdefault(tuple(head), []).append(last)
    found: Column = F.lit(False)
    for head, last in by_head.items():
        name, values = last[0][0], [v for _, v in last]
        here = F.col(name).isin([v for v in values if v is not None])
        here = here | F.col(name).isNull() if None in values else here
        for column, value in head:
            here = here & F.col(column).eqNullSafe(F.lit(value))
        found = found | F.coalesce(here, F.lit(False))
    return found


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: tuple[frozenset, list] = (frozenset(), [])

    def _published(self) -> list:
        """The publication list.  It is read again only when the listing of its folder has changed."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/published")
        store = folder.getFileSystem(context._jsc.hadoopConfiguration())
        try:
            names = frozenset(s.getPath().getName() for s in store.listStatus(folder))
        except Py4JJavaError as missing:
            if "FileNotFoundException" in missing.java_exception.getClass().getName():
                return []
            raise
        names = frozenset(n for n in names if n.endswith(".parquet"))
        if names != self._known[0]:
            frame = self.spark.read.schema(_PUBLISHED).parquet(f"{self.root}/published")
            self._known = (names, sorted(frame.collect(), key=lambda r: r["version"]))
        return self._known[1]

    @property
    def version(self) -> int:
        """The number of the last publication."""
        return max((r["version"] for r in self._published()), default=0)

    def exists(self, name: str) -> bool:
        return any(r["tabla"] == name and r["batch"] for r in self._published())

    def added_columns(self, name: str) -> list[AddedColumn]:
        """Columns that were added to a table, in order."""
        out = []
        for r in self._published():
            if r["tabla"] == name and r["adds"]:
                note = json.loads(r["adds"])
                kind = T._parse_datatype_json_string(json.dumps(note["type"]))
                out.append(AddedColumn(note["name"], kind, note["value"], note["required"], r["version"]))
        return out

    def schema(self, name: str, first: T.StructType) -> T.StructType:
        """A table's schema now: as it was ``first``, and the columns added since."""
        return T.StructType([*first.fields, *[T.StructField(c.name, c.kind) for c in self.added_columns(name)]])

    def add_column(self, name: str, column: str, kind: T.DataType, value: object, required: bool = True) -> None:
        """Add a column to a table, with the value that all rows published so far have.

        Nothing is rewritten: earlier batches are read with that value.  A ``required`` column must be in
        every later batch and hold no NULL there, and ``value`` may not be NULL if the table has rows.
        """
        if any(c.name == column for c in self.added_columns(name)):
            raise ValueError(f"{name} has a column {column} already")
        if required and value is None and self.exists(name):
            raise QualityError(f"{name}: NOT NULL {column}: rows published before would have none")
        note = {"name": column, "type": kind.jsonValue(), "value": value, "required": required}
        version = self.version + 1
        self._note([(version, name, None, False, None, None, json.dumps(note))])

    def _note(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, _PUBLISHED).coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def table(self, name: str, schema: T.StructType) -> DataFrame:
        """The visible rows of a table; empty when nothing was published."""
        return self.tables({name: schema})[name]

    def tables(self, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
        """Several tables as of one moment."""
        live: dict[str, list] = {name: [] for name in schemas}
        for r in self._published():
            if r["tabla"] in live and r["batch"]:
                before = [] if r["replaces"] else live[r["tabla"]]
                live[r["tabla"]] = [*before, r]
        return {name: self._read(name, schema, live[name]) for name, schema in schemas.items()}

    def _read(self, name: str, schema: T.StructType, batches: list) -> DataFrame:
        if not batches:
            return declared(empty_frame(self.spark, schema), schema)
        rows = (
            self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", TEXT)]))
            .option("basePath", f"{self.root}/{name}")
            .parquet(*[f"{self.root}/{name}/batch={r['batch']}" for r in batches])
        )
        # a partition's rows are those of the last batch that amends it, and of later ones
        since: dict[str, int] = {}
        for r in batches:
            since |= {json.dumps(p): r["version"] for p in json.loads(r["amends"] or "[]")}
        by_version: dict[int, list[Partition]] = {}
        for p, version in since.items():
            by_version.setdefault(version, []).append(json.loads(p))
        for version, partitions in by_version.items():
            rows = rows.filter(~(self._before(version) & in_partitions(partitions)))
        for c in self.added_columns(name):
            if c.name in schema.names and batches[0]["version"] < c.version:
                stored = F.when(self._before(c.version), c.literal).otherwise(F.col(c.name))
                rows = rows.withColumn(c.name, stored)
        return declared(rows, schema)

    @staticmethod
    def _before(version: int) -> Column:
        """Whether a batch is older than a version (folder names begin with theirs)."""
        return F.col("batch") < F.lit(f"{version:08d}")

    def highest_id(self, name: str) -> int:
        """The highest row id ever given out in a table, known without reading the table."""
        return max((r["top"] or 0 for r in self._published() if r["tabla"] == name), default=0)

    def publish(
        self,
        append: Mapping[str, DataFrame] | None = None,
        replace: Mapping[str, DataFrame] | None = None,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        ids: Mapping[str, str] | None = None,
        amend: Mapping[str, tuple[DataFrame, Sequence[Partition]]] | None = None,
    ) -> dict[str, int]:
        """Write every frame, then make all of them visible at once.

        ``amend`` names for a table the new contents of some partitions, whole, and the partitions.
        Returns the rows written per table.  They, the highest ids and the NULLs of required columns
        are observed by the tasks that write, so no job reads the files again.  That is exact when
        tasks or stages are retried: nothing is shuffled between the observation and the writer, and
        Spark counts each task of a job's last stage once, however often it ran.
        """
        work = [(n, d, False, None) for n, d in (append or {}).items()]
        work += [(n, d, True, None) for n, d in (replace or {}).items()]
        work += [(n, d, False, [dict(p) for p in parts]) for n, (d, parts) in (amend or {}).items()]
        version = self.version + 1

        def write(name: str, df: DataFrame, replaces: bool, partitions: list | None) -> tuple:
            batch = f"{version:08d}-{uuid.uuid4().hex[:8]}"
            path = f"{self.root}/{name}/batch={batch}"
            added = self.added_columns(name)
            missing = [c.name for c in added if c.required and c.name not in df.columns]
            required = [c.name for c in added if c.required and c.name in df.columns]
            top = F.max(ids[name] if ids and name in ids else F.lit(None))
            seen = Observation()
            observed = df.observe(
                seen, F.count(F.lit(1)).alias("n"), top.cast("bigint").alias("top"),
                *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
            )
            keys = (partition_by or {}).get(name)
            (observed.write.partitionBy(*keys) if keys else observed.write).parquet(path)
            counts = seen.get
            nulls = [c for c in required if counts[f"null_{c}"]] + (missing if counts["n"] else [])
            if nulls:
                raise QualityError(f"{name}: NOT NULL {', '.join(nulls)}")
            amends = None if partitions is None else json.dumps(partitions)
            return counts["n"], (version, name, batch, replaces, counts["top"], amends, None)

        done = in_parallel([lambda w=w: write(*w) for w in work])
        # an append of nothing is no news
        rows = [row for count, row in done if count or row[3] or row[5]]
        if rows:
            self._note(rows)
        return {row[1]: count for count, row in done}

    def drop(self, name: str, schema: T.StructType) -> None:
        """Make a table empty again (drop and recreate)."""
        self.publish(replace={name: empty_frame(self.spark, schema)})


def identities(df: DataFrame, name: str, after: int = 0) -> DataFrame:
    """Row ids for a batch being written: unique and rising within a task, with gaps.

    The position within the task is the high part and the task the low part, so one batch
    uses up little of the range.
    """
    return df.select(row_id(F.monotonically_increasing_id(), after).alias(name), *df.columns)


def row_id(serial: Column, after: int) -> Column:
    """The id of a row from its serial (task in the bits above 33, position below).

    Tasks have ``TASK_BITS`` bits, positions the 33 that a serial gives them.  A task number
    beyond its bits, or a sum beyond a long, stops the job.
    """
    task = F.shiftright(serial, 33)
    position = serial.bitwiseAND(F.lit((1 << 33) - 1))
    beyond = F.raise_error(F.lit("more write tasks than row ids have room for")).cast("bigint")
    checked = F.when(task < (1 << TASK_BITS), task).otherwise(beyond)
    # a product, as a shift would lose silently what overflows
    return F.lit(after).cast("bigint") + 1 + position * F.lit(1 << TASK_BITS) + checked
