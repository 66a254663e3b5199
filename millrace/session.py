"""Session helpers: a local session for tests and benches, and reliable staging.

On a cluster the session is the caller's.  Nothing here changes its settings; the
only one read is ``spark.checkpoint.dir``, the shared folder for cut lineage.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Result = TypeVar("Result")

_LOCAL_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(app: str = "millrace", cores: str = "8", memory: str = "8g") -> SparkSession:
    """Session for one machine.  Shuffle partitions follow the cores; AQE stays on."""
    partitions = "8" if cores == "*" else str(max(int(cores), 1))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application.

    Functions that run in Python there import it, and it may not be installed on them.  Where it
    was itself imported from an archive (``--py-files``), they have it already.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    build = tempfile.TemporaryDirectory(prefix="millrace-code-")  # kept: the driver serves it from there
    context.addPyFile(shutil.make_archive(f"{build.name}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED[context.applicationId] = build


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the session, or a private one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that every executor can reach"
        )
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.TemporaryDirectory(prefix="millrace-")
    return _LOCAL_SCRATCH[context.applicationId].name


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike ``cache`` the result survives the loss of executors, its columns are pruned
    by later readers, and Catalyst sees its true size when it chooses a join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path  # for release()
    return stored


def store_counted(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``materialize``, with aggregates that the writing tasks take as the rows pass by.

    No job reads the files again to count them.  Exact when tasks or stages are retried: nothing is
    shuffled between the observation and the writer, and Spark counts each task of a job's last stage once.
    """
    seen = Observation()
    stored = materialize(df.observe(seen, *[m.alias(n) for n, m in measures.items()]), name)
    return stored, dict(seen.get)


def release(*frames: DataFrame | None) -> None:
    """Delete the tables that ``materialize`` wrote for these frames, once nothing reads them any more.

    What was made from them must itself be stored: a lazy frame over a released table cannot be read.
    """
    for df in frames:
        path = df.__dict__.pop("_stored_at", None) if df is not None else None
        if path:
            context = df.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def in_parallel(jobs: Sequence[Callable[[], Result]]) -> list[Result]:
    """Submit independent Spark jobs together, so that small ones share the cluster."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(min(len(jobs), 8)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, as a relation the optimizer knows to be empty."""
    return spark.range(1).filter(F.lit(False)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
