"""One log row per run, also for a run that fails."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sources.warehouse import Warehouse

RUN_TABLE = "LogCargaETL"
OK, ERROR, PARTIAL = "OK", "ERROR", "ERROR_PARCIAL"


@dataclass
class Run:
    process: str
    started: datetime
    read: int | None = None
    inserted: int = 0
    rejected: int | None = None


@dataclass(frozen=True)
class LoadResult:
    """What a load returns: rows inserted, and rows rejected or discarded."""

    inserted: int
    rejected: int = 0
    partial_error: str | None = None


def log_run(
    warehouse: Warehouse, run: Run, state: str, message: str | None = None, process: str | None = None
) -> None:
    row = warehouse.spark.createDataFrame(
        [
            (
                warehouse.highest_id(RUN_TABLE) + 1,
                process or run.process,
                run.started,
                datetime.now(UTC).replace(microsecond=0),
                run.read,
                run.inserted,
                run.rejected,
                state,
                message[:4000] if message else None,
                None,
            )
        ],
        schemas.RUN_LOG,
    ).withColumn("UsuarioEjecucion", F.current_user())
    warehouse.publish(append={RUN_TABLE: row}, ids={RUN_TABLE: "LogId"})


@contextmanager
def logged_run(warehouse: Warehouse, process: str) -> Iterator[Run]:
    """Log the run as OK, or as ERROR with nothing inserted, and raise the error again."""
    run = Run(process, datetime.now(UTC).replace(microsecond=0))
    try:
        yield run
    except Exception as error:
        run.inserted = 0
        log_run(warehouse, run, ERROR, str(error))
        raise
    log_run(warehouse, run, OK)


def latest(log: DataFrame, n: int = 10, process: str | None = None, id_column: str = "LogId") -> DataFrame:
    """The ``n`` log rows with the highest ids, newest first."""
    chosen = log if process is None else log.filter(F.col("Proceso") == process)
    return chosen.orderBy(F.desc(id_column)).limit(n)
