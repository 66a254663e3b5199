"""Run an idempotent load over files as they arrive.

The source job reads its file in chunks; here a chunk is a micro-batch.  A batch is staged
together with its number, so one that is run again after a failure finds its rows staged, and
one that was finished is skipped; the loads skip rows that are already in the fact or the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.plans import attentions
from millrace.session import materialize
from millrace.sources.readers import delimited_options
from millrace.sources.warehouse import Warehouse, identities


def ingest_files(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    load: Callable[[DataFrame, int], None],
    progress_dir: str,
    sep: str = ";",
    files_per_batch: int = 64,
) -> StreamingQuery:
    """Hand every new delimited file in ``directory`` to ``load``, then stop.

    ``progress_dir`` remembers which files are done; keep it on shared storage.
    """
    files = (
        spark.readStream.schema(schema)
        .options(**delimited_options(sep), maxFilesPerTrigger=files_per_batch)
        .csv(directory)
    )
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start()
    )


BATCH_TABLE, STAGED, DONE = "MicroLote", "EN_STAGING", "OK"


def attentions_loader(warehouse: Warehouse, stream: str = "atenciones") -> Callable[[DataFrame, int], None]:
    """Stage one micro-batch of flat attentions, then load lookups, facilities and the fact."""

    def mark(batch_id: int, first: int | None, last: int | None, state: str) -> DataFrame:
        return warehouse.spark.createDataFrame([(stream, batch_id, first, last, state)], schemas.MICRO_BATCH)

    def load(batch: DataFrame, batch_id: int) -> None:
        known = warehouse.table(BATCH_TABLE, schemas.MICRO_BATCH)
        seen = known.filter((F.col("Flujo") == stream) & (F.col("Lote") == batch_id)).collect()  # two rows at most
        if any(r["Estado"] == DONE for r in seen):
            return
        if seen:
            whole = warehouse.table(attentions.STAGING_TABLE, attentions.staging_schema())
            rows = whole.filter(F.col("StgId").between(seen[0]["Desde"], seen[0]["Hasta"]))
        else:
            after = warehouse.highest_id(attentions.STAGING_TABLE)
            rows = materialize(identities(batch, "StgId", after), "staged")
            first, last = rows.agg(F.min("StgId"), F.max("StgId")).first()
            warehouse.publish(
                append={attentions.STAGING_TABLE: rows, BATCH_TABLE: mark(batch_id, first, last, STAGED)},
                ids={attentions.STAGING_TABLE: "StgId"},
            )
        attentions.load_dimensions(warehouse, rows)
        attentions.load_attentions(warehouse, rows, relog=False)
        warehouse.publish(append={BATCH_TABLE: mark(batch_id, None, None, DONE)})

    return load
