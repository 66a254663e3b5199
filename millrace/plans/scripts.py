"""A stored procedure as a Spark SQL script: variables, a handler, counts as outputs.

The procedures of the original insert what is not there yet, count, and on an error undo and report.  The
script does the same to a catalogue table: it stages the new members first, so that one insert makes
them visible, and a handler turns any error into a result row in place of a stack trace.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.plans.lookups import Lookup
from millrace.plans.run_log import ERROR, OK, LoadResult


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lookup_script(lookup: Lookup, table: str, staged: str) -> str:
    """SQL that loads the members of view ``staged`` (column ``source``) into ``table``.

    Its result is one row: ``estado, insertadas, descartadas, mensaje``.  Discarded are staged rows
    without a name.  Members are few, so one window numbers them.
    """
    source, name, key = quoted(lookup.source), quoted(lookup.name), quoted(lookup.id)
    return f"""
BEGIN
  DECLARE insertadas BIGINT DEFAULT 0;
  DECLARE descartadas BIGINT DEFAULT 0;
  DECLARE ultimo INT DEFAULT 0;
  DECLARE EXIT HANDLER FOR SQLEXCEPTION
  BEGIN
    SELECT '{ERROR}' AS estado, CAST(0 AS BIGINT) AS insertadas, CAST(0 AS BIGINT) AS descartadas,
           'the load was undone' AS mensaje;
  END;
  SET descartadas = (SELECT count(*) FROM {staged} WHERE {source} IS NULL);
  SET ultimo = (SELECT coalesce(max({key}), 0) FROM {table});
  SET insertadas = (
    SELECT count(DISTINCT s.{source}) FROM {staged} s LEFT ANTI JOIN {table} t ON t.{name} = s.{source}
    WHERE s.{source} IS NOT NULL);
  IF insertadas > 0 THEN
    INSERT INTO {table}
    SELECT CAST(ultimo + row_number() OVER (ORDER BY nuevo) AS INT), nuevo
    FROM (SELECT DISTINCT s.{source} AS nuevo FROM {staged} s LEFT ANTI JOIN {table} t ON t.{name} = s.{source}
          WHERE s.{source} IS NOT NULL);
  END IF;
  SELECT '{OK}' AS estado, insertadas, descartadas, CAST(NULL AS STRING) AS mensaje;
END
"""


def run_lookup_script(spark: SparkSession, lookup: Lookup, table: str, staged: str) -> LoadResult:
    """Run the script; its counts are the result."""
    row = spark.sql(lookup_script(lookup, table, staged)).first()
    return LoadResult(row["insertadas"], row["descartadas"], row["mensaje"])


def create_lookup_table(spark: SparkSession, lookup: Lookup, table: str, path: str) -> None:
    """An empty lookup table in the session's catalogue, its rows at ``path``."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in lookup.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
