"""Cleaning, parsing, duplicates, projections."""

from __future__ import annotations

from pyspark.errors import DateTimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import (
    date_from_padded,
    date_from_parts,
    parse_compact,
    parse_day_first,
    utc_midnight,
)
from millrace.functions.numbers import clamp_count, drop_negative, parse_money
from millrace.functions.text import WHITESPACE, strip, strip_all, trim_spaces
from millrace.operators.keys import first_per_key, fold_duplicates, scan_prefix
from millrace.plans.reimbursements import drop_blank
from millrace.plans.star import dim_time
from millrace.queries.base import query, table
from millrace.session import materialize

_NBSP = "\u00a0"


@query(
    "clean_text",
    f"""
WITH padded AS (
  SELECT doc_id, concat(chr(9), ' ', text, '{_NBSP} ') AS padded, concat('  ', source, chr(9)) AS source,
         nullif(lang, 'de') AS lang
  FROM documents)
SELECT doc_id, CAST(length(trim(padded, ' ')) AS INT) AS trimmed_length,
       md5(trim(padded, '{WHITESPACE}')) AS stripped_md5,
       trim(source, '{WHITESPACE}') AS source, coalesce(lang, '') AS lang
FROM padded
""",
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("\t "), "text", F.lit(f"{_NBSP} ")).alias("padded"),
        F.concat(F.lit("  "), "source", F.lit("\t")).alias("source"),
        F.nullif(F.col("lang"), F.lit("de")).alias("lang"),
    )
    return padded.select(
        "doc_id",
        F.length(trim_spaces("padded")).alias("trimmed_length"),
        F.md5(strip("padded")).alias("stripped_md5"),
        strip("source").alias("source"),
        strip("lang").alias("lang"),
    )


_MESSY = """case when c_custkey % 11 = 0 then '3d' when c_custkey % 11 = 1 then '0x1p3' when c_custkey % 11 = 2 then '1e3'
  when c_custkey % 11 = 3 then ' 7 ' when c_custkey % 11 = 4 then 'NaN' when c_mktsegment = 'BUILDING' then 'abc'
  when c_mktsegment = 'MACHINERY' then null else cast(cast(c_acctbal as decimal(12,2)) as varchar(20)) end"""


@query(
    "coerce_numbers",
    f"""
SELECT c_custkey,
       CASE WHEN c_custkey % 11 IN (0, 1, 4) THEN 0
            ELSE greatest(coalesce(CAST(trunc(TRY_CAST({_MESSY} AS DOUBLE)) AS BIGINT), 0), 0) END AS count_value,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS known_value
FROM customer
""",
)
def coerce_numbers(spark: SparkSession, sf: str) -> DataFrame:
    messy = table(spark, sf, "customer").withColumn("messy", F.expr(_MESSY))
    return messy.select(
        "c_custkey",
        clamp_count("messy").alias("count_value"),
        drop_negative("c_acctbal").alias("known_value"),
    )


_PARTS = {
    "y": "cast(year(o_orderdate) as int)",
    "m": "cast(month(o_orderdate) as int)",
    "d": "cast(case o_orderstatus when 'P' then null when 'O' then 31 else day(o_orderdate) end as int)",
}
_PARTS_SQL = ", ".join(f"{e} AS {n}" for n, e in _PARTS.items())
_TRY_DATE_SQL = """CASE WHEN d IS NOT NULL
  THEN TRY_CAST(format('{:04d}-{:02d}-{:02d}', y, m, d) AS DATE) END"""


def _order_parts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey", "o_orderdate", *[F.expr(e).alias(n) for n, e in _PARTS.items()]
    )


@query(
    "parse_dates",
    f"""
WITH parts AS (SELECT o_orderkey, o_orderdate, {_PARTS_SQL} FROM orders)
SELECT o_orderkey, {_TRY_DATE_SQL} AS from_parts, {_TRY_DATE_SQL} AS from_padded,
       make_date(y, m, CAST(day(o_orderdate) AS INT)) AS from_valid,
       CAST(o_orderdate AS DATE) AS from_compact, CAST(o_orderdate AS DATE) AS from_day_first,
       strftime({_TRY_DATE_SQL}, '%Y-%m-%dT00:00:00Z') AS wire
FROM parts
""",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    made = date_from_parts("y", "m", "d")
    return _order_parts(spark, sf).select(
        "o_orderkey",
        made.alias("from_parts"),
        date_from_padded("y", "m", "d").alias("from_padded"),
        date_from_parts("y", "m", F.day("o_orderdate"), on_bad_date="fail").alias("from_valid"),
        parse_compact(F.date_format("o_orderdate", "yyyyMMdd")).alias("from_compact"),
        parse_day_first(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("from_day_first"),
        utc_midnight(made).alias("wire"),
    )


@query(
    "bad_dates",
    f"""
WITH parts AS (SELECT o_orderkey, {_PARTS_SQL} FROM orders), made AS (SELECT *, {_TRY_DATE_SQL} AS made FROM parts)
SELECT y, m, count(*) AS n_rows, count(made) AS kept_by_drop, count(*) - count(made) AS null_dates,
       count(made) < count(*) AS stops_when_fail
FROM made GROUP BY y, m
""",
)
def bad_dates(spark: SparkSession, sf: str) -> DataFrame:
    """What each policy for impossible dates does, per month, as it is run.

    The policy that fails is run twice: over the months in which the others lose nothing, which it
    must get through, and over the rest, which must stop it.
    """
    rows = _order_parts(spark, sf)
    made = lambda policy: date_from_parts("y", "m", "d", on_bad_date=policy)
    months = rows.groupBy("y", "m").agg(F.count("*").alias("n_rows"), F.count_if(made("null").isNull()).alias("null_dates"))
    dropped = rows.withColumn("made", made("drop")).filter(F.col("made").isNotNull())
    kept = dropped.groupBy("y", "m").agg(F.count("*").alias("kept_by_drop"))
    counted = materialize(months.join(kept, ["y", "m"], "left").fillna(0, ["kept_by_drop"]), "months")

    def stops(bad: bool) -> bool:
        chosen = rows.join(counted.filter((F.col("null_dates") > 0) == F.lit(bad)).select("y", "m"), ["y", "m"], "left_semi")
        try:
            chosen.agg(F.count(made("fail"))).collect()
        except DateTimeException:
            return True
        return False

    stopped = F.when(F.col("null_dates") > 0, F.lit(stops(True))).otherwise(F.lit(stops(False)))
    return counted.withColumn("stops_when_fail", stopped)


@query(
    "parse_money",
    """
SELECT o_orderkey, format('S/ {:,.2f}', o_totalprice) AS written,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
FROM orders
""",
)
def money(spark: SparkSession, sf: str) -> DataFrame:
    written = F.concat(F.lit("S/ "), F.format_number(F.col("o_totalprice").cast("decimal(12,2)"), 2))
    rows = table(spark, sf, "orders").select("o_orderkey", written.alias("written"))
    return rows.withColumn("amount", parse_money("written").cast("double"))


@query(
    "month_quarter",
    """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS "Fecha" FROM orders)
SELECT row_number() OVER (ORDER BY "Fecha") AS "IdTiempo", "Fecha", CAST(year("Fecha") AS INT) AS "Anio",
       CAST(month("Fecha") AS INT) AS "Mes", CAST(day("Fecha") AS INT) AS "Dia",
       CAST(quarter("Fecha") AS INT) AS "Trimestre",
       (['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',
         'Noviembre','Diciembre'])[month("Fecha")] AS "NombreMes"
FROM days
""",
)
def month_quarter(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("Fecha"))
    return dim_time(days)[0]


_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_linestatus"


@query("dedup_exact", f"SELECT {_LINE}, l_returnflag, 2 * count(*) AS copies FROM lineitem GROUP BY ALL")
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Every line twice, once with a padded flag: cleaning comes first, so the copies fold."""
    lines = table(spark, sf, "lineitem").selectExpr(*_LINE.split(", "), "l_returnflag")
    padded = lines.withColumn("l_returnflag", F.concat(F.lit(" "), "l_returnflag", F.lit("\t")))
    return fold_duplicates(strip_all(lines.unionByName(padded)))


@query(
    "first_per_key",
    """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_partkey
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1
""",
)
def first_line(spark: SparkSession, sf: str) -> DataFrame:
    return first_per_key(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "l_partkey",
        ["l_suppkey", "l_quantity", "l_extendedprice"],
    )


@query(
    "blank_rows",
    """
WITH messy AS (SELECT doc_id, CASE lang WHEN 'de' THEN '   ' WHEN 'fr' THEN NULL ELSE source END AS source
               FROM documents)
SELECT * FROM messy WHERE source IS NULL OR trim(source, ' ') <> ''
""",
)
def blank_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Blank rows go, rows with a missing value stay."""
    messy = F.when(F.col("lang") == "de", "   ").when(F.col("lang") != "fr", F.col("source"))
    return drop_blank(table(spark, sf, "documents").select("doc_id", messy.alias("source")), "source")


@query("prefix_sample", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 1000")
def prefix_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows in source order (the sampling switch of the jobs); the table lies in order of its id."""
    return scan_prefix(table(spark, sf, "events"), 1000).select("event_id", "event_type", "value")


@query(
    "tagged_projection",
    """
SELECT 'pedidos' AS origen, CAST(o_orderkey AS VARCHAR) AS clave, o_orderkey = 42 AS es_42,
       o_orderstatus IN ('F', 'O') AS cerrado, round(o_totalprice, 1) AS total,
       CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AS reciente, o_orderpriority AS prioridad
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""",
)
def tagged_projection(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return orders.select(
        F.lit("pedidos").alias("origen"),
        F.col("o_orderkey").cast("string").alias("clave"),
        (F.col("o_orderkey") == 42).alias("es_42"),
        F.col("o_orderstatus").isin("F", "O").alias("cerrado"),
        F.round("o_totalprice", 1).alias("total"),
        (F.col("o_orderdate").cast("date") >= F.lit("1998-01-01").cast("date")).alias("reciente"),
        F.col("o_orderpriority").alias("prioridad"),
    )


@query(
    "distinct_profiles",
    """
SELECT DISTINCT CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 1000) AS BIGINT) END AS nivel,
       c_nationkey, c_mktsegment, n_name, n_regionkey
FROM customer JOIN nation ON n_nationkey = c_nationkey
""",
)
def distinct_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct combinations of five columns; an unknown level is a member."""
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    level = F.floor(drop_negative("c_acctbal") / 1000).cast("bigint")
    return rows.select(
        level.alias("nivel"), "c_nationkey", "c_mktsegment", "n_name", "n_regionkey"
    ).distinct()
