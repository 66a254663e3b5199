"""Filtered aggregates, suppressed views, statistics, top rows, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import div
from millrace.functions.text import byte_length, concat_blank
from millrace.operators.aggregates import (
    count_conditions,
    critical_query,
    critical_query_by_lookup,
    critical_query_sql,
    describe_population,
    merged_moments,
    partial_moments,
)
from millrace.operators.bounds import part_of, with_parts
from millrace.operators.joins import top_per_outer_row
from millrace.operators.keys import dense_ids
from millrace.operators.quality import reconcile
from millrace.plans.documents import build_documents, find, flatten, totals_by_province
from millrace.plans.reimbursements import published_view
from millrace.queries.base import query, table
from millrace.queries.frames import flat, flat_sql
from millrace.schemas import INT
from millrace.session import materialize, scratch_path
from millrace.sources.readers import read_layout
from millrace.sources.writers import write_bucketed, write_layout

LINE_PARTS = [part_of("Anio", INT, "l_shipdate", "year"), part_of("Mes", INT, "l_shipdate", "month")]
_LINE_SUMS = {"TotalAtendidos": "l_linenumber", "TotalAtenciones": "cast(l_quantity AS BIGINT)"}
_LINE_RANGE = ("l_returnflag", "R", "l_shipdate", "1996-01-01", "1996-01-31")
_LINE_SQL = """
SELECT l_returnflag, count(*) AS Registros,
       CAST(sum(l_linenumber) AS BIGINT) AS TotalAtendidos,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS TotalAtenciones
FROM lineitem
WHERE l_returnflag = 'R' AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-31'
GROUP BY l_returnflag
"""


def _line_sums() -> dict:
    return {"TotalAtendidos": F.col("l_linenumber"), "TotalAtenciones": F.col("l_quantity").cast("bigint")}


@query("critical_df", _LINE_SQL)
def critical_df(spark: SparkSession, sf: str) -> DataFrame:
    return critical_query(table(spark, sf, "lineitem"), *_LINE_RANGE, _line_sums())


@query("critical_sql", _LINE_SQL)
def critical_sql(spark: SparkSession, sf: str) -> DataFrame:
    return critical_query_sql(table(spark, sf, "lineitem"), *_LINE_RANGE, _LINE_SUMS)


@query(
    "critical_join",
    """
SELECT c_mktsegment AS segmento, count(*) AS Registros,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS Total
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE c_mktsegment = 'BUILDING' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
GROUP BY c_mktsegment
""",
)
def critical_join(spark: SparkSession, sf: str) -> DataFrame:
    return critical_query_by_lookup(
        table(spark, sf, "orders"),
        table(spark, sf, "customer"),
        fact_key="o_custkey",
        lookup_key="c_custkey",
        name="c_mktsegment",
        value="BUILDING",
        date="o_orderdate",
        start="1996-01-01",
        end="1996-12-31",
        sums={"Total": F.col("o_totalprice").cast("decimal(12,2)")},
        name_as="segmento",
    ).withColumn("Total", F.col("Total").cast("double"))


def _normalised(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    flags, _ = dense_ids(lines.select("l_returnflag").distinct(), ["l_returnflag"], "flag_id")
    return lines.join(flags, "l_returnflag").drop("l_returnflag"), flags


@query(
    "equivalence",
    f"""
WITH one AS ({_LINE_SQL})
SELECT f.forma, one.* FROM one CROSS JOIN (VALUES ('dataframe'), ('lookup'), ('sql')) f(forma)
""",
)
def equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """The critical question in its three forms; all rows must agree."""
    lines = table(spark, sf, "lineitem")
    key, value, date, start, end = _LINE_RANGE
    fact, flags = _normalised(lines)
    by_lookup = critical_query_by_lookup(
        fact, flags, "flag_id", "flag_id", key, value, date, start, end, _line_sums()
    )
    forms = {
        "dataframe": critical_query(lines, *_LINE_RANGE, _line_sums()),
        "sql": critical_query_sql(lines, *_LINE_RANGE, _LINE_SUMS),
        "lookup": by_lookup,
    }
    tagged = [df.withColumn("forma", F.lit(name)) for name, df in forms.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


_STATS_SQL = """
SELECT count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stddev,
       min({c}) AS min, max({c}) AS max
FROM {t} WHERE {c} >= 0
"""


def _stats(df: DataFrame, c: str) -> DataFrame:
    out = describe_population(df, c)
    return out.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("stats_pop", _STATS_SQL.format(c="c_acctbal", t="customer"))
def stats_pop(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(table(spark, sf, "customer"), "c_acctbal")


@query("stats_pop_quantity", _STATS_SQL.format(c="l_quantity", t="lineitem"))
def stats_pop_quantity(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(table(spark, sf, "lineitem"), "l_quantity")


@query("stats_merged", _STATS_SQL.format(c="l_quantity", t="lineitem"))
def stats_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of all lines from stored partial sums per month, halves of which came in two loads."""
    lines = table(spark, sf, "lineitem")
    month = {"Anio": F.year("l_shipdate"), "Mes": F.month("l_shipdate")}
    first = partial_moments(lines.filter("l_linenumber <= 3"), "l_quantity", month)
    later = partial_moments(lines.filter("l_linenumber > 3"), "l_quantity", month)
    out = merged_moments(materialize(first.unionByName(later), "moments"))
    return out.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query(
    "table_function",
    """
SELECT c_custkey, c_name, n_orders, total, last_order FROM customer, LATERAL (
  SELECT count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
         CAST(max(o_orderdate) AS DATE) AS last_order FROM orders WHERE o_custkey = c_custkey) x
""",
)
def table_function(spark: SparkSession, sf: str) -> DataFrame:
    """A summary written once as a table function in SQL, applied to each customer."""
    table(spark, sf, "customer").select("c_custkey", "c_name").createOrReplaceTempView("resumen_cliente")
    table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate").createOrReplaceTempView("resumen_pedido")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION resumen_pedidos(cliente BIGINT)
        RETURNS TABLE (n_orders BIGINT, total DOUBLE, last_order DATE)
        RETURN SELECT count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE), CAST(max(o_orderdate) AS DATE)
               FROM resumen_pedido WHERE o_custkey = cliente
    """)
    return spark.sql("""
        SELECT c_custkey, c_name, r.n_orders, r.total, r.last_order
        FROM resumen_cliente, LATERAL resumen_pedidos(c_custkey) AS r
    """)


@query(
    "by_nested_desc",
    f"""
WITH flat AS ({flat_sql()})
SELECT PROVINCIA AS provincia, CAST(sum(ATENCIONES) AS BIGINT) AS "totalAtenciones",
       CAST(sum(ATENDIDOS) AS BIGINT) AS "totalAtendidos"
FROM flat GROUP BY PROVINCIA ORDER BY 2 DESC, 1
""",
)
def by_nested_desc(spark: SparkSession, sf: str) -> DataFrame:
    return totals_by_province(build_documents(flat(spark, sf).drop("src_seq")))


@query(
    "nested_find",
    f"""
WITH flat AS ({flat_sql()})
SELECT TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', ANIO, MES, DIA) AS DATE) AS fecha,
       NOMBRE_ESTACLECIMIENTO AS establecimiento_nombre, SEXO AS paciente_sexo,
       coalesce(UPS, '') AS ups, CAST(ATENCIONES AS BIGINT) AS atenciones
FROM flat WHERE TIPO_SEGURO = 'R' AND PROVINCIA = 'ASIA'
""",
)
def nested_find(spark: SparkSession, sf: str) -> DataFrame:
    docs = build_documents(flat(spark, sf).drop("src_seq"))
    found = find(
        docs,
        {"paciente.seguro": "R", "establecimiento.provincia": "ASIA"},
        ["fecha", "establecimiento.nombre", "paciente.sexo", "ups", "atenciones"],
    )
    return flatten(found)


@query(
    "small_cell_view",
    """
SELECT n_name AS Region, s_name AS Sede, l_returnflag AS TipoAtencion,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS Periodo,
       CAST(sum(l_linenumber) AS BIGINT) AS TotalAsegurados,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS TotalSolicitudes,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS TotalMontoPagado
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
GROUP BY ALL HAVING sum(l_linenumber) >= 5
""",
)
def small_cell_view(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    kinds, _ = dense_ids(
        lines.select(F.col("l_returnflag").alias("Nombre")).distinct(), ["Nombre"], "TipoAtencionId"
    )
    fact = lines.join(kinds, F.col("l_returnflag") == F.col("Nombre")).select(
        F.col("l_suppkey").alias("SedeId"),
        "TipoAtencionId",
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("Periodo"),
        F.col("l_linenumber").alias("NumeroAsegurados"),
        F.col("l_quantity").cast("bigint").alias("SolicitudesReembolso"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("MontoPagado"),
    )
    offices = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("SedeId"),
        F.col("s_nationkey").alias("RegionId"),
        F.col("s_name").alias("Nombre"),
    )
    regions = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("RegionId"), F.col("n_name").alias("Nombre")
    )
    view = published_view(fact, offices, regions, kinds, k=5)
    return view.withColumn("TotalMontoPagado", F.col("TotalMontoPagado").cast("double"))


@query(
    "count_conditions",
    """
SELECT count(*) AS n_rows, count(*) FILTER (c_acctbal < 0) AS negative_balance,
       count(*) FILTER (TRY_CAST(format('2001-{:02d}-31', c_nationkey % 12 + 1) AS DATE) IS NULL) AS bad_dates
FROM customer
""",
)
def conditions(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    text = F.format_string("2001-%02d-31", F.col("c_nationkey") % 12 + 1)
    return count_conditions(
        customers,
        {
            "negative_balance": F.col("c_acctbal") < 0,
            "bad_dates": F.try_to_date(text, "yyyy-MM-dd").isNull(),
        },
    )


@query(
    "top_n_latest",
    """
SELECT event_id, user_id, event_type, value FROM events
WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 10
""",
)
def top_n_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").filter(F.col("event_type") == "error")
    return events.orderBy(F.desc("event_id")).limit(10).select("event_id", "user_id", "event_type", "value")


@query(
    "multi_key_sort",
    """
SELECT p_brand, p_type, p_name, count(*) AS n FROM part
WHERE p_type IN ('ECONOMY', 'PROMO') GROUP BY ALL ORDER BY p_brand, p_type, p_name
""",
)
def multi_key_sort(spark: SparkSession, sf: str) -> DataFrame:
    chosen = table(spark, sf, "part").filter(F.col("p_type").isin("ECONOMY", "PROMO"))
    counted = chosen.groupBy("p_brand", "p_type", "p_name").agg(F.count("*").alias("n"))
    return counted.orderBy("p_brand", "p_type", "p_name")


@query(
    "lateral_apply",
    """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer, LATERAL (
  SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) x
""",
)
def lateral_apply(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = top_per_outer_row(
        customers, orders, "c_custkey", "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")]
    )
    return best.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    "like_case_div",
    """
SELECT p_partkey, p_name LIKE '%ring%' AS has_ring,
       CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 3 ELSE 2 END AS size_class,
       CAST(CAST(floor(p_retailprice) AS BIGINT) // p_size AS BIGINT) AS per_unit,
       substring(p_name, (p_size // 10) + 1, 4) AS piece,
       CAST(2 * length(p_name) AS INT) AS stored_bytes,
       concat(p_size, '/', coalesce(nullif(p_brand, 'Brand#1'), '')) AS tag,
       coalesce(nullif(p_brand, 'Brand#1'), 'none') AS brand
FROM part
""",
)
def like_case_div(spark: SparkSession, sf: str) -> DataFrame:
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    kind = F.col("p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_name").like("%ring%").alias("has_ring"),
        F.when(kind == "SMALL", 1).when(kind == "LARGE", 3).otherwise(2).alias("size_class"),
        div(F.col("p_retailprice").try_cast("bigint"), "p_size").alias("per_unit"),
        F.substring("p_name", (div("p_size", F.lit(10)) + 1).cast("int"), F.lit(4)).alias("piece"),
        byte_length("p_name").alias("stored_bytes"),
        concat_blank("p_size", F.lit("/"), brand).alias("tag"),
        F.coalesce(brand, F.lit("none")).alias("brand"),
    )


@query("layout_pruned", _LINE_SQL)
def layout_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Write line items by year and month, sorted by flag and date, then ask of the layout.

    The layout declares that year and month are parts of the date, so the bounds of the query open
    one directory.
    """
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_linenumber", "l_quantity")
    parts = with_parts(lines, LINE_PARTS)
    path = scratch_path(spark, "layout")
    write_layout(parts, path, ["Anio", "Mes"], ["l_returnflag", "l_shipdate"])
    return critical_query(read_layout(spark, path, parts.schema), *_LINE_RANGE, _line_sums())


@query(
    "bucketed_join",
    """
SELECT o_orderkey, o_orderpriority, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
       max(l_shipdate)::DATE AS last_shipped
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderpriority
""",
)
def bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and their lines, bucketed and sorted by order: joined and grouped where they lie."""
    return joined_in_place(
        table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
        table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate"),
    )


def joined_in_place(orders: DataFrame, lines: DataFrame, buckets: int = 16) -> DataFrame:
    spark = orders.sparkSession
    tables = []
    for kind, df, key in (("orders", orders, "o_orderkey"), ("lines", lines, "l_orderkey")):
        path = scratch_path(spark, kind)
        tables.append(write_bucketed(df, f"millrace_{kind}_{path[-32:]}", path, [key], buckets))
    left, right = tables
    both = left.join(right.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return both.groupBy("o_orderkey", "o_orderpriority").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").cast("double").alias("quantity"),
        F.max("l_shipdate").cast("date").alias("last_shipped"),
    )


@query(
    "recon_counts",
    """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lineitem,
       (SELECT count(*) FROM customer) AS customer, (SELECT max(o_orderkey) FROM orders) AS last_id
""",
)
def recon_counts(spark: SparkSession, sf: str) -> DataFrame:
    frames = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    last = frames["orders"].agg(F.max("o_orderkey").alias("last_id"))
    return reconcile(frames).crossJoin(last)
