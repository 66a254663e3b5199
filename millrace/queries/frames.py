"""Stand-ins for the two flat sources, derived from the benchmark tables.

Each column is one SQL expression that both engines read alike, so a Spark frame and the
matching common table expression come from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.queries.base import table

# One flat record per line item.  Names carry padding, one service is missing, some ages
# are the -1 sentinel, some days do not exist, and a facility has two spellings.
FLAT = {
    "ANIO": "cast(year(o_orderdate) as int)",
    "MES": "cast(month(o_orderdate) as int)",
    "DIA": "cast(case when l_linenumber = 7 then 31 else day(o_orderdate) end as int)",
    "CATEGORIA": "concat('I-', cast(s_nationkey % 4 + 1 as varchar(5)))",
    "RED": "r_name",
    "MICRORED": "concat('  ', n_name, ' ')",
    "CODIGO_UNICO": "cast(l_suppkey as int)",
    "NOMBRE_ESTACLECIMIENTO": "concat(s_name, case when l_linestatus = 'F' then ' A' else ' B' end)",
    "PROVINCIA": "r_name",
    "DISTRITO": "n_name",
    "EDAD_REG": "cast(case when l_tax = 0 then -1 else p_size end as int)",
    "TIPO_EDAD": "case when l_discount < 0.015 then 'D' when l_discount < 0.025 then 'M' else 'A' end",
    "SEXO": "case when l_linestatus = 'F' then 'F' else 'M' end",
    "ETNIA": "p_type",
    "TIPO_SEGURO": "l_returnflag",
    "UPS": "nullif(p_brand, 'Brand#1')",
    "ATENDIDOS": "l_linenumber",
    "ATENCIONES": "cast(l_quantity as int)",
    "FECHA_CORTE": "'20231220'",
}
SOURCE_POSITION = "l_orderkey * 8 + l_linenumber"

# The same with measures as text, some of them unreadable or negative.
TEXT_MEASURES = {
    "ATENDIDOS": "case l_linenumber when 1 then 'abc' when 2 then '-2' when 3 then null "
    "else cast(l_linenumber as varchar(5)) end",
    "ATENCIONES": "cast(cast(l_quantity as int) as varchar(5))",
    "EDAD_REG": "cast(cast(case when l_tax = 0 then -1 else p_size end as int) as varchar(5))",
}

_FLAT_FROM = """
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
"""


def _select(columns: dict[str, str]) -> str:
    return ",\n    ".join(f"{expr} AS {name}" for name, expr in columns.items())


def flat_sql(text_measures: bool = False) -> str:
    columns = {**FLAT, **(TEXT_MEASURES if text_measures else {}), "src_seq": SOURCE_POSITION}
    return f"SELECT {_select(columns)}{_FLAT_FROM}"


def flat(spark: SparkSession, sf_dir: str, text_measures: bool = False) -> DataFrame:
    columns = {**FLAT, **(TEXT_MEASURES if text_measures else {}), "src_seq": SOURCE_POSITION}
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "nation", "region")}
    joined = (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(*[F.expr(e).alias(n) for n, e in columns.items()])


# One staged record per order, with unknown values, values out of range and unknown members.
STAGED = {
    "StgId": "o_orderkey",
    "ANIO": "cast(year(o_orderdate) as int)",
    "MES": "cast(month(o_orderdate) as int)",
    "DIA": "cast(day(o_orderdate) as int)",
    "CODIGO_UNICO": "cast(o_custkey as int)",
    "EDAD_REG": "cast(case when c_acctbal < 0 then -1 else floor(o_totalprice / 4000) end as int)",
    "TIPO_EDAD": "case o_orderstatus when 'F' then 'A' when 'O' then 'D' else 'M' end",
    "SEXO": "case o_orderpriority when '4-NOT SPECIFIED' then null when '5-LOW' then 'X' "
    "when '2-HIGH' then 'M' else 'F' end",
    "ETNIA": "c_mktsegment",
    "TIPO_SEGURO": "o_orderstatus",
    "UPS": "n_name",
    "ATENDIDOS": "cast(floor(o_totalprice) % 7 - 1 as int)",
    "ATENCIONES": "cast(floor(o_totalprice) % 50 - 1 as int)",
    "FECHA_CORTE": "'20231220'",
}
STAGED_SQL = f"""SELECT {_select(STAGED)}
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
"""


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(*[F.expr(e).alias(n) for n, e in STAGED.items()])


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known facilities: customers with a balance that is not negative."""
    known = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return known.select(F.col("c_custkey").cast("int").alias("CodigoUnico"))


FACILITIES_SQL = "SELECT CAST(c_custkey AS INT) AS CodigoUnico FROM customer WHERE c_acctbal >= 0"

# Rules of the attentions load over the staged columns, as SQL.
AGE_BOUNDS_SQL = "(VALUES ('A', -1, 99), ('D', 0, 364), ('M', 0, 11)) AS bounds(unit, low, high)"
VALID_AGE_SQL = f"""EXISTS (SELECT 1 FROM {AGE_BOUNDS_SQL}
   WHERE unit = TIPO_EDAD AND EDAD_REG BETWEEN low AND high)"""
VALID_SQL = f"""SEXO IN ('F', 'M') AND {VALID_AGE_SQL}
   AND ATENDIDOS >= 0 AND ATENCIONES >= 0 AND ATENCIONES >= ATENDIDOS"""
