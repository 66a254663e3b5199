"""Time the headline queries on one machine and print one JSON line.

    BENCH_SF_DIR  directory of the parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_ONLY    comma-separated query names, to time a few

Every query runs whole into the no-op sink.  The two critical queries run five times and
report the least and the mean, as the source job does.  ``star_from_csv`` is the star build
from delimited text (least of three runs after a first one), the one job with a published
time; its rate is in ``star_rows_per_sec``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans.star import build_star
from millrace.queries import QUERIES
from millrace.queries.frames import flat
from millrace.session import local_session, scratch_path
from millrace.sources.readers import read_attentions
from millrace.sources.writers import write_delimited

REPEATED = ("critical_df", "critical_sql")
HEADLINE = (
    "critical_join",
    "stats_pop_quantity",
    "by_nested_desc",
    "nested_find",
    "small_cell_view",
    "lateral_apply",
    "dedup_exact",
    "first_per_key",
    "parse_dates",
    "parse_money",
    "clean_text",
    "fact_star",
    "lookup_load",
    "facility_load",
    "reject_log",
    "fact_load_first",
    "reimb_load",
    "silent_drop",
    "constraint_report",
    "audit_diff",
    "doc_build",
    "jsonl_roundtrip",
    "layout_pruned",
)


def run_whole(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(job) -> float:
    started = time.perf_counter()
    job()
    return time.perf_counter() - started


def repeated(spark: SparkSession, name: str, sf_dir: str, times: int = 5) -> dict[str, float]:
    """Least and mean of repeated timings."""
    taken = [seconds(lambda: run_whole(QUERIES[name](spark, sf_dir))) for _ in range(times)]
    rows = spark.createDataFrame([(t,) for t in taken], "t double")
    row = rows.agg(F.min("t").alias("least"), F.avg("t").alias("mean")).first()
    return {"min": round(row["least"], 4), "mean": round(row["mean"], 4)}


def star_from_csv(spark: SparkSession, sf_dir: str) -> tuple[float, int]:
    """The star build over flat records that lie in a delimited file."""
    path = scratch_path(spark, "flat-csv")
    columns = schemas.ATTENTIONS.names
    write_delimited(flat(spark, sf_dir).select(*columns), path, sep=";")

    def job() -> int:
        star = build_star(read_attentions(spark, path, text_numbers=True, source_order=True))
        return star.log.first()["FilasEntrada"]

    rows = job()
    return min(seconds(job) for _ in range(3)), rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = local_session("millrace-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    run_whole(QUERIES["critical_df"](spark, sf_dir))

    times: dict[str, float] = {}
    repeats = {}
    for name in REPEATED:
        if not only or name in only:
            repeats[name] = repeated(spark, name, sf_dir)
            times[name] = repeats[name]["min"]
    for name in HEADLINE:
        if not only or name in only:
            times[name] = round(seconds(lambda n=name: run_whole(QUERIES[n](spark, sf_dir))), 3)
            print(name, times[name], file=sys.stderr)
    rate = None
    if not only or "star_from_csv" in only:
        taken, rows = star_from_csv(spark, sf_dir)
        times["star_from_csv"] = round(taken, 3)
        rate = round(rows / taken)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "repeats": repeats,
                "star_rows_per_sec": rate,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
                "cpus": os.environ.get("BENCH_CPUS", "8"),
            }
        )
    )


if __name__ == "__main__":
    main()
