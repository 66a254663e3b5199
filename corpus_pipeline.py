"""A corpus from raw documents to token files, stage by stage.

Every stage takes what its predecessor kept, whole, and its decisions take effect on rows: all
columns of the documents go on as they are.  Rows are told apart by a key that a stage stores with
them and drops again, so rows without an id, or with the same one, are decided each.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import WORD, table, tokenizer_file, unused
from millrace.llm.decontam import find_items
from millrace.llm.minmax_dedup import near_duplicates
from millrace.llm.mixing import mix_sources
from millrace.llm.wavelet import token_digest
from millrace.llm.zstd_language import keep_identified
from millrace.operators.joins import keyed_join, measure
from millrace.session import materialize, ship_package

#: Near copies share four fifths of their runs of five words.
SHINGLE_WORDS = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The language models and the id rule have no form in SQL.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly.

    Rows without text, or without a letter, have no language and go; long texts are packed whole, in
    pieces.  Rows that repeat, or share an id, are judged each; an empty table stays empty.
    """
    return keep_identified(docs)


def with_row_key(docs: DataFrame, stage: str) -> tuple[DataFrame, str]:
    """The documents, stored with a key of each row, and the name of that column."""
    key = unused(docs.columns, "row_key")
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), stage), key


def without_rows(docs: DataFrame, key: str, out: DataFrame, out_key: str) -> DataFrame:
    """``docs`` but for the rows whose ``key`` is in ``out``, each key once there.

    Whole texts move only if the keys are measured to be too many to be sent to every task.
    """
    keys = materialize(out.select(F.col(out_key).alias(key)), "out")
    return keyed_join(docs, keys, [key], "left_anti", measure(keys), balance=False)


def row_hash(docs: DataFrame) -> Column:
    """A hash of whole rows, whatever types their columns have (maps, variants and names with dots too)."""
    return F.xxhash64(F.to_json(F.struct(*[F.col(quoted(c)) for c in docs.columns])))


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, rows without an id last.

    Rows that repeat an id are told apart by a hash of the row, equal rows by their place.  Texts
    without words are copies of one another only if they share an id and are equal.
    """
    stored, key = with_row_key(docs, "near-rows")
    name, dropped_key = unused(stored.columns, "near_id"), unused(stored.columns, "dropped_key")
    order = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), row_hash(docs).alias("hash"),
        F.col(key).alias("row"),
    )
    found = near_duplicates(stored.withColumn(name, order), shingle_words=SHINGLE_WORDS, id_col=name)
    dropped = found.filter(~F.col("kept")).select(F.col(f"{name}.row").alias(dropped_key))
    blank = stored.filter(
        F.col("doc_id").isNotNull() & ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    ).select(F.col(key).alias(dropped_key), "doc_id", "text")
    first = blank.groupBy(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).agg(
        F.min(dropped_key).alias("_first"), F.count("*").alias("_n")
    ).filter(F.col("_n") > 1)
    same = (F.col("doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text"))
    again = blank.join(first, same).filter(F.col(dropped_key) != F.col("_first")).select(dropped_key)
    return without_rows(stored, key, dropped.unionByName(again), dropped_key).select(*map(quoted, docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    A null or empty text holds no window and stays; long texts are looked through whole.  Rows that
    repeat, or share an id, are judged each; an empty table, or no benchmark items, removes nothing.
    """
    key = unused(docs.columns, "text_key")
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))  # what is decided depends on the text alone
    found = find_items(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    hit = found.filter("contaminated").select(F.col(key).alias("hit")).distinct()
    return without_rows(keyed, key, hit, "hit").select(*map(quoted, docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole epochs, and once more if drawn.

    The draw goes on past documents that do not fit.  A row without an id is drawn by its text.
    Rows without words are not taken; an empty table stays empty.
    """
    stored, key = with_row_key(docs, "mix-rows")
    name, times = (unused(stored.columns, x) for x in ("mix_key", "mix_copies"))
    mix = mix_sources(stored, row_col=key)
    copies = materialize(
        mix.filter(F.col("copies") > 0).select(F.col(key).alias(name), F.col("copies").cast("int").alias(times)),
        "mix-copies",
    )
    taken = keyed_join(stored, copies.withColumnRenamed(name, key), [key], "inner", measure(copies), balance=False)
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*map(quoted, docs.columns))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, and where in them each document lies.

    A null or empty text has its end token only; rows without an id come first, rows that share one
    follow one another by text, repeated rows are written each.  Without rows there are no shards.
    Little text at once and few remembered words: the stages before have filled the executors' memory.
    """
    return token_digest(docs, tokenizer_file("word_bpe_49k.json"), part_bytes=1 << 20, room=60_000)


def shipped(stage: Stage) -> Stage:
    """The stage, after its code was sent to the executors."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", shipped(identified)),
    ("near_dedup", shipped(deduplicated)),
    ("decontamination", shipped(decontaminated)),
    ("mixing", shipped(mixed)),
    ("tokens", shipped(tokenized)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
