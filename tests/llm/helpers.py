"""Small tables with everything that may come, and brute-force helpers."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="benchmark tables are not here")

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size string, row bigint, id string"


def documents(spark, rows):
    """``(doc_id, text, lang, source)`` rows, with extra columns whose names may clash."""
    return spark.createDataFrame([(*r, None, 0.5, "x", 1, "y") for r in rows], DOCS)


def odd_documents(spark):
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    return documents(spark, [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \t\n ", "de", None),
        (5, long, "en", "b"),
        (6, "The quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (6, "The quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (None, "no id here but words", None, "c"),
        (7, "one", "en", "b"),
        (8, "Ünïcödé   naïve\x0bwords <|endoftext|> 12345 \U0001f600", "fr", "c"),
        (9, "nul \x00 byte", "es", "c"),
    ])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def empty(df):
    return df.filter(F.lit(False))
