from __future__ import annotations

from collections import Counter

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.zstd_language import identify_languages
from tests.llm import test_decontam, test_minmax_dedup
from tests.llm.helpers import SMALL, documents, needs_tables, odd_documents
from tests.llm.test_wavelet import WORDS, brute

pytest.importorskip("public_tokenizers")


def stored(spark, df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@needs_tables
def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    kept = stored(spark, stages["language"](spark, docs, SMALL), tmp_path, "1")
    rejected = {r.doc_id for r in identify_languages(docs).filter("rejected").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - rejected

    one = stored(spark, stages["near_dedup"](spark, kept, SMALL), tmp_path, "2")
    pairs = [(r.doc_id, r.text) for r in kept.collect()]
    assert {r.doc_id for r in one.collect()} == {r[0] for r in test_minmax_dedup.brute(pairs, size=corpus_pipeline.SHINGLE_WORDS) if r[3]}

    clean = stored(spark, stages["decontamination"](spark, one, SMALL), tmp_path, "3")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = test_decontam.brute([(r.doc_id, r.text) for r in one.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in found if not r[-1]}

    mix = stored(spark, stages["mixing"](spark, clean, SMALL), tmp_path, "4")
    times = Counter(r.doc_id for r in mix.collect())
    rows = clean.collect()
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in rows}
    total = sum(len(r.text.split()) for r in rows)
    assert abs(sum(len(r.text.split()) for r in mix.collect()) - total) < 0.2 * total

    last = stages["tokens"](spark, mix, SMALL)
    from tokenizers import Tokenizer

    assert sorted(map(tuple, last.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=repr) == brute(
        mix.collect(), Tokenizer.from_file(WORDS)
    )
    for df in (kept, one, clean, mix):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes


def test_no_rows_go_through_python_workers_of_their_own(spark, tmp_path, monkeypatch):
    docs = stored(spark, documents(spark, [(i, f"word{i % 7} " * (i % 19 + 1), "en" if i % 2 else "de", "ab"[i % 2]) for i in range(80)]), tmp_path, "docs")
    stages = dict(corpus_pipeline.STAGES)
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a: pytest.fail("Python rows"))
    for name in ("language", "mixing"):
        assert stages[name](spark, docs, SMALL).columns == docs.columns


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog again and")], "item_id bigint, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd_documents(spark)
    docs = docs.withColumns({"dropped_id": docs.doc_id, "hit_id": docs.doc_id, "mix_copies": docs.text})
    one = stored(spark, corpus_pipeline.deduplicated(spark, docs, str(tmp_path)), tmp_path, "one")
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 2, 3, 4, 5, 7, 8, 9]
    mix = corpus_pipeline.mixed(spark, docs, str(tmp_path))
    assert mix.columns == clean.columns == one.columns == docs.columns
    none = documents(spark, []).limit(0)
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0




def test_map_columns_and_dotted_names(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, "no such words")], "item_id bigint, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd_documents(spark).withColumns({"x.y": F.lit("dot"), "m": F.create_map(F.lit("k"), F.lit(1))})
    docs = docs.withColumn("the `tick", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stored(spark, stage(spark, docs, str(tmp_path)), tmp_path, name)
        assert got.columns == docs.columns and got.count() > 0
    assert dict(corpus_pipeline.STAGES)["tokens"](spark, docs, str(tmp_path)).count() == docs.count()


def test_rows_with_null_or_repeated_ids_are_decided_each(spark, tmp_path):
    leak = "quick brown fox jumps over the lazy dog again and"
    benchmark = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    docs = documents(spark, [
        (None, f"the {leak} again", "en", "a"), (None, say(1), "en", "a"), (None, say(1), "en", "b"),
        (5, say(2), "en", "a"), (5, say(2) + " more", "en", "a"), (5, f"a {leak} b", "en", "b"), (5, say(3), "en", "a"),
        (9, say(4), "en", "a"), (None, say(4), "en", "a"), (3, " ", "en", "a"), (3, " ", "en", "a"),
    ])
    clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in clean.collect()) == sorted(
        (r.doc_id or 0, r.text) for r in docs.collect() if leak not in r.text
    )
    one = corpus_pipeline.deduplicated(spark, docs, str(tmp_path)).collect()
    got = sorted((r.doc_id or 0, r.text.split()[0] if r.text.strip() else "") for r in one)
    assert got == [(0, "the"), (0, "w1x0"), (3, ""), (5, "a"), (5, "w2x0"), (5, "w3x0"), (9, "w4x0")]


def test_mixed_rows_without_an_id_keep_to_the_targets(spark):
    docs = documents(spark, [
        (None if i % 3 == 0 else i, f"doc{i} " + "abc " * (i % 17), "en", "ab"[i % 2]) for i in range(600)
    ])
    words = lambda df, s: sum(len(r.text.split()) for r in df.collect() if r.source == s)
    size = {s: words(docs, s) for s in "ab"}
    mix = corpus_pipeline.mixed(spark, docs, "")
    for s, weight in (("a", 1), ("b", 2)):
        assert abs(words(mix, s) - sum(size.values()) * weight / 3) <= 1
    none = Counter(r.text for r in mix.collect() if r.doc_id is None and r.source == "a")
    assert 0 < len(none) < 100
