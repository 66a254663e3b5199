from __future__ import annotations

import random
import zlib

from millrace.llm import queries
from millrace.llm.zstd_language import PIECE_BYTES, fit_dictionaries, identify_languages, keep_identified, pieces
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents, rows

WORDS = {
    "aa": ["thar", "ondo", "brim", "hesk", "wold", "ern", "ift"],
    "bb": ["ciò", "llaru", "pezza", "quorno", "ñan", "desti", "uà"],
}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(WORDS[lang], k=2)) for _ in range(n))


def held_out(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 4 == 2


def corpus(spark, n=300):
    rng = random.Random(2)
    made = []
    for i in range(n):
        lang = rng.choice(["aa", "bb"])
        made.append((i, say(rng, lang, rng.randint(8, 60)), lang, "s"))
    made += [(n, None, "aa", "s"), (n + 1, "", "bb", "s"), (n + 2, "123 !? 7", "aa", "s"), (n + 3, "١٢٣", "bb", "s")]
    made += [(None, say(rng, "aa", 20), "aa", "s"), (n + 4, say(rng, "bb", 20), None, None), (5, made[5][1], made[5][2], "s")]
    made += [(n + 5, say(rng, "bb", 40_000), "bb", "s")]
    return documents(spark, made), made


def test_held_out_accuracy(spark):
    docs, made = corpus(spark)
    got = identify_languages(docs).collect()
    assert len(got) == len(made)
    truth = {(i): lang for i, text, lang, _ in made if i is not None and i < 300}
    checked = [r for r in got if r.doc_id in truth and r.held_out]
    assert len(checked) > 40 and all(r.held_out == held_out(r.doc_id) for r in got)
    assert all(r.lang_pred == truth[r.doc_id] and not r.rejected for r in checked)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[300 + i].lang_pred for i in range(6)] == ["und"] * 4 + ["bb"] * 2
    assert by_id[305].score > 0.1 and by_id[None].lang_pred == "aa" and by_id[300].rejected
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, made = corpus(spark, 200)
    wrong = documents(spark, [(i, t, "zz" if held_out(i) else lang, "other") for i, t, lang, _ in made])
    columns = ("doc_id", "lang_pred", "score")
    assert rows(identify_languages(docs), *columns) == rows(identify_languages(wrong), *columns)


def test_kept_documents_have_all_columns(spark):
    docs, made = corpus(spark, 100)
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in made} - {100, 101, 102, 103}


def test_nothing_learned(spark):
    docs = odd_documents(spark)
    got = identify_languages(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("false")).count()
    assert got == 0 and fit_dictionaries(empty(docs)) == {}
    none = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert {r.lang_pred for r in identify_languages(none).collect()} == {"und"}
    one = docs.selectExpr("doc_id", "text", "'xx' AS lang")
    assert {r.lang_pred for r in identify_languages(one).collect()} == {"und", "xx"}


def test_pieces_hold_the_whole_text():
    for data in (b"", b"a" * 10_000, b"ab " * 3000, b" " * 5000):
        cut = list(pieces(data))
        assert b"".join(cut) == data and max(map(len, cut)) <= PIECE_BYTES


@needs_tables
def test_table(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet").collect()}
    got = queries.QUERIES["op4_zstd_language"](spark, SMALL.replace("0.001", "0.01")).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(docs)
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) / len(held) > 0.95
    assert sum(r.rejected for r in got) / len(got) < 0.04
