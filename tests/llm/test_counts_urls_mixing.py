from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries
from millrace.llm.base import WORD
from millrace.llm.mixing import mix_sources
from millrace.llm.token_counts import count_tokens, lengths
from millrace.llm.url_rules import PATTERN_RULES, host_rule, judge_urls, pattern_rule
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents, rows

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


# token counts


PARTS = [*"aB1 .'\n\t_-", "\u0085", "\u00a0", "\u00e9", "e\u0301", "<|endoftext|>", "  ", "'s"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS)).map("".join))
def test_cut_texts_count_as_whole_ones(plain, text):
    assert lengths(BYTES).count([text])[0] == len(plain.encode(text, add_special_tokens=False).ids)


def test_counts_of_odd_documents(spark, plain):
    docs = odd_documents(spark)
    got = rows(count_tokens(docs, BYTES), "doc_id", "n_bytes", "n_tokens", "over_limit")
    expected = []
    for r in docs.collect():
        text = r.text or ""
        n = len(plain.encode(text, add_special_tokens=False).ids)
        expected.append((r.doc_id, len(text.encode()), n, n > 512))
    assert got == sorted(expected, key=repr)
    assert count_tokens(empty(docs), BYTES).count() == 0


def test_sentence_piece_file(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = odd_documents(spark)
    got = rows(count_tokens(docs, path), "doc_id", "n_tokens")
    assert got == sorted(((r.doc_id, len(model.encode(r.text or ""))) for r in docs.collect()), key=repr)


@needs_tables
def test_counts_of_the_table(spark, plain):
    got = {r.doc_id: r.n_tokens for r in queries.QUERIES["op10_token_counts"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert got == {r.doc_id: len(plain.encode(r.text, add_special_tokens=False).ids) for r in docs}


# URL rules


def test_rules(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.com/x"), (2, "https://EXAMPLE.com/en/a?b#c"), (3, "http://m.www.example.com/en/"),
            (4, "http://notexample.com/en/"), (5, "http://x.net/es/1"), (6, "http://x.net/ES/1"), (7, None),
            (8, "no scheme"), (9, "http://x.org?utm_source=feed"), (10, "x.com"), (11, "http://com"),
            (12, "http://com/"), (13, ""), (14, "http://net/fr/?u=http://b.com/"), (14, "http://net/fr/?u=http://b.com/"),
            (None, "http://e.org/ads/x.zip"), (15, "http://a.org/" + "p/" * 5000 + "x.exe"), (16, "http://x.net/es"),
        ],
        "page_id bigint, url string",
    ).selectExpr("*", "'h' AS host", "1 AS row", "'t' AS token", "'v' AS verdict")
    got = {(r.page_id, r.rule, r.verdict, r.pattern) for r in judge_urls(pages).collect()}
    assert judge_urls(pages).count() == 18
    assert got == {
        (1, "com/", "allow", None), (2, "example.com/en/", "block", None), (3, "www.example.com/en/", "allow", None),
        (4, "com/", "allow", None), (5, "net/es/", "block", None), (6, None, "allow", None), (7, None, "allow", None),
        (8, None, "allow", None), (9, None, "block", "feed-tracking"), (10, None, "allow", None),
        (11, None, "allow", None), (12, "com/", "allow", None), (13, None, "allow", None),
        (14, "net/fr/", "block", None), (None, None, "block", "archive-file"), (15, None, "block", "program-file"),
        (16, None, "allow", None),
    }
    host = {r.page_id: (r.host, r.path) for r in judge_urls(pages).collect()}
    assert host[2] == ("example.com", "/en/a") and host[7] == ("", "") and host[14] == ("net", "/fr/")
    assert judge_urls(empty(pages)).count() == 0
    none = judge_urls(pages, (), ()).select("verdict").distinct().collect()
    assert [r.verdict for r in none] == ["allow"]


def test_rule_without_a_whole_token_meets_every_url(spark):
    pages = spark.createDataFrame([(1, "http://q.org/englisch")], "page_id int, url string")
    assert host_rule("org/eng", "block").literals == ("org",)
    got = judge_urls(pages, (host_rule("org/eng", "block"),), (pattern_rule("any", "lisch"),)).first()
    assert (got.rule, got.verdict) == ("org/eng", "block")
    assert judge_urls(pages, (), (pattern_rule("any", "lisch"),)).first().pattern == "any"


@needs_tables
def test_urls_of_the_table(spark):
    fits = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
            ("net", "/es/", "block"), ("net", "/fr/", "block")]
    for r in queries.QUERIES["op9_url_rules"](spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/pages.parquet"), "page_id"
    ).collect():
        rest = r.url.partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        best = max(
            ((len(h + p), h + p, v) for h, p, v in fits if (host == h or host.endswith("." + h)) and path.startswith(p)),
            default=None,
        )
        hit = next((x for x in PATTERN_RULES if re.search(x.pattern, r.url.lower())), None)
        expected = (best[1], best[2]) if best else (None, "block" if hit else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *expected)


# mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return share | {s: most * sizes[s] for s in capped}
        capped |= above


def check_mix(got, docs, slack):
    n_words = {(r.doc_id, r.text, r.source): len(re.findall(WORD, r.text or "")) for r in docs}
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += n_words[r.doc_id, r.text, r.source]
    targets = brute_targets(dict(sizes))
    taken = defaultdict(int)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        by_target[round(r.target, 3)] += r.taken
    for s, t in targets.items():
        taken[round(t, 3)] += t
    for t, want in taken.items():
        assert abs(by_target[t] - want) <= slack + 1e-6
    assert len(got) == len(docs)


def test_mixing_odd_documents(spark):
    docs = odd_documents(spark)
    got = mix_sources(docs).collect()
    assert sorted(r.size for r in got) == sorted(len(re.findall(WORD, r.text or "")) for r in docs.collect())
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_sources(docs.repartition(5)).collect()), key=repr)
    assert mix_sources(empty(docs)).count() == 0


def test_mixing_skewed_sources(spark):
    rng = random.Random(3)
    docs = documents(spark, [
        (i, " ".join("abc" for _ in range(rng.randint(0, 40))), "en", rng.choice(["hot"] * 20 + ["b", "a", None, "z"]))
        for i in range(3000)
    ])
    for buckets in (4, 4096):
        check_mix(mix_sources(docs, key_buckets=buckets).collect(), docs.collect(), slack=2)


def test_heavier_documents_come_first(spark):
    docs = documents(spark, [(i, "abc def", "en", "a" if i % 2 else "b") for i in range(4000)])
    from pyspark.sql import functions as F

    got = mix_sources(docs, weights=(1, 3), quality=F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)).collect()
    b = [r for r in got if r.doc_id % 2 == 1]  # source a: half of its words
    good = sum(r.taken for r in b if r.doc_id % 4 < 2)
    assert good > 0.6 * sum(r.taken for r in b)


def brute_draw(docs, budget, seed=20):
    """Words of each document, by rising key (all of the same quality), that fit what is left."""
    key = {i: -math.log((int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)) for i in docs}
    taken = set()
    for i in sorted(docs, key=lambda i: (key[i], i)):
        if 0 < docs[i] <= budget:
            budget -= docs[i]
            taken.add(i)
    others = [(abs(budget - n), key[i], i) for i, n in docs.items() if i not in taken and n and abs(budget - n) < budget]
    return taken | {x[2] for x in sorted(others)[:1]}


@pytest.mark.parametrize("few", [0, 10_000])
def test_mixing_goes_on_past_a_document_above_the_budget(spark, monkeypatch, few):
    from pyspark.sql import functions as F

    from millrace.llm import mixing

    monkeypatch.setattr(mixing, "FINISH_ROWS", few)
    rng = random.Random(8)
    a = {i: rng.randint(1, 200) for i in range(300)}
    b = {i: rng.randint(1, 200) for i in range(300, 600)}
    first = min(a, key=lambda i: -int(hashlib.md5(f"20:{i}".encode()).hexdigest()[:13], 16))
    a[first] = 40_000
    docs = documents(spark, [(i, "abc " * n, "en", s) for s, d in (("a", a), ("b", b)) for i, n in d.items()])
    got = mix_sources(docs, weights=(1, 3), quality=F.lit(1.0)).collect()
    for d in (a, b):
        size = sum(d.values())
        target = {r.target for r in got if r.doc_id in d}.pop()
        epochs = min(int(target // size), 3)
        drawn = brute_draw(d, target - epochs * size)
        assert {r.doc_id: r.copies for r in got if r.doc_id in d} == {i: epochs + (i in drawn) for i in d}
        assert abs(sum(r.taken for r in got if r.doc_id in d) - target) <= 1


@needs_tables
def test_mixing_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = queries.QUERIES["op8_mix_sources"](spark, SMALL).collect()
    check_mix(got, docs, slack=0.05 * sum(len((r.text or "").split()) for r in docs))


def test_op8_comes_near_targets_with_documents_beyond_the_budget(spark, tmp_path):
    docs = [(i, "w " * (20_000 if i % 200 == 7 else 100 + i % 7), "en", "ab"[i % 2]) for i in range(600)]
    docs += [(None, "n " * (50 + i % 5) + str(i), "en", "ab"[i % 2]) for i in range(100)]
    documents(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op8_mix_sources"](spark, str(tmp_path)).collect()
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.SQL["op8_mix_sources"]).fetchall()
    columns = ("doc_id", "size", "source_size", "target", "taken", "copies")
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got))) == sorted(map(repr, want))
    # sources by target: each is missed by less than half of the smallest document left out
    for target in {r.target for r in got}:
        part = [r for r in got if r.target == target]
        assert abs(sum(r.taken for r in part) - target) <= 52
    none = [r.copies for r in got if r.doc_id is None]
    assert len(set(none)) > 1  # rows without an id are drawn each
