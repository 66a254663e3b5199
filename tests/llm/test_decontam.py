from __future__ import annotations

import hashlib
import random
import re

from millrace.llm import queries
from millrace.llm.decontam import find_items
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents, rows

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in wanted}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                owners = wanted.get(tuple(w[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in owners if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS key", "'w' AS words")


def test_random_texts(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["a", "B", "c", "é", "9"]) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 3, 4, 12]))) for i in range(30)]
    items += [(31, None), (None, say(4)), (3, items[3][1]), (9, "zz, Yy. zz"), (10, "q")]
    texts = [(i, say(rng.randint(0, 60)), "en", "a") for i in range(200)]
    texts += [(300 + i, "x " * i + items[3][1] + "! q", "en", "a") for i in range(4)] + [(400, "ZZ yy zz", None, None)]
    docs = documents(spark, texts)
    got = rows(find_items(docs, items_frame(spark, items)), *COLUMNS)
    assert got == brute([t[:2] for t in texts], items)


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    items = [(1, "the quick brown fox jumps over the lazy dog again"), (2, "word5 word6 word7 " * 4), (22, "one"), (3, "12345")]
    items += [(4, " ".join(f"word{i}" for i in range(40, 80)))]
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(find_items(docs, items_frame(spark, items)), *COLUMNS) == brute(plain, items)
    none = items_frame(spark, items).limit(0)
    assert rows(find_items(docs, none), *COLUMNS) == brute(plain, [])
    assert find_items(empty(docs), items_frame(spark, items)).count() == 0


@needs_tables
def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = rows(queries.QUERIES["op7_decontaminate"](spark, SMALL), *COLUMNS)
    assert got == brute(docs, items) and any(r[-1] for r in got)


def test_jobs_hold_few_bytes_at_once(spark, monkeypatch):
    from millrace.llm import decontam

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, store = spark.conf.get(name), decontam.materialize
    monkeypatch.setattr(decontam, "materialize", lambda df, *a: (seen.append(spark.conf.get(name)), store(df, *a))[1])
    docs = documents(spark, [(1, "one two three", "en", "a"), (2, "four", "en", "a")])
    got = find_items(docs, items_frame(spark, [(1, "two three")]))
    assert rows(got, "doc_id", "n_hit") == [(1, 2), (2, 0)]
    assert seen and {int(x.rstrip('b')) for x in seen} == {4 << 20} and spark.conf.get(name) == before
