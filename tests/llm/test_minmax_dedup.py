from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import minmax_dedup, queries
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents, rows

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def shingles(text, size=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def brute(docs, percent=80, size=4):
    sets = [shingles(t, size) for _, t in docs]
    found = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            found[x].append(i)
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in found[x] if j < i}:
            both = len(s & sets[j])
            if docs[i][0] is not None and docs[j][0] is not None and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[top(i)].append(d)
    out = []
    for i, (d, _) in enumerate(docs):
        c = d if d is None else min(x for x in least[top(i)] if x is not None)
        out.append((d, len(sets[i]), c, c == d))
    return sorted(out, key=repr)


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else f"new{rng.random()}" for w in text.split())


@pytest.mark.parametrize("small", [2, 16])
def test_families_of_copies(spark, small):
    rng = random.Random(small)
    say = lambda n: " ".join(f"w{rng.randint(0, 500)}" for _ in range(n))
    texts = []
    for _ in range(12):
        base = say(rng.choice([3, 4, 6, 30, 120, 400]))
        chain = base
        for _ in range(rng.randint(1, 12)):
            texts += [base, edited(rng, base, rng.choice([0.0, 0.01, 0.03, 0.06])), chain]
            chain = edited(rng, chain, 0.02)
    common = say(60)  # passages that unrelated texts share
    texts += [common + " " + say(rng.randint(5, 60)) for _ in range(60)]
    texts += [say(rng.randint(1, 50)) for _ in range(60)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = [(i, t) for i, t in zip(order, texts, strict=True)]
    got = minmax_dedup.near_duplicates(documents(spark, [(*d, "en", "a") for d in docs]), small_bucket=small)
    assert rows(got, *COLUMNS) == brute(docs)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert rows(minmax_dedup.near_duplicates(docs), *COLUMNS) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert minmax_dedup.near_duplicates(empty(docs)).count() == 0
    blank = documents(spark, [(1, None, None, None), (2, " ", None, None), (3, "", None, None)])
    assert rows(minmax_dedup.near_duplicates(blank), *COLUMNS) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_repeated_ids_with_other_texts(spark):
    long = " ".join(map(str, range(100)))
    docs = [(5, "a b c d e"), (5, long), (9, long + " more"), (9, "x y z"), (7, "X  y z")]
    got = rows(minmax_dedup.near_duplicates(documents(spark, [(*d, "en", "a") for d in docs])), *COLUMNS)
    assert got == brute(docs)


def test_values_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    hits = []
    for _ in range(200):
        items = np.unique(rng.integers(0, 1 << 63, 240).astype(np.uint64))
        a, b = items[:200], items[40:]  # 160 of 240 in common
        factor, shift = minmax_dedup.permutations(48)
        x, y = a[:, None] * factor + shift, b[:, None] * factor + shift
        hits.append(np.concatenate([x.min(0) == y.min(0), x.max(0) == y.max(0)]).mean())
    assert np.mean(hits) == pytest.approx(160 / 240, abs=0.02)


@needs_tables
def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows(queries.QUERIES["op3_minmax_dedup"](spark, SMALL), *COLUMNS) == brute(docs)


def test_large_families_are_not_compared_all_with_all(spark, monkeypatch):
    """Members share three fifths with one another; a few pairs are linked.  Links are kept, and the
    pairs that come to a comparison are few."""
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(60)]
    docs = []
    for i in range(120):
        own = [f"w{i}x{j}" for j in range(18)]
        docs.append((2 * i, " ".join(shared + own)))
        if i % 10 == 0:
            docs.append((2 * i + 1, " ".join(shared + own[:-2] + [f"z{rng.random()}"])))
    made = []
    real = minmax_dedup.prefix_pairs
    monkeypatch.setattr(minmax_dedup, "prefix_pairs", lambda *a: made.append(real(*a)) or made[-1])
    counted = []
    monkeypatch.setattr(minmax_dedup, "release", lambda *frames: counted.extend(
        f.count() for f in frames if made and f is made[-1]))
    df = documents(spark, [(i, t, "en", "a") for i, t in docs])
    assert rows(minmax_dedup.near_duplicates(df, small_bucket=4), *COLUMNS) == sorted(brute(docs), key=repr)
    assert counted and counted[0] < 400
