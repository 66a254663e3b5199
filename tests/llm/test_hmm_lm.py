from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import hmm_lm, queries
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


def check_base(got, docs):
    counts = Counter(t for i, text in docs if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (i, held(i), len(ts := tokens(text)), sum(t in counts for t in ts), n,
             sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
            for i, text in docs
        ),
        key=repr,
    )
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    assert [r[:5] for r in rows] == [e[:5] for e in expected]
    assert [r[5] for r in rows] == pytest.approx([e[5] for e in expected], rel=1e-9, abs=1e-6)


def toy(states, classes, seed):
    rng = np.random.default_rng(seed)
    part = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape) + 0.05)
    return hmm_lm.Model(0, 0, (), np.ones(classes), part(states), part(states, states), part(states, classes).T.copy())


def every_path(seq, model):
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:], strict=False):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


def test_recursions_against_all_paths():
    model = toy(3, 4, 1)
    seqs = [[0, 1, 2, 3, 1], [2], [3, 3], [1, 0, 1, 2]]
    flat, lengths = np.array([x for s in seqs for x in s], np.int32), np.array([len(s) for s in seqs])
    logs = [math.log(sum(p for _, p in every_path(s, model))) for s in seqs]
    assert hmm_lm.log_likelihoods(flat, lengths, model) == pytest.approx(logs)
    starts, moves, emits, fit = hmm_lm.expected_counts(flat, lengths, model)
    s2, m2, e2 = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s, log in zip(seqs, logs, strict=True):
        for path, p in every_path(s, model):
            w = p / math.exp(log)
            s2[path[0]] += w
            for a, b in zip(path, path[1:], strict=False):
                m2[a, b] += w
            for x, k in zip(s, path, strict=True):
                e2[x, k] += w
    assert fit == pytest.approx(sum(logs))
    np.testing.assert_allclose(starts, s2)
    np.testing.assert_allclose(moves, m2)
    np.testing.assert_allclose(emits, e2)


def test_very_long_sequence_does_not_vanish():
    model = toy(4, 50, 2)
    seq = np.random.default_rng(3).integers(0, 50, 30_000).astype(np.int32)
    got = hmm_lm.log_likelihoods(seq, np.array([len(seq)]), model)[0]
    state, log = model.start * model.emit[seq[0]], 0.0
    for x in seq[1:]:
        log += math.log(state.sum())
        state = (state / state.sum()) @ model.move * model.emit[x]
    assert got == pytest.approx(log + math.log(state.sum()))


def one_by_one(seq, model):
    """Forward and backward of one sequence, scaled at every step."""
    ahead, scales = [], []
    for t, x in enumerate(seq):
        state = (ahead[-1] @ model.move if t else model.start) * model.emit[x]
        scales.append(state.sum())
        ahead.append(state / scales[-1])
    behind, moves, emits = np.ones(len(model.start)), np.zeros_like(model.move), np.zeros_like(model.emit)
    for t in range(len(seq) - 1, -1, -1):
        emits[seq[t]] += ahead[t] * behind
        if t:
            weighted = model.emit[seq[t]] * behind / scales[t]
            moves += model.move * np.outer(ahead[t - 1], weighted)
            behind = model.move @ weighted
        else:
            starts = ahead[0] * behind
    return starts, moves, emits, np.log(scales).sum()


@pytest.mark.parametrize("least", [1.0, 1e-12])
def test_recursions_over_many_lengths(least):
    model = toy(3, 6, 4)
    model.emit[3:] *= least  # rare words, rare ways
    model.move[0, 1:] *= least
    rng = np.random.default_rng(5)
    seqs = [rng.integers(0, 6, n) for n in (1, 7, 8, 9, 200, 16, 17, 1, 64, 8)]
    flat, lengths = np.concatenate(seqs).astype("<u2"), np.array([len(s) for s in seqs])
    expected = [one_by_one(s, model) for s in seqs]
    np.testing.assert_allclose(hmm_lm.log_likelihoods(flat, lengths, model), [e[3] for e in expected])
    for got, parts in zip(hmm_lm.expected_counts(flat, lengths, model), zip(*expected, strict=True), strict=True):
        np.testing.assert_allclose(got, np.sum(parts, 0), rtol=1e-9, atol=1e-12)


def test_runs_and_windows_hold_every_token():
    texts = [np.arange(n, dtype="<u2") for n in (1, 1023, 1024, 1025, 5000, 2)]
    runs = list(hmm_lm.class_numbers(pa.array([x.tobytes() for x in texts], pa.binary()), 2000))
    assert [(a, b) for a, b, _, _ in runs] == [(0, 3), (3, 5), (5, 6)]
    np.testing.assert_array_equal(np.concatenate([x for _, _, x, _ in runs]), np.concatenate(texts))
    cut = [hmm_lm.windows(lengths).tolist() for _, _, _, lengths in runs]
    assert cut == [[1, 1023, 1024], [1024, 1, 1024, 1024, 1024, 1024, 904], [2]]


def test_texts_are_read_for_counts_and_once_more(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    docs = documents(spark, [(i, f"a b a c w{i} " * (i % 7 + 1), "en", "s") for i in range(40)])
    got = hmm_lm.score_documents(docs.withColumn("text", counted("text")), rounds=2, head_words=3, tail_classes=4).collect()
    check_base(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert read.value == sum(not held(i) for i in range(40)) + 40


@pytest.mark.parametrize("head", [2, 1000])
def test_odd_documents(spark, head):
    docs = odd_documents(spark)
    got = hmm_lm.score_documents(docs, rounds=2, head_words=head, tail_classes=8).collect()
    check_base(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm_lm.score_documents(empty(docs), rounds=1).count() == 0


@pytest.mark.parametrize("most", [0, hmm_lm.HASHED_BYTES])
def test_words_are_hashed_only_if_they_fit(spark, monkeypatch, most):
    monkeypatch.setattr(hmm_lm, "HASHED_BYTES", most)
    docs = documents(spark, [(i, f"a b w{i % 9} w{i % 4} a", "en", "s") for i in range(30)])
    counts = hmm_lm.word_counts(docs.select("text"))
    joined = docs.select(F.lit(b"a").alias("word")).join(hmm_lm.looked_up(counts), "word")
    assert ("shuffle_hash" in joined._jdf.queryExecution().logical().toString()) == (most > 0)
    check_base(
        hmm_lm.score_documents(docs, rounds=1, head_words=3, tail_classes=4).collect(),
        [(r.doc_id, r.text) for r in docs.collect()],
    )


def test_nothing_to_learn_from(spark):
    out = next(i for i in range(50) if held(i))
    got = hmm_lm.score_documents(documents(spark, [(out, "some words", "en", "a")]), rounds=1).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]
    assert math.isfinite(got[0].score)


def test_rounds_raise_the_likelihood_and_one_state_is_the_base(spark):
    docs = documents(spark, [(i, "a b a c " * (i % 7 + 1) if i % 2 else "x y z x " * (i % 5 + 1), "en", "s") for i in range(60)])
    text = docs.select("text")
    counts = hmm_lm.word_counts(text).cache()
    _, fits = hmm_lm.fit_model(text, counts, states=2, rounds=6, head_words=50, tail_classes=4)
    assert fits[-1] > fits[0]
    got = hmm_lm.score_documents(docs, states=1, rounds=1, head_words=50, tail_classes=1).collect()
    assert [r.score for r in got] == pytest.approx([r.base_score for r in got], rel=2e-3)
    two = hmm_lm.score_documents(docs, states=2, rounds=6, head_words=50, tail_classes=1).collect()
    assert sum(r.score for r in two if r.held_out) > 0.8 * sum(r.base_score for r in two if r.held_out)


def test_probabilities_of_short_texts_add_up(spark):
    docs = documents(spark, [(i, ["a", "b a", "b", "", "c"][i % 5], "en", "s") for i in range(40)])
    text = docs.select("text")
    counts = hmm_lm.word_counts(text).cache()
    model, _ = hmm_lm.fit_model(text, counts, states=2, rounds=2, head_words=3, tail_classes=2)
    np.testing.assert_allclose(model.emit.sum(0), 1)
    np.testing.assert_allclose(model.move.sum(1), 1)
    sizes = {len(model.head) + i: m for i, m in enumerate(model.tail_mass)}
    known = {bytes(r.word): r.c for r in counts.collect()}
    heads = {w for w, _ in model.head}
    for b in range(2):  # within a tail class: its words and one place for the unknown
        total = sum(c + 1 for w, c in known.items() if w not in heads and zlib.crc32(w) % 2 == b) + 1
        assert total == sizes[len(model.head) + b]


@needs_tables
def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.QUERIES["op2_hmm_lm"](spark, SMALL).collect()
    check_base(got, docs)
    out = [r for r in got if r.held_out]
    print(sum(r.score for r in out), sum(r.base_score for r in out))
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
