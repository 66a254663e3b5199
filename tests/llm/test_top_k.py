from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, top_k
from tests.llm.helpers import SMALL, empty, needs_tables

SHAPE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    good = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for place, (q, a) in enumerate(good):
        if q % every == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=False)), c) for at, (c, b) in enumerate(good) if at != place
            )
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE).withColumns({"row": F.lit(1), "v": F.lit("x"), "id": F.lit(2)})


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(top_k, "LEAST_CHUNK_ROWS", 1)
    rng = np.random.default_rng(chunk)
    grown = rng.normal(size=(400, 6)) * np.array([4, 3, 1, 0.3, 0.1, 0.1]) * rng.lognormal(size=(400, 1))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(grown)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # equal vectors, and queries among them
    rows += [(500, None), (520, [1.0, None]), (540, [float("nan"), 1.0]), (560, [float("-inf")]), (None, [1.0])]
    rows += [(580, [0.5, 0.5]), (600, []), (620, [0.0] * 6), (0, rows[7][1]), (640, [3.0])]
    assert result(top_k.top_k(frame(spark, rows), chunk_rows=chunk)) == brute(rows)


def test_first_chunk_is_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(top_k, "LEAST_CHUNK_ROWS", 1)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 4)
    monkeypatch.setattr(top_k, "TOGETHER", 1)
    met, seen = top_k.meet, []
    monkeypatch.setattr(top_k, "meet", lambda *a: seen.append(met(*a)) or seen[-1])
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(600, 4)))]
    assert result(top_k.top_k(frame(spark, rows), k=5, every=2, chunk_rows=50)) == brute(rows, 5, 2)
    assert seen[0].select("task").distinct().count() > 1


def test_lanes_reach_the_chunks_that_are_long_enough(spark):
    reach = [0.0, 1e-300, 0.7, 1.0, 1.0000001, 3.0, 9.0, float("inf")] + [1.0] * 40
    longest = [0.0, 0.7, 1.0, 1.0, 3.0, 8.0, 1e200]
    lanes = spark.createDataFrame(list(enumerate(reach)), "lane bigint, reach double")
    lengths = spark.createDataFrame(list(enumerate(longest)), "chunk bigint, longest double")
    found = sorted((r["lane"], r["chunk"]) for r in top_k.reached(lanes, lengths).collect())
    assert found == [(a, b) for a, x in enumerate(reach) for b, y in enumerate(longest) if y >= x]
    assert top_k.reached(lanes, lengths.limit(0)).count() == 0


def test_few_rows_and_large_numbers(spark):
    rows = [(0, [1e12, 2.0]), (20, [3e12, -1.0]), (1, [1.0, 1.0]), (2, [-1.0, 5e11])]
    plain = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert result(top_k.top_k(frame(spark, rows), k=3)) != []
    small = [(i, [x / 1e7 for x in v]) for i, v in plain]
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v in small]
    assert result(top_k.top_k(frame(spark, small))) == brute(exact)
    assert result(top_k.top_k(frame(spark, [(0, [1.0])]))) == []
    assert top_k.top_k(empty(frame(spark, rows))).count() == 0


def test_skipped_pairs_lose_nothing():
    rng = np.random.default_rng(0)
    v = np.floor(rng.normal(size=(3000, 16)) * np.geomspace(200, 0.5, 16))
    v = v[np.argsort(-np.linalg.norm(v, axis=1))]
    basis = np.linalg.eigh(v.T @ v)[1][:, ::-1]
    make = lambda x, at: top_k.Block.of(np.arange(at, at + len(x)).tobytes(), np.arange(at, at + len(x)).tobytes(), x.tobytes(), 16, basis, 2)
    asked = v[::50].copy()
    place, ids, score = top_k.best_of(make(v, 0), make(asked, 10_000), np.full(len(asked), top_k.NONE + 1), 20)
    exact = asked @ v.T
    for q in range(len(asked)):
        order = np.lexsort((np.arange(len(v)), -exact[q]))[:20]
        assert ids[place == q].tolist() == order.tolist() and score[place == q].tolist() == exact[q][order].tolist()


@needs_tables
def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert result(queries.QUERIES["op1_exact_top_k"](spark, SMALL)) == brute(rows)
