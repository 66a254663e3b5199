from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, vp_tree
from tests.llm.helpers import SMALL, empty, needs_tables

SHAPE = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def brute(rows, k=20, every=20):
    good = [
        (i, v) for i, v in plain(rows)
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for place, (q, a) in enumerate(good):
        if q % every == 0:
            scored = []
            for at, (c, b) in enumerate(good):
                if at != place:
                    s = 0.0
                    for x, y in zip(a, b, strict=False):
                        s += x * y
                    scored.append((-s, c))
            out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE).withColumns(
        {"row": F.lit(1), "v": F.lit("x"), "id": F.lit(2), "region": F.lit(3), "a.b": F.lit(4),
         "map": F.create_map(F.lit("k"), F.lit(1))}
    )


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def grouped(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 3
    return centres[rng.integers(12, size=n)] + rng.normal(size=(n, width)) * 0.3 + rng.lognormal(size=(n, 1)) * 0.1


@pytest.mark.parametrize("shard", [16, 10_000])
def test_factor_one_is_exact(spark, monkeypatch, shard):
    monkeypatch.setattr(vp_tree, "LEAST_SHARD_ROWS", 1)
    monkeypatch.setattr(vp_tree, "LEAF_ROWS", 4)
    monkeypatch.setattr(vp_tree, "QUERY_ROWS", 5)
    v = grouped(500, 6, 1)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(500 + i, rows[3][1]) for i in range(70)]  # equal vectors, queries among them
    rows += [(600, None), (620, [1.0, None]), (640, [float("nan"), 1.0]), (660, [float("-inf")]), (None, [1.0])]
    rows += [(680, [0.5, 0.5]), (700, []), (720, [0.0] * 6), (0, rows[7][1]), (740, [3.0]), (40, rows[9][1])]
    assert result(vp_tree.nearest(frame(spark, rows), factor=1.0, shard_rows=shard)) == brute(rows)


def test_whole_numbers_tie_by_id(spark, monkeypatch):
    monkeypatch.setattr(vp_tree, "LEAST_SHARD_ROWS", 1)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.integers(-1, 2, size=5)]) for i in rng.permutation(300)]
    assert result(vp_tree.nearest(frame(spark, rows), k=7, factor=1.0, shard_rows=32)) == brute(rows, 7)


def test_few_rows_and_extremes(spark):
    rows = [(0, [1e30, 2.0]), (20, [3e30, -1.0]), (1, [1.0, 1.0]), (2, [-1e-30, 5e-30])]
    assert result(vp_tree.nearest(frame(spark, rows), k=3, factor=1.0)) == brute(rows, 3)
    assert result(vp_tree.nearest(frame(spark, [(0, [1.0])]))) == []
    assert vp_tree.nearest(empty(frame(spark, rows))).count() == 0


def test_larger_factors_look_at_less_and_keep_recall():
    both = grouped(8060, 8, 3)
    v, q = both[:8000], both[8000:]
    longest = float(np.linalg.norm(v, axis=1).max())
    tree, order = vp_tree.Tree.grow(vp_tree.lifted(v, longest), 6)
    shard = {"rows": order, "ids": order, "v": v[order]}
    asked = {"q": q, "points": vp_tree.pointing(q), "length": np.linalg.norm(q, axis=1), "floor": np.full(60, -np.inf)}
    exact = [set(np.argsort(-s)[:20].tolist()) for s in q @ v.T]
    recall, looked = [], []
    tuned = vp_tree.tuned_factor(v[:4000], 20, longest, 0.95)
    for factor in (1.0, tuned, 8.0):
        place, row, _, score = vp_tree.search(shard, tree, asked, 20, longest, factor)
        recall.append(np.mean([len(exact[i] & set(row[place == i].tolist())) / 20 for i in range(60)]))
        kth = np.array([score[place == i].min() for i in range(60)])
        looked.append(vp_tree.reached(tree.bounds(asked["points"]), kth, asked["length"], longest, factor).mean())
    assert recall[0] == 1 and recall[1] >= 0.9 and tuned >= 1
    assert looked[0] >= looked[1] > looked[2] and looked[0] < 0.9
    assert vp_tree.tuned_factor(v[:4000], 20, longest, 0.5) > vp_tree.tuned_factor(v[:4000], 20, longest, 1.0)


@needs_tables
def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found, exact = result(queries.QUERIES["op11_vp_tree"](spark, SMALL)), brute(rows)
    assert {(q, r) for q, r, _, _ in found} == {(q, r) for q, r, _, _ in exact}
    near = {(q, c): s for q, _, c, s in exact}
    hits = [(q, c) for q, _, c, s in found if near.get((q, c)) == s]
    assert len(hits) >= 0.9 * len(exact)
