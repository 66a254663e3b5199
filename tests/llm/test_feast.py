from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import feast, queries
from tests.llm.helpers import SMALL, empty, needs_tables

SHAPE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, wanted=32, width=None):
    """By exact sums and numpy's own eigenvectors: n, deviations, whitened (up to sign), shares."""
    good = [
        (i, [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max(len(v) for _, v in good)
    x = [v + [1_000_000] * (width - len(v)) for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    z = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x]
    deviation = [sum(a * a for a in v) for v in z]
    centred = np.array([[a / n for a in v] for v in z])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    keep = values > 1e-12 * values[0]
    white = centred @ vectors[:, keep] / np.sqrt(values[keep])
    return [i for i, _ in good], n, deviation, white, values[keep] / np.trace(v)


def check(df, rows, wanted=32):
    ids, n, deviation, white, share = brute(rows, wanted)
    got = [tuple(r) for r in df.select([f.name for f in feast.ANSWER]).collect()]
    assert len(got) == white.size
    assert {r[2] for r in got} == {n} and max(r[6] for r in got) <= 1e-4 and len({r[6] for r in got}) == 1
    for c in range(white.shape[1]):
        part = [r for r in got if r[1] == c + 1]
        assert abs(part[0][5] / share[c] - 1) <= 1e-9
        mine = sorted((repr(r[0]), r[3], r[4]) for r in part)
        signs = []
        for sign in (1, -1):
            theirs = sorted((repr(i), d, sign * w) for i, d, w in zip(ids, deviation, white[:, c], strict=True))
            signs.append(
                [m[:2] for m in mine] == [t[:2] for t in theirs]
                and np.allclose([m[2] for m in mine], [t[2] for t in theirs], rtol=1e-7, atol=1e-7)
            )
        assert any(signs), c


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE).withColumns(
        {"row": F.lit(1), "x": F.lit("x"), "v": F.lit(2), "n": F.lit("p"), "a.b": F.lit(4),
         "map": F.create_map(F.lit("k"), F.lit(1))}
    )


def test_inertia_counts_signs():
    rng = np.random.default_rng(0)
    for size in (1, 2, 5, 20):
        for _ in range(20):
            q = np.linalg.qr(rng.normal(size=(size, size)))[0]
            e = rng.choice([-3.0, -1e-3, 2.0, 1e-3], size=size)
            assert feast.inertia((q * e) @ q.T)[:2] == ((e > 0).sum(), (e < 0).sum())
    assert feast.inertia(np.zeros((3, 3))) == (0, 0, 3)
    assert feast.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 1, 0)


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 2, 40), np.geomspace(1e-6, 1e3, 40), np.r_[np.ones(20), np.full(10, 5.0), np.linspace(6, 7, 10)],
    np.r_[np.zeros(30), np.arange(1, 11)], np.r_[np.full(39, 1.0), 1e6],
])
def test_contours_find_every_eigenvalue(spark, spectrum):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))[0]
    v = (q * spectrum) @ q.T
    v = (v + v.T) / 2
    cut = feast.intervals(v, 12)
    assert sum(c for *_, c in cut) >= 12
    assert all(np.sum((spectrum > low) & (spectrum <= high)) == c for low, high, c in cut if high - low > 1e-9)
    values, vectors = feast.components(spark, v, 12)
    assert np.allclose(values, np.sort(spectrum)[::-1][:12], rtol=1e-10, atol=1e-12 * spectrum.max())
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * spectrum.max()


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 5
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (None, rows[0][1]), (5, rows[1][1]), (303, [2.0, 1.0]), (304, [])]
    check(feast.whiten(frame(spark, rows)), rows)
    check(feast.whiten(frame(spark, rows), wanted=2), rows, 2)


def test_few_rows_and_extremes(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [2.0, 4.0, 7.0]), (2, [0.0, 5.0, 1.0])]  # two components at most
    check(feast.whiten(frame(spark, rows)), rows)
    far = [(0, [1e11, 2.0]), (1, [-2e11, 4.0]), (2, [3e10, -5e11]), (3, [1.0, 1.0])]
    got = feast.whiten(frame(spark, far)).collect()
    assert len(got) == 8 and all(r["deviation"] is None for r in got)
    assert len(feast.whiten(frame(spark, [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [1.0, 1.0])])).collect())
    for few in ([(0, [1.0, 2.0])], [(0, [1.0]), (1, [1.0])], [(0, None)], [(0, [])]):
        assert feast.whiten(frame(spark, few)).collect() == []
    assert feast.whiten(empty(frame(spark, rows))).collect() == []


@needs_tables
def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(queries.QUERIES["op13_feast_whitening"](spark, SMALL), rows)
