from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import four_russians, queries
from tests.llm.helpers import SMALL, empty, needs_tables

SHAPE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=10, shift=False):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if shift and i % 7 == 0 else label
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for at, (a, u, own) in enumerate(good):
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(u, v, strict=False)), i, label)
            for place, (i, v, label) in enumerate(good) if place != at
        )
        for p, i, _ in [s for s in scored if s[2] == own][:positives]:
            fit = [(n, c) for n, c, label in scored if label != own and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(a, i, rank, c, -p, -n) for rank, (n, c) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE).withColumns(
        {"row": F.lit(1), "y": F.lit("x"), "id": F.lit(2), "part": F.lit("p"), "a.b": F.lit(4),
         "map": F.create_map(F.lit("k"), F.lit(1))}
    )


def result(df):
    return sorted(map(tuple, df.select([f.name for f in four_russians.ANSWER]).collect()))


def mixed(n, width, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    label = np.where(rng.random(n) < 0.35, 0, rng.integers(labels, size=n))
    v = 0.3 * centres[label] + 0.4 * rng.normal(size=(n, width)) + 0.3
    return [(i, [float(x) for x in r], int(c)) for i, (r, c) in enumerate(zip(v, label, strict=True))]


def test_packed_planes_give_exact_products():
    rng = np.random.default_rng(0)
    for width, scale in ((3, 5), (8, 300), (13, 300), (64, 1 << 29)):
        y = rng.integers(-scale, scale, size=(40, width))
        planes = four_russians.pack(y)
        assert (four_russians.unpack(planes, width) == y).all()
        kind = four_russians.score_kind(y, planes.shape[1], width)
        assert (four_russians.scores(four_russians.subset_sums(y, kind), planes) == y.astype(object) @ y.T.astype(object)).all()
    huge = np.array([[1 << 70, -3], [-(1 << 80), 5]], object)
    assert (four_russians.unpack(four_russians.pack(huge), 2) == huge).all()


@pytest.mark.parametrize("block", [8, 10_000])
@pytest.mark.parametrize("labels", [3, 60])
def test_against_brute_force(spark, monkeypatch, block, labels):
    monkeypatch.setattr(four_russians, "LEAST_BLOCK_ROWS", 1)
    monkeypatch.setattr(four_russians, "ANCHOR_ROWS", 7)
    rows = mixed(300, 5, labels, block)
    rows += [(300 + i, rows[4][1], rows[4][2]) for i in range(30)] + [(330 + i, rows[5][1], i % 3) for i in range(30)]
    rows += [(400, None, 1), (410, [1.0, None], 1), (420, [float("nan")], 1), (430, [1.0], None), (None, [1.0], 1)]
    rows += [(440, [0.5, 0.5], 1), (450, [], 0), (0, rows[7][1], 0), (460, [0.0] * 5, 2), (470, [9.0], 1)]
    got = result(four_russians.hard_negatives(frame(spark, rows), every=10, block_rows=block))
    assert got == brute(rows, every=10) and got


def test_few_rows_and_large_numbers(spark):
    rows = [(0, [1e12, 2.0], 1), (1, [3e12, -1.0], 1), (2, [1e12, 1.0], 2), (3, [2e11, 5e11], 2)]
    small = [(i, [x / 1e6 for x in v], c) for i, v, c in rows]
    assert result(four_russians.hard_negatives(frame(spark, small))) == brute(small)
    assert len(brute(small))
    four_russians.hard_negatives(frame(spark, [(i, [x * 1e20 for x in v], c) for i, v, c in rows])).collect()
    assert result(four_russians.hard_negatives(frame(spark, rows[:1]))) == []
    assert result(four_russians.hard_negatives(frame(spark, [(5, [1.0], 1)]))) == []
    assert four_russians.hard_negatives(empty(frame(spark, rows))).count() == 0


@needs_tables
def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(queries.QUERIES["op12_four_russians"](spark, SMALL)) == brute(rows, shift=True)
