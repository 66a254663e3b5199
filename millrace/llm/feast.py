"""Whitening of vectors, with principal components by contour integration (FEAST).

The covariance ``V`` of whole-number vectors is summed exactly over all rows.  Its largest eigenvalues
are cut into intervals of a few each by counting: the number of eigenvalues above ``s`` is the
number of positive pivots of ``V - s I`` (Sylvester's law of inertia), by a symmetric factorisation with
pivoting.  For an interval, the integral of the resolvent ``(z I - V)^-1`` around a circle through its
ends projects onto its eigenvectors.  A quadrature of that integral is applied to a few vectors: one
complex solve with the shifted covariance for each node.  Rayleigh-Ritz on the projected vectors gives
eigenpairs; projecting these again refines them until their residuals are at rounding level.
The count of each interval says how many there must be, so none is missed; a failed count is an error.

Intervals are independent and are solved by Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import dense, dump, load, numbers
from millrace.llm.top_k import floored, usable
from millrace.session import empty_frame, materialize

COMPONENTS = 32
#: Nodes on the upper half of a contour, eigenvalues that an interval should hold, and refinements.
NODES, PER_INTERVAL, ROUNDS = 8, 8, 30
#: Residuals, relative to the greatest eigenvalue, at which a pair counts as converged.
TOLERANCE = 1e-14
#: Eigenvalues under this share of the greatest are rounding, not variance.
NO_VARIANCE = 1e-13
#: Components are cut to this, so that a long holds their differences.
MOST = float(1 << 52)
LONG = (1 << 63) - 1
ROWS = 4096
ANSWER = T.StructType()
for _name, _kind in (
    ("vec_id", "long"), ("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
    ("explained", "double"), ("identity_error", "double"),
):
    ANSWER = ANSWER.add(_name, _kind)


# one symmetric matrix


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are positive, negative and zero.

    ``P A P' = L D L'`` with pivots of one or two rows (Bunch and Parlett), signs counted in ``D``.
    """
    a, counts = np.array(a, float), [0, 0, 0]
    scale = np.abs(a).max(initial=0)
    ratio = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        p, (r, c) = int(diagonal.argmax()), np.unravel_index(np.abs(a).argmax(), a.shape)
        largest = abs(a[r, c])
        if largest <= 1e-300 or largest <= scale * 1e-17:
            counts[2] += len(a)
            break
        if diagonal[p] >= ratio * largest:
            chosen = [p]
        else:
            chosen = [int(r), int(c)]
        rest = np.setdiff1d(np.arange(len(a)), chosen)
        pivot, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        for e in pivot[0] if len(chosen) == 1 else (1.0, -1.0):  # a pivot of two rows has one of each sign
            counts[0 if e > 0 else 1] += 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return tuple(counts)


def above(v: np.ndarray, s: float) -> int:
    """The number of eigenvalues greater than ``s``."""
    return inertia(v - s * np.eye(len(v)))[0]


def intervals(v: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from above, holding the ``wanted`` largest eigenvalues and perhaps more.

    Ends lie between eigenvalues, as counts tell; eigenvalues too near to be told apart stay together.
    """
    size = len(v)
    top = float(np.abs(v).sum(axis=1).max())  # no eigenvalue is larger
    ends = {top * (1 + 1e-12) + 1e-300: 0, -top * 1e-12 - 1e-300: above(v, -top * 1e-12 - 1e-300)}
    if ends[min(ends)] < size:
        ends[-top - 1e-300] = size
    open_ = True
    while open_:
        open_ = False
        order = sorted(ends, reverse=True)
        for high, low in zip(order, order[1:], strict=False):
            inside = ends[low] - ends[high]
            if ends[high] >= wanted or inside <= most or high - low <= 1e-13 * top:
                continue
            middle = (high + low) / 2
            ends[middle] = above(v, middle)
            open_ = True
    order = sorted(ends, reverse=True)
    out = []
    for high, low in zip(order, order[1:], strict=False):
        if ends[high] < wanted and ends[low] > ends[high]:
            out.append((low, high, ends[low] - ends[high]))
    return out


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    rounds: int


def contour_pairs(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> Pairs:
    """The ``count`` eigenpairs of ``v`` between ``low`` and ``high``, largest first."""
    size, scale = len(v), float(np.abs(v).sum(axis=1).max()) or 1.0
    centre, radius = (low + high) / 2, (high - low) / 2 or scale * 1e-15
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (nodes + 1)  # the upper half; the lower one is its mirror image
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(size, min(size, count + max(count // 2, 3)))))[0]
    best = None
    for step in range(1, ROUNDS + 1):
        projected = np.zeros_like(basis)
        for angle, weight in zip(angles, weights, strict=True):
            turn = radius * np.exp(1j * angle)
            solved = np.linalg.solve((centre + turn) * np.eye(size) - v, basis.astype(complex))
            projected += weight / 2 * (turn * solved).real
        basis = np.linalg.qr(projected)[0]
        values, small = np.linalg.eigh(basis.T @ v @ basis)
        basis = basis @ small
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) == count:
            left = v @ basis[:, inside] - basis[:, inside] * values[inside]
            residual = float(np.linalg.norm(left, axis=0).max()) / scale
            if best is not None and residual >= best.residual / 2 and residual < 1e-10:
                break  # at rounding level
            if best is None or residual < best.residual:
                best = Pairs(values[inside][::-1], basis[:, inside][:, ::-1], residual, step)
            if residual <= TOLERANCE:
                break
    if best is None or best.residual > 1e-9:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, and were not all found")
    return best


def components(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and their unit eigenvectors (columns).

    One Spark task for each interval; the matrix, whose size is that of the vectors squared, goes with the code.
    """
    cut = intervals(v, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = contour_pairs(v, low, high, count, at)
                data = dump(values=found.values, vectors=found.vectors)
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "data": pa.array([data], pa.binary())})

    todo = spark.createDataFrame([(i, *x) for i, x in enumerate(cut)], "at int, low double, high double, count int")
    solved = todo.repartition(len(cut), "at").mapInArrow(run, "at int, data binary").collect()
    pairs = [load(bytes(r["data"])) for r in sorted(solved, key=lambda r: r["at"])]
    # one Rayleigh-Ritz step over all intervals makes vectors of neighbouring ones orthogonal
    basis = np.linalg.qr(np.concatenate([p["vectors"] for p in pairs], axis=1))[0]
    values, small = np.linalg.eigh(basis.T @ v @ basis)
    return values[::-1][:wanted], (basis @ small)[:, ::-1][:, :wanted]


# exact sums


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` of whole numbers, exactly."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < 1 << 53:
        return (y.astype(float).T @ y.astype(float)).astype(np.int64)
    if most * most * max(len(y), 1) < 1 << 62:
        return y.T @ y
    return y.astype(object).T @ y.astype(object)


def shift_of(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""
    names = [F.sum(F.coalesce(F.get("x", F.lit(i)), F.lit(0)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    if width <= 256:
        total = rows.agg(F.count("*").alias("n"), *names).first()
        return total["n"], [int(s or 0) for s in total[1:]]
    placed = rows.select(F.posexplode("x").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = {r["i"]: int(r["s"]) for r in placed.collect()}
    return rows.count(), [sums.get(i, 0) for i in range(width)]


def pair_sums(rows: DataFrame, width: int, mean: list[int]) -> list[list[int]]:
    """Exact sums of products of all pairs of centred dimensions, over all rows."""
    centre = np.array(mean, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total = total + exact_gram(whole_rows(batch.column(0).slice(at, ROWS), width) - centre)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": [str(x) for x in total[i, j]]}
        )

    sums = rows.select("x").mapInArrow(run, "i int, j int, s string").groupBy("i", "j").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    out = [[0] * width for _ in range(width)]
    for r in sums.toLocalIterator():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["s"])
    return out


def whole_rows(column: pa.Array, width: int) -> np.ndarray:
    """Rows of longs, shorter ones filled up with what a component of zero becomes."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes, values = np.asarray(lists.value_lengths(), np.int64), np.asarray(lists.flatten(), np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), OFFSET)
    out[np.arange(width) < sizes[:, None]] = values
    return out


OFFSET = 1_000_000


def covariance(n: int, sums: list[int], mean: list[int], products: list[list[int]]) -> np.ndarray:
    """``sum (x - S/n)(x - S/n)' / n``, from exact sums about whole-number centres, rounded once."""
    width = len(sums)
    off = [s - n * m for s, m in zip(sums, mean, strict=True)]
    return np.array(
        [[(n * products[i][j] - off[i] * off[j]) / (n * n) for j in range(width)] for i in range(width)]
    ).reshape(width, width)


# the operator


def whiten(
    vectors: DataFrame,
    wanted: int = COMPONENTS,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Every component ``c`` of a vector becomes ``x = floor(scale * c) + 1000000``.  For each vector and
    each of the ``wanted`` principal components (numbered from 1 by falling eigenvalue): the
    centred vector's projection over the root of the eigenvalue.  ``deviation`` is the exact sum of
    ``(n x - S)^2`` (null if a long does not hold it), ``explained`` the eigenvalue's share of the trace,
    ``identity_error`` the largest entry of the whitened values' own covariance minus the identity.

    Three passes over the stored whole numbers: sums, centred products (each task adds up one square of
    numbers, and Spark adds these), projections; and one over the projections for the last figure.

    Rows whose vector is null or holds a null or non-finite component are dropped; rows without an
    id stay, with a null one.  Repeated rows count each.  Shorter vectors count as filled up with
    zeros.  ``x`` is cut to 52 bits.  Components without variance (a share of the greatest under
    1e-13, as with equal rows) are left out, as nothing can be scaled to one; so a table of
    one row, or an empty one, gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    number = lambda c: F.greatest(F.least(floored(c * F.lit(scale)), F.lit(MOST)), F.lit(-MOST)).cast("bigint") + OFFSET
    rows = materialize(
        raw.filter(usable(F.col("v"))).select("vec_id", F.transform("v", number).alias("x")), "whole"
    )
    width = rows.agg(F.max(F.size("x")).alias("d")).first()["d"]
    if not width:
        return empty_frame(spark, ANSWER)
    full = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(OFFSET).cast("bigint"), F.lit(width) - F.size("x"))))
    n, sums = shift_of(full, width)
    mean = [(2 * s + n) // (2 * n) for s in sums]
    v = covariance(n, sums, mean, pair_sums(rows, width, mean))
    if not np.trace(v) > 0:
        return empty_frame(spark, ANSWER)
    values, directions = components(spark, v, min(wanted, width))
    kept = values > NO_VARIANCE * values[0]
    values, directions = values[kept], directions[:, kept]
    turn = directions / np.sqrt(values)
    centre, off = np.array(mean, np.int64), np.array([(s - n * m) / n for s, m in zip(sums, mean, strict=True)])
    exact_off = [s - n * m for s, m in zip(sums, mean, strict=True)]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                y = whole_rows(part.column(1), width) - centre
                white = (y - off) @ turn
                flat = pa.array(white.ravel())
                ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * white.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), deviations(y, n, exact_off), pa.ListArray.from_arrays(ends, flat)],
                    ["vec_id", "deviation", "white"],
                )

    white = materialize(rows.mapInArrow(project, "vec_id bigint, deviation bigint, white array<double>"), "white")
    error = identity_error(white, n, len(values))
    share = F.array(*[F.lit(float(e)) for e in values / np.trace(v)])
    placed = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return placed.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )


def deviations(y: np.ndarray, n: int, off: list[int]) -> pa.Array:
    """``sum (n x - S)^2`` of each row, from ``y = x - mean`` and ``off = S - n mean``; null beyond a long."""
    most = max((int(np.abs(y).max(initial=0)) * n + max(map(abs, off))), 1)
    if most * most * y.shape[1] <= LONG:
        z = y * n - np.array(off, np.int64)
        return pa.array(np.einsum("ij,ij->i", z, z))
    z = y.astype(object) * n - np.array(off, object)
    total = (z * z).sum(axis=1)
    return pa.array([int(t) if t <= LONG else None for t in total], pa.int64())


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of whitened rows minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                w = dense(batch.column(0).slice(at, ROWS), k)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "s": total.ravel()})

    sums = white.select("white").mapInArrow(run, "at bigint, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((k + 1) * k)
    for r in sums:
        total[r["at"]] = r["s"]
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
