"""Exact top-k inner products: vectors by falling length, partial sums after an SVD rotation.

Rotated by the right singular vectors of the data, a vector has most of its length in its first
coordinates.  The product over those plus the product of the two residual lengths bounds the
whole product (Cauchy-Schwarz), so a pair whose bound is under the query's k-th best so far needs
no further work; and as vectors come by falling length, a query is finished with a chunk when
even the longest vector left could not reach it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import Size, keyed_join, measure
from millrace.session import materialize

CHUNK_ROWS = 65_536
LEAST_CHUNK_ROWS = 1024
STEP_ROWS = 1024
QUERY_ROWS = 512
#: Query blocks that one task takes past a chunk.
TOGETHER = 32
#: Meetings of a lane and a chunk in one task, on large tables.
PAIRS = 16
#: Lengths beyond these share a bin with them.
SHORTEST, LONGEST = 2.0**-1000, 2.0**1000
#: Share of the squared length that the first coordinates of rotated vectors should have.
HEAD_SHARE = 0.9
#: Share of pairs that the bound must rule out for the others to be worked on one by one.
RULED_OUT = 0.9
EXACT = float(1 << 52)
LONG = (1 << 63) - 1
NONE = -LONG


def usable(vector: Column) -> Column:
    """Neither null nor holding a component that is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, lambda x: bad(x.cast("double")))


def floored(x: Column) -> Column:
    """Floor of a double as a double (the built-in one gives a long, which may not hold it)."""
    near = F.rint(x)
    return F.when(near > x, near - 1.0).otherwise(near)


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of all rows, and how many of them make the head.

    Tasks add up ``v v'``; the sums of ``width`` squared numbers are all that leaves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            v = matrix(batch.column(0), width)
            total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["i", "x"])

    sums = vectors.select("v").mapInArrow(run, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(width * width)
    for r in sums:
        gram[r["i"]] = r["x"]
    gram = gram.reshape(width, width)
    values, basis = np.linalg.eigh(gram / max(np.abs(gram).max(initial=0), 1e-300))
    values, basis = np.maximum(values[::-1], 0), basis[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return basis, int(min(np.searchsorted(share, HEAD_SHARE) + 1, width))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width))
    for row, values in zip(out, column.to_pylist(), strict=True):
        row[: len(values)] = values
    return out


@dataclass
class Block:
    """Some vectors: row numbers, ids, whole-number components, and what the bounds need."""

    rows: np.ndarray
    ids: np.ndarray
    v: np.ndarray
    length: np.ndarray
    head: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, rows: bytes, ids: bytes, v: bytes, width: int, basis: np.ndarray, m: int) -> Block:
        numbers = np.frombuffer(rows, np.int64)  # bytes, as they are stored
        vectors = np.frombuffer(v).reshape(len(numbers), width)
        turned = vectors @ basis
        return cls(
            numbers, np.frombuffer(ids, np.int64), vectors, np.linalg.norm(vectors, axis=1), turned[:, :m],
            np.linalg.norm(turned[:, m:], axis=1),
        )

    def part(self, a: int, b: int) -> Block:
        return Block(*(getattr(self, f)[a:b] for f in ("rows", "ids", "v", "length", "head", "rest")))


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of all rows; beyond what doubles hold, by whole numbers (cut to longs)."""
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(y) for y in row] for row in x], object).reshape(x.shape)
    return np.clip(whole(a) @ whole(b).T, NONE + 1, LONG).astype(np.int64)


def runs(i: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of a sorted array with its span."""
    values, starts = np.unique(i, return_index=True)
    for value, a, b in zip(values.tolist(), starts.tolist(), np.append(starts[1:], len(i)).tolist()):
        yield value, slice(a, b)


def best_of(chunk: Block, asked: Block, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, id and score of each query's ``k`` best in a chunk that is sorted by falling
    length.  Nothing under ``floor`` (by query) is wanted; ties go to the smaller id."""
    n = len(asked.rows)
    best = np.full((n, k), NONE)  # scores, falling
    ids = np.full((n, k), LONG)
    kth = np.asarray(floor, np.int64).copy()
    for at in range(0, len(chunk.rows), STEP_ROWS):
        step = chunk.part(at, at + STEP_ROWS)
        limit = kth.astype(float)
        slack = 1e-9 * asked.length * step.length[0] + 1e-6
        open_ = np.flatnonzero(asked.length * step.length[0] + slack >= limit)
        if not len(open_):
            break
        q = Block(*(getattr(asked, f)[open_] for f in ("rows", "ids", "v", "length", "head", "rest")))
        bound = q.head @ step.head.T
        bound += q.rest[:, None] * step.rest
        far = bound < (limit[open_] - slack[open_])[:, None]
        largest = float(q.length.max() * step.length[0])
        if far.mean() >= RULED_OUT and largest < EXACT:
            i, j = np.nonzero(~far)
            score = np.einsum("ij,ij->i", q.v[i], step.v[j]).astype(np.int64)
        else:
            scores = products(q.v, step.v, largest)
            i, j = np.nonzero(scores >= kth[open_][:, None])
            score = scores[i, j]
        wanted = (score >= kth[open_][i]) & (q.rows[i] != step.rows[j])
        i, j, score = open_[i[wanted]], j[wanted], score[wanted]
        for row, part in runs(i):
            scored = np.concatenate([best[row], score[part]])
            named = np.concatenate([ids[row], step.ids[j[part]]])
            near = np.flatnonzero(scored >= np.partition(scored, len(scored) - k)[len(scored) - k])
            order = near[np.lexsort((named[near], -scored[near]))][:k]
            best[row], ids[row] = scored[order], named[order]
            kth[row] = max(kth[row], best[row, -1])
    place, rank = np.nonzero(best > NONE)
    return place, ids[place, rank], best[place, rank]


# jobs


def pack(rows: DataFrame, most: int, width: int, name: str) -> DataFrame:
    """Rows of ``(row, id, v, length, floor, reach)``, as they are dealt and sorted, in stored
    blocks of ``most``: ``part, seq, longest, reach, rows, ids, v, floors`` (bytes from ``rows``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def close(size: int) -> pa.RecordBatch:
            nonlocal held, n, seq
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            held, n, seq = [[c[size:] for c in columns]], n - size, seq + 1
            numbers, ids, v, length, floors, reach = (c[:size] for c in columns)
            data = [x.tobytes() for x in (numbers, ids, v, floors)]
            row = [part, seq, float(length.max()), float(reach.min()), *data]
            names = ["part", "seq", "longest", "reach", "rows", "ids", "v", "floors"]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names)

        for batch in batches:
            plain = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4, 5)]
            held.append([*plain[:2], matrix(batch.column(2), width), *plain[2:]])
            n += batch.num_rows
            while n >= most:
                yield close(most)
        if n:
            yield close(n)

    shape = "part bigint, seq bigint, longest double, reach double, rows binary, ids binary, v binary, floors binary"
    return materialize(rows.select("row", "id", "v", "length", "floor", "reach").mapInArrow(run, shape), name)


def length_bin(length: Column) -> Column:
    """Quarter octaves of a length, some thousands at most; a longer vector is in no lower bin."""
    bin_ = F.floor(4 * F.log2(F.greatest(F.least(length, F.lit(LONGEST)), F.lit(SHORTEST))))
    return bin_.cast("int")


def reached(lanes: DataFrame, lengths: DataFrame) -> DataFrame:
    """``chunk, lane, longest``: the chunks whose longest vector is no shorter than a lane's reach.

    Joined on bins of the length.  A bin that many lanes or chunks share is spread by ``keyed_join``.
    """
    binned = lengths.withColumn("bin", length_bin(F.col("longest")))
    ends = binned.agg(F.min("bin").alias("low"), F.max("bin").alias("high"), F.max("longest").alias("top")).first()
    if ends["top"] is None:
        return lanes.select(F.lit(0).cast("bigint").alias("chunk"), "lane", F.lit(0.0).alias("longest")).limit(0)
    low, high = F.lit(ends["low"]), F.lit(ends["high"])
    start = F.least(F.greatest(length_bin(F.col("reach")) - 1, low), high)  # one lower, for rounding
    wanted = lanes.filter(F.col("reach") <= ends["top"]).withColumn("bin", F.explode(F.sequence(start, high)))
    met = keyed_join(wanted, binned, ["bin"], right_size=measure(binned))
    return met.filter(F.col("longest") >= F.col("reach")).select("chunk", "lane", "longest")


def meet(
    chunks: DataFrame, asked: DataFrame, pairs: DataFrame, k: int, width: int, basis: np.ndarray, m: int
) -> DataFrame:
    """``row, query_id, vec_id, score``: the best of a chunk for the queries sent to it.

    ``pairs`` names which lanes of query blocks meet which chunks (``chunk, lane, longest``).  A chunk
    is sent once for each of its lanes, so that many tasks work on one that many queries ask; in a
    task it comes first, and the lane's blocks stream past it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chunk = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                number, lane, kind, *data, floors = (c[at].as_py() for c in batch.columns)
                block = Block.of(*data, width, basis, m)
                if kind == 0:
                    place, chunk = (number, lane), block
                    continue
                if place != (number, lane):
                    raise ValueError(f"no chunk {number} before its queries")
                row, found, score = best_of(chunk, block, np.frombuffer(floors, np.int64), k)
                task = np.full(len(row), TaskContext.get().partitionId())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (block.rows[row], block.ids[row], found, score, task)],
                    ["row", "query_id", "vec_id", "score", "task"],
                )

    held = chunks.select("chunk", "rows", "ids", "v")
    blocks = asked.select("lane", "reach", "rows", "ids", "v", "floors")
    columns = ["chunk", "lane", "kind", "rows", "ids", "v", "floors"]
    first = keyed_join(pairs.select("chunk", "lane"), held, ["chunk"], right_size=measure(held))
    then = keyed_join(pairs, blocks, ["lane"], right_size=measure(blocks)).filter(F.col("longest") >= F.col("reach"))
    both = first.withColumns({"kind": F.lit(0), "floors": F.lit(None).cast("binary")}).select(*columns).unionByName(
        then.withColumn("kind", F.lit(1)).select(*columns)
    )
    # numbered partitions are not merged by their bytes, which say little of the work in them
    n = pairs.count()
    tasks = max(min(n, max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // PAIRS)), 1)
    return both.repartition(tasks, "chunk", "lane").sortWithinPartitions("chunk", "lane", "kind").mapInArrow(
        run, "row bigint, query_id bigint, vec_id bigint, score bigint, task bigint"
    )


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own.  Components become ``floor(scale * x)``, scores are whole numbers, ties go to the
    smaller id.  The result is exact.

    All vectors are sorted by falling length, by ranges, into chunks.  Every query block first
    meets the chunk of the longest vectors; the k-th score there is the floor under which
    nothing later counts.  Then a block goes only to chunks with vectors long enough for one of
    its queries.  Blocks come in lanes, and each lane meets a chunk in a place of its own, so a
    chunk that all queries ask, as the first, is not the work of one task.  A task holds one chunk
    and one query block at a time.  The best of each chunk,
    at most ``k`` a query, are ranked in the end.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows
    without an id.  Shorter vectors count as filled up with zeros.  Rows that repeat an id are
    rows of their own: each is asked, and is a candidate for the others.  An empty table gives
    no rows; with fewer candidates there are fewer ranks.  Scores beyond a long are cut to it.
    """
    raw = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("x"))
    whole = F.transform("x", lambda x: floored(x.cast("double") * F.lit(scale)))
    rows = materialize(
        raw.filter(F.col("id").isNotNull() & usable(F.col("x"))).select(
            F.monotonically_increasing_id().alias("row"), "id", whole.alias("v")
        ).withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))),
        "vectors",
    )
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, width = total["n"], max(total["d"] or 0, 1)
    answer = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n:
        return rows.sparkSession.createDataFrame([], answer)
    basis, m = rotation(rows, width)
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    size = max(min(chunk_rows, -(-n // tasks)), LEAST_CHUNK_ROWS)
    order = [F.col("length").desc(), F.col("row")]
    plain = rows.withColumns({"floor": F.lit(NONE + 1), "reach": F.lit(0.0)})
    dealt = plain.repartitionByRange(-(-n // size), *order).sortWithinPartitions(*order)
    chunks = pack(dealt, size, width, "chunks").withColumn("chunk", F.col("part") * (1 << 20) + F.col("seq"))
    first = chunks.agg(F.min("chunk")).first()[0]
    longest = chunks.filter(F.col("chunk") == first).select("chunk", "longest")
    others = chunks.filter(F.col("chunk") != first)

    asked = plain.filter(F.col("id") % every == 0)
    queries = pack(asked, QUERY_ROWS, width, "queries")
    lanes = max(-(-queries.count() // TOGETHER), 1)
    queries = queries.withColumn("lane", F.pmod(F.xxhash64("part", "seq"), F.lit(lanes)))
    every_lane = queries.select("lane").distinct().withColumn("chunk", F.lit(first))
    opened = keyed_join(every_lane, longest, ["chunk"], right_size=Size(1, 16))
    head = materialize(meet(chunks.filter(F.col("chunk") == first), queries, opened, k, width, basis, m), "head")
    floors = head.groupBy("row").agg(F.count("*").alias("found"), F.min("score").alias("kth"))
    floor = F.when(F.col("found") >= k, F.col("kth")).otherwise(F.lit(NONE + 1))
    # the length that a vector needs for the floor, with room for rounding
    reach = F.when(F.col("floor") <= 0, 0.0).when(F.col("length") == 0, float("inf")).otherwise(
        F.col("floor") / F.col("length") * (1 - 1e-9)
    )
    again = (
        asked.drop("floor", "reach").join(floors, "row", "left").withColumn("floor", floor).withColumn("reach", reach)
        .repartitionByRange("reach", "row").sortWithinPartitions("reach", "row")
    )
    sent = pack(again, QUERY_ROWS, width, "queries").withColumn(
        "lane", F.col("part") * (1 << 20) + F.floor(F.col("seq") / TOGETHER)
    )
    pairs = materialize(reached(sent.groupBy("lane").agg(F.min("reach").alias("reach")), others.select("chunk", "longest")), "pairs")
    tail = meet(others, sent, pairs, k, width, basis, m)
    place = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        head.unionByName(tail)
        .withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
