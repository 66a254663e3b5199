"""Hard negatives, scored by the method of the Four Russians.

Components are whole numbers.  A candidate is kept as bit planes: for each bit ``j`` of its components
(two's complement) and each group of eight dimensions one byte.  For an anchor and a group, a table
holds the sum of the anchor's eight components over each of the 256 subsets, every entry made from an
earlier one by one addition.  A candidate's byte is the index of a subset, so the inner product is

    sum over j of +-2^j * sum over groups of table[group][byte(j, group)]

(minus for the top plane, the sign): lookups, shifts and additions, and the exact score of every pair.
The tables of a block of anchors lie side by side, so that one lookup serves the whole block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import dealt, dense, dump, load, meet, numbers, one_row
from millrace.llm.top_k import floored, runs, usable
from millrace.operators.joins import keyed_join, measure
from millrace.operators.keys import dense_ids
from millrace.session import empty_frame, materialize

BLOCK_ROWS = 16_384
LEAST_BLOCK_ROWS = 1024
ANCHOR_ROWS = 128
STEP_ROWS = 1024
LONG = (1 << 63) - 1
ANSWER = T.StructType()
for _name, _kind in (
    ("anchor_id", "long"), ("positive_id", "long"), ("rank", "integer"), ("negative_id", "long"),
    ("positive_score", "long"), ("negative_score", "long"),
):
    ANSWER = ANSWER.add(_name, _kind)


def whole(v: np.ndarray) -> np.ndarray:
    """Doubles that are whole numbers, as longs or else as Python's."""
    if np.abs(v).max(initial=0) < 1 << 31:
        return v.astype(np.int64)
    return np.array([[int(x) for x in row] for row in v], object).reshape(v.shape)


def pack(y: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers: bytes by row, plane and group of eight dimensions."""
    top = max((int(y.max(initial=0)), -int(y.min(initial=0)) - 1))
    planes = max(top, 0).bit_length() + 1
    out = [np.packbits(((y >> j) & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(planes)]
    return np.stack(out, axis=1)


def unpack(planes: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(planes, axis=2, count=width, bitorder="little")
    n = planes.shape[1]
    kind = np.int64 if n < 63 else object
    total = -(bits[:, -1].astype(kind) * (1 << (n - 1)))
    for j in range(n - 1):
        total = total + bits[:, j].astype(kind) * (1 << j)
    return total


def subset_sums(y: np.ndarray, kind: type) -> np.ndarray:
    """Sums of each anchor's components over all subsets of each group: by group, subset and anchor."""
    groups = -(-y.shape[1] // 8)
    full = np.zeros((len(y), 8 * groups), kind)
    full[:, : y.shape[1]] = y
    table = np.zeros((groups, 256, len(y)), kind)
    for bit in range(8):
        table[:, 1 << bit : 2 << bit] = table[:, : 1 << bit] + full[:, bit::8].T[:, None]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products by candidate and anchor."""
    n = planes.shape[1]
    total = np.zeros((len(planes), table.shape[2]), table.dtype)
    for group, sums in enumerate(table):
        for j in range(n):
            found = np.take(sums, planes[:, j, group], axis=0)
            if j:
                found <<= j
            if j == n - 1:
                total -= found
            else:
                total += found
    return total


def score_kind(anchors: np.ndarray, planes: int, width: int) -> type:
    """The narrowest numbers that hold every sum that may come up."""
    most = int(np.abs(anchors).max(initial=0)) * max(width, 8) << (planes + 1)
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 62 else object


def long(x: np.ndarray) -> np.ndarray:
    """Scores as longs, cut to what a long holds."""
    if x.dtype != object:
        return x.astype(np.int64)
    return np.array([max(min(int(s), LONG), -LONG) for s in x.ravel()], np.int64).reshape(x.shape)


def compared(block: dict, asked: dict) -> np.ndarray:
    """All scores of a block of candidates (rows) with a block of anchors (columns), as longs."""
    width = int(asked["width"])
    y = unpack(asked["planes"], width)
    table = subset_sums(y, score_kind(y, block["planes"].shape[1], width))
    out = np.empty((len(block["rows"]), len(y)), np.int64)
    for a in range(0, len(out), STEP_ROWS):
        out[a : a + STEP_ROWS] = long(scores(table, block["planes"][a : a + STEP_ROWS]))
    return out


def first_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by the smaller id."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return near[np.lexsort((ids[near], -score[near]))][:k]
    return np.lexsort((ids, -score))[:k]


def own_label(k: int):
    """The ``k`` first of each anchor's label in a block, but for the anchor itself."""

    def run(block: dict, asked: dict) -> dict | None:
        s, out = compared(block, asked), []
        for a, (row, label) in enumerate(zip(asked["rows"].tolist(), asked["labels"].tolist(), strict=True)):
            like = np.flatnonzero((block["labels"] == label) & (block["rows"] != row))
            best = like[first_of(s[like, a], block["ids"][like], k)]
            out.append((np.full(len(best), row), block["rows"][best], block["ids"][best], s[best, a]))
        anchor, rows, ids, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return {"anchor": anchor, "row": rows, "id": ids, "score": score}

    return run


def bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest negative score that ``low`` and ``high`` hundredths of a positive's allow."""
    share = lambda p, part, up: -(-int(p) * part // 100) if up else int(p) * part // 100
    return (
        np.array([share(p, low, True) for p in positive], np.int64),
        np.array([share(p, high, False) for p in positive], np.int64),
    )


def other_labels(k: int, low: int, high: int):
    """For each anchor and positive the ``k`` first of other labels within the range of scores."""

    def run(block: dict, asked: dict) -> dict | None:
        s, out = compared(block, asked), []
        owner = asked["owner"]  # place of the anchor of each positive, ascending
        for a, part in runs(owner):
            least, most = bounds(asked["positive_scores"][part], low, high)
            of = s[:, a]
            near = np.flatnonzero((of >= least.min()) & (of <= most.max()) & (block["labels"] != asked["labels"][a]))
            near = near[np.lexsort((block["ids"][near], -of[near]))]
            falling = -of[near]
            for at, lo, hi in zip(range(part.start, part.stop), least.tolist(), most.tolist(), strict=True):
                begin = np.searchsorted(falling, -hi, "left")
                best = near[begin : min(np.searchsorted(falling, -lo, "right"), begin + k)]
                if len(best):
                    n = len(best)
                    out.append((
                        np.full(n, asked["rows"][a]), np.full(n, asked["positive_rows"][at]),
                        block["ids"][best], of[best],
                    ))
        if not out:
            return None
        anchor, positive, ids, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return {"anchor": anchor, "positive": positive, "id": ids, "score": score}

    return run


# jobs


def grouped(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``part``: a label of more than ``most`` rows makes a part of its own, the others
    are gathered by a hash into parts of about ``most``."""
    counts = materialize(rows.groupBy("label").agg(F.count("*").alias("n")), "labels")
    rest = counts.filter(F.col("n") <= most).agg(F.sum("n").alias("n")).first()["n"] or 0
    large = materialize(counts.filter(F.col("n") > most).select("label", F.col("label").cast("string").alias("own")), "large")
    gathered = F.concat(F.lit("rest "), F.pmod(F.xxhash64("label"), F.lit(-(-rest // most) or 1)).cast("string"))
    named = keyed_join(rows, large, ["label"], "left", right_size=measure(large))
    return named.withColumn("part", F.coalesce("own", gathered)).drop("own")


def stored_blocks(rows: DataFrame, most: int, width: int, name: str) -> DataFrame:
    """``name, part, data``: blocks of some ``most`` rows of one part, as bit planes."""

    def block(part: pa.Table) -> pa.Table:
        data = dump(
            rows=numbers(part["row"]), ids=numbers(part["id"]), labels=numbers(part["label"]),
            planes=pack(whole(dense(part["y"], width))), width=np.array(width),
        )
        group, piece = part["part"][0].as_py(), part["piece"][0].as_py()
        return one_row([name, "part", "data"], [f"{group}:{piece}", group, data], [pa.string(), pa.string(), pa.binary()])

    blocks = dealt(rows, "part", most).groupBy("part", "piece").applyInArrow(
        block, f"{name} string, part string, data binary"
    )
    return materialize(blocks, name)


def with_positives(asked: DataFrame, positives: DataFrame, anchors: DataFrame) -> DataFrame:
    """Blocks of anchors that also hold the rows and scores of each anchor's positives."""
    of_block = positives.join(anchors.select(F.col("row").alias("anchor"), "asked"), "anchor").groupBy("asked").agg(
        F.collect_list(F.struct("anchor", "row", "score")).alias("found")
    )

    def run(batches):
        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                found, block = batch["found"][at].values, load(batch["data"][at].as_py())
                anchor, row, score = (np.asarray(found.field(i), np.int64) for i in range(3))
                by = np.argsort(block["rows"])
                owner = by[np.searchsorted(block["rows"], anchor, sorter=by)]
                order = np.lexsort((row, owner))
                out.append(dump(
                    **block, owner=owner[order], positive_rows=row[order], positive_scores=score[order]
                ))
            yield pa.RecordBatch.from_pydict({"asked": batch["asked"], "part": batch["part"], "data": pa.array(out, pa.binary())})

    joined = asked.join(of_block, "asked").select("asked", "part", "data", "found")
    return materialize(joined.mapInArrow(run, "asked string, part string, data binary"), "asked")


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``; components become
    ``floor(scale * x)`` and scores are whole inner products, higher first, ties by smaller id.  An
    anchor's positives are its ``positives`` first other rows of the same label; for each of them
    the ``negatives`` first rows of other labels are given whose score lies between ``low`` and
    ``high`` hundredths of the positive's (both included).

    Candidates lie in blocks; a label with many rows has blocks of its own, small labels share
    some.  Anchors lie in blocks dealt likewise, and first meet the blocks that may hold
    their label, then, with their positives known, all blocks that hold others.  A task
    holds one block of candidates and one of anchors.  All pairs are scored exactly; of each
    meeting only the first few go on.

    Rows without an id or a label, or whose vector is null or holds a null or non-finite component,
    take no part; shorter vectors count as filled up with zeros.  Rows that repeat an id are rows of their own.
    A score beyond a long is cut to it before it is compared.  Without rows, anchors or negatives in range
    there are no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    raw = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")))
    y = F.transform("x", lambda x: floored(x * F.lit(scale)))
    rows = materialize(raw.select(F.monotonically_increasing_id().alias("row"), "id", "label", y.alias("y")), "vectors")
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("y")).alias("width")).first()
    if not total["n"]:
        return empty_frame(spark, ANSWER)
    width = max(total["width"], 1)
    tasks = 2 * spark.sparkContext.defaultParallelism
    size = max(min(block_rows, -(-total["n"] // tasks)), min(LEAST_BLOCK_ROWS, block_rows))
    parts = materialize(grouped(rows, size), "parts")
    held = stored_blocks(parts, size, width, "held")
    anchors = parts.filter(F.col("id") % every == 0)
    asked = stored_blocks(anchors, ANCHOR_ROWS, width, "asked")

    near = meet(
        held, asked, held.select("held", "part").join(asked.select("asked", "part"), "part").select("held", "asked"),
        own_label(positives), "anchor bigint, row bigint, id bigint, score bigint",
    )
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    chosen = materialize(
        near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= positives).drop("_n"), "positives"
    )

    placed = dealt(anchors.select("row", "part"), "part", ANCHOR_ROWS)
    of_block = placed.select("row", F.concat_ws(":", "part", F.col("piece").cast("string")).alias("asked"))
    again = with_positives(asked, chosen, of_block)
    # every block of anchors meets every block of candidates, but for those of its own label alone
    names, _ = dense_ids(held.select("held", "part"), ["held"], "place")
    blocks = held.count()
    to = again.select("asked", F.col("part").alias("own"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(blocks).cast("bigint"))).alias("place"))
    pairs = to.join(names, "place").filter((F.col("own") != F.col("part")) | F.col("part").startswith("rest "))
    far = meet(
        held, again, pairs.select("held", "asked"), other_labels(negatives, low, high),
        "anchor bigint, positive bigint, id bigint, score bigint",
    )
    place = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    best = far.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= negatives)
    named = chosen.select(
        "anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return best.join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
