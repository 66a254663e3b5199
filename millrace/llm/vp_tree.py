"""Nearest neighbours by inner product with vantage-point trees, one per shard of the vectors.

A vector ``x`` is lifted to the unit point ``(x / M, sqrt(1 - |x|^2 / M^2))``, ``M`` the greatest
length, and a query ``q`` to ``(q / |q|, 0)``.  Between such points the squared distance is
``2 - 2 q.x / (|q| M)``: nearest by distance is largest by inner product, and distances obey the
triangle inequality that a vantage-point tree prunes with.

Every inner node of a tree has a vantage point; its vectors are halved by their distance to it, and
the least and greatest distance of each half are kept.  For a query at distance ``d`` of the vantage
point no vector of a half is nearer than ``max(least - d, d - greatest)``; the greatest such bound on
the way to a leaf holds for the leaf.  A leaf (and, by the same rule in a tree over regions, a shard)
is passed over if ``factor`` times its bound is beyond the query's k-th nearest so far.  Factor one
gives the exact answer; a larger one looks at less and may miss neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import dealt, dense, dump, load, meet, numbers, one_row
from millrace.llm.top_k import usable
from millrace.operators.joins import keyed_join
from millrace.session import empty_frame, materialize

#: Share of a sample's neighbours that the tuned factor has to find, and what is then taken off it.
RECALL, MARGIN = 1.0, 0.8
SHARD_ROWS = 16_384
LEAST_SHARD_ROWS = 1024
LEAF_ROWS = 256
QUERY_ROWS = 256
#: The factor is tuned and the tree over regions grown on at most so many vectors and bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 32 << 20
SAMPLE_QUERIES, REGIONS = 256, 1024
#: Distances of doubles near zero are known to about 1e-8.
SLACK = 1e-6
LONG = (1 << 63) - 1
ANSWER = T.StructType().add("query_id", "long").add("rank", "integer").add("vec_id", "long").add("score", "double")


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors as unit points."""
    out = np.empty((len(x), x.shape[1] + 1))
    out[:, :-1] = x / longest
    out[:, -1] = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", out[:, :-1], out[:, :-1]), 0))
    return out


def pointing(q: np.ndarray) -> np.ndarray:
    """Queries as unit points."""
    out = np.zeros((len(q), q.shape[1] + 1))
    near = q / np.abs(q).max(axis=1, keepdims=True)
    out[:, :-1] = near / np.linalg.norm(near, axis=1, keepdims=True)
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


@dataclass
class Tree:
    """Nodes level by level, the children of ``i`` at ``2 i + 1`` and ``2 i + 2``."""

    vantage: np.ndarray
    least: np.ndarray  # by node and half
    greatest: np.ndarray
    edges: np.ndarray  # where each leaf begins in the order of rows, and the end

    @property
    def depth(self) -> int:
        return (len(self.edges) - 1).bit_length() - 1

    @classmethod
    def grow(cls, points: np.ndarray, depth: int, seed: int = 0) -> tuple[Tree, np.ndarray]:
        """A tree of ``2 ** depth`` leaves over at least as many points, and their order in it."""
        rng, n = np.random.default_rng(seed), len(points)
        order, spans = np.arange(n), [(0, n)]
        vantage, least, greatest = [], [], []
        for _ in range(depth):
            halves = []
            for a, b in spans:
                rows = order[a:b]
                tried = points[rng.choice(rows, min(8, b - a), replace=False)]
                seen = points[rng.choice(rows, min(128, b - a), replace=False)]
                point = tried[np.argmax(distances(tried, seen).std(axis=1))]
                d = distances(points[rows], point[None])[:, 0]
                middle = (b - a) // 2
                by = np.argsort(d, kind="stable")
                order[a:b], d = rows[by], d[by]
                vantage.append(point)
                least.append((d[0], d[middle]))
                greatest.append((d[middle - 1], d[-1]))
                halves += [(a, a + middle), (a + middle, b)]
            spans = halves
        edges = np.array([a for a, _ in spans] + [n])
        shape = (len(vantage), points.shape[1])
        tree = cls(np.array(vantage).reshape(shape), np.array(least).reshape(-1, 2), np.array(greatest).reshape(-1, 2), edges)
        return tree, order

    def opened(self) -> Tree:
        """The same halves over the whole space: what lies nearer than the outer half is inner."""
        least, greatest = np.zeros_like(self.least), np.full_like(self.greatest, 2.0)
        least[:, 1] = self.least[:, 1]
        greatest[:, 0] = self.least[:, 1]
        return Tree(self.vantage, least, greatest, self.edges)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point in an opened tree."""
        node, rows = np.zeros(len(points), int), np.arange(len(points))
        d = distances(points, self.vantage)
        for _ in range(self.depth):
            node = 2 * node + 1 + (d[rows, node] >= self.least[node, 1])
        return node - (len(self.edges) - 2)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf, a distance that no vector of the leaf is nearer than."""
        bound = np.zeros((len(queries), 1))
        d = distances(queries, self.vantage)
        for level in range(self.depth):
            nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
            both = np.empty((len(queries), 2 * len(nodes)))
            for half in (0, 1):
                out = np.maximum(self.least[nodes, half] - d[:, nodes], d[:, nodes] - self.greatest[nodes, half])
                both[:, half::2] = np.maximum(bound, out)
            bound = both
        return bound


def reached(bound: np.ndarray, score: np.ndarray, length: np.ndarray, longest: float, factor: float) -> np.ndarray:
    """Whether a part of the space may hold something as near as ``score`` (by query)."""
    with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
        cosine = score / length / longest
    radius = np.sqrt(np.clip(2 - 2 * np.where(np.isnan(cosine), -1, cosine), 0, 4))
    radius = np.where(score == -np.inf, np.inf, radius)  # nothing found yet: nothing is ruled out
    return factor * (bound - SLACK) <= (radius if bound.ndim == 1 else radius[:, None])


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up from the first component to the last."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(a.shape[1]):
            total += a[:, j] * b[:, j]
    return total


def search(shard: dict, tree: Tree, asked: dict, k: int, longest: float, factor: float) -> tuple[np.ndarray, ...]:
    """Query place, row, id and score of each query's ``k`` best in a shard; nothing under the
    query's ``floor`` is wanted.  Ties go to the smaller id."""
    q, length = asked["q"], asked["length"]
    floor, n = asked["floor"].copy(), len(asked["q"])
    best = np.full((n, k), -np.inf)
    ids, rows = np.full((n, k), LONG), np.full((n, k), LONG)
    bound = tree.bounds(asked["points"])
    rank = np.arange(k)
    for leaf in np.argsort(bound.mean(axis=0)):
        open_ = np.flatnonzero(reached(bound[:, leaf], floor, length, longest, factor))
        if not len(open_):
            continue
        part = slice(tree.edges[leaf], tree.edges[leaf + 1])
        v = shard["v"][part]
        with np.errstate(over="ignore", invalid="ignore"):
            near = q[open_] @ v.T
            room = 1e-12 * length[open_] * longest
        i, j = np.nonzero(~(near < (floor[open_] - room)[:, None]))
        i, score = open_[i], inner(q[open_[i]], v[j])
        wanted = score >= floor[i]
        i, j, score = i[wanted], j[wanted], score[wanted]
        touched = np.unique(i)
        if not len(touched):
            continue
        # the best so far and the new ones, sorted by query, score and id
        who = np.concatenate([np.repeat(touched, k), i])
        what = np.concatenate([best[touched].ravel(), score])
        named = np.concatenate([ids[touched].ravel(), shard["ids"][part][j]])
        line = np.concatenate([rows[touched].ravel(), shard["rows"][part][j]])
        order = np.lexsort((line, named, -what, who))
        starts = np.searchsorted(who[order], touched)
        keep = order[starts[:, None] + rank]
        best[touched], ids[touched], rows[touched] = what[keep], named[keep], line[keep]
        floor[touched] = np.maximum(floor[touched], best[touched, -1])
    place, at = np.nonzero(rows < LONG)
    return place, rows[place, at], ids[place, at], best[place, at]


# jobs


def with_region(rows: DataFrame, top: Tree | None, width: int, longest: float, query: bool) -> DataFrame:
    """``rows`` with the leaf of the tree over regions that each vector (or query) lies in."""
    if top is None:
        return rows.withColumn("region", F.lit(0))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = dense(batch.column(at), width)
            region = top.leaf_of(pointing(v) if query else lifted(v, longest))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(region, pa.int32())], names=[*batch.schema.names, "region"]
            )

    return rows.mapInArrow(run, f"{kinds}, region int")


def leaf_depth(n: int) -> int:
    return max(-(-n // LEAF_ROWS) - 1, 0).bit_length()


def sampled(kept: DataFrame, width: int) -> np.ndarray:
    """A bounded sample of the vectors, by a hash of the row."""
    most = min(SAMPLE_ROWS, max(SAMPLE_BYTES // (8 * width), 64))
    return dense(kept.orderBy(F.xxhash64("row"), "row").limit(most).select("v").toArrow().column(0), width)


def top_tree(sample: np.ndarray, n: int, shard_rows: int, longest: float) -> Tree | None:
    """A tree over regions of some ``shard_rows`` rows."""
    regions = min(-(-n // shard_rows), REGIONS, len(sample) // 32)
    if regions < 2:
        return None
    return Tree.grow(lifted(sample, longest), (regions - 1).bit_length())[0].opened()


def tuned_factor(sample: np.ndarray, k: int, longest: float, recall: float = RECALL) -> float:
    """The greatest factor with which the sample's own neighbours are found, less a margin.

    A neighbour is missed when ``factor`` times the bound of its leaf is beyond the k-th distance;
    so each neighbour bears a factor of the one by the other, and the answer is their quantile.
    """
    tree, order = Tree.grow(lifted(sample, longest), leaf_depth(len(sample)))
    leaf = np.searchsorted(tree.edges, np.arange(len(sample)), "right") - 1
    points, asked = lifted(sample[order], longest), pointing(sample[:SAMPLE_QUERIES])
    k = min(k, len(sample))
    d = distances(asked, points)
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    rows = np.arange(len(asked))[:, None]
    bound = tree.bounds(asked)[rows, leaf[near]] - SLACK
    bears = np.where(bound > 0, d[rows, near].max(axis=1)[:, None] / np.maximum(bound, 1e-300), np.inf)
    return max(1.0, MARGIN * min(float(np.quantile(bears, 1 - recall, method="lower")), 1e6))


def build_index(
    kept: DataFrame, top: Tree | None, width: int, longest: float, shard_rows: int
) -> DataFrame:
    """``held, region, data``: a stored shard of each piece of a region, with its tree.

    Regions of more than ``shard_rows`` rows are dealt into pieces by a hash.
    """

    def grow(part: pa.Table) -> pa.Table:
        v = dense(part["v"], width)
        tree, order = Tree.grow(lifted(v, longest), leaf_depth(len(v)))
        data = dump(
            rows=numbers(part["row"])[order], ids=numbers(part["id"])[order], v=v[order],
            vantage=tree.vantage, least=tree.least, greatest=tree.greatest, edges=tree.edges,
        )
        region, piece = part["region"][0].as_py(), part["piece"][0].as_py()
        return one_row(
            ["held", "region", "data"], [f"{region}:{piece}", region, data], [pa.string(), pa.int32(), pa.binary()]
        )

    placed = dealt(with_region(kept, top, width, longest, False), "region", shard_rows)
    shards = placed.groupBy("region", "piece").applyInArrow(grow, "held string, region int, data binary")
    return materialize(shards, "shards")


def shard_of(data: bytes) -> dict:
    arrays = load(data)
    return arrays | {"tree": Tree(*(arrays[x] for x in ("vantage", "least", "greatest", "edges")))}


def ask(
    shards: DataFrame, queries: DataFrame, first: bool, k: int, width: int, longest: float, factor: float,
    top: Tree | None,
) -> DataFrame:
    """``query, row, id, score``: the best of every shard that a query may find something in.

    ``queries`` have ``row, v, region, floor``.  The first time each asks the shards of its own
    region, then those of all regions whose bound its floor allows.
    """

    def block(part: pa.Table) -> pa.Table:
        v, home = dense(part["v"], width), part["region"][0].as_py()
        points, floor = pointing(v), np.asarray(part["floor"], float)
        length = np.sqrt(np.einsum("ij,ij->i", v, v))
        data = dump(rows=numbers(part["row"]), q=v, points=points, length=length, floor=floor)
        if first or top is None:
            regions = [home] if first else []
        else:
            near = reached(top.bounds(points), floor, length, longest, factor).any(axis=0)
            regions = [r for r in np.flatnonzero(near).tolist() if r != home]
        name = f"{home}:{part['piece'][0].as_py()}"
        return one_row(
            ["asked", "regions", "data"], [name, regions, data], [pa.string(), pa.list_(pa.int32()), pa.binary()]
        )

    asked = materialize(
        dealt(queries, "region", QUERY_ROWS).groupBy("region", "piece").applyInArrow(
            block, "asked string, regions array<int>, data binary"
        ),
        "asked",
    )
    pairs = asked.select("asked", F.explode("regions").alias("region")).join(shards.select("held", "region"), "region")

    def run(shard: dict, query: dict) -> dict:
        place, row, ids, score = search(shard, shard["tree"], query, k, longest, factor)
        return {"query": query["rows"][place], "row": row, "id": ids, "score": score}

    return meet(
        shards, asked, pairs.select("held", "asked"), run, "query bigint, row bigint, id bigint, score double", shard_of
    )


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    factor: float | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors with the largest inner product found.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own.  Scores are inner products of the vectors as they are, in doubles; ties go to the smaller
    id.  With ``factor`` one the answer is exact.

    Of equal vectors the index holds the ``k + 1`` with the smallest ids, more cannot be among
    anyone's best; so a very common vector fills no shard.  Equal queries are asked once.  The
    space is cut into regions by a tree over a bounded sample; a region's rows make one
    shard or several.  A query first asks its own region; the k-th score there tells which others
    it has to ask.  Blocks of queries meet shards in tasks that hold one shard and one block.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor
    do rows without an id.  Shorter vectors count as filled up with zeros.  Rows that repeat an id are rows of
    their own.  An empty table gives no rows; with fewer candidates there are fewer ranks.  Other
    columns are not read.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = raw.filter(F.col("id").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0))
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    sum_of = F.aggregate(F.transform("v", lambda x: F.pow(x / most, F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)
    rows = materialize(
        good.select(
            F.monotonically_increasing_id().alias("row"), "id", "v", (most * F.sqrt(sum_of)).alias("length"),
            F.xxhash64("v").alias("k1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("k2"),
        ),
        "vectors",
    )
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max("length").alias("longest")).first()
    if not total["n"]:
        return empty_frame(spark, ANSWER)
    width, longest = total["width"], float(total["longest"])
    of_equal = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id", "row"))
    kept = materialize(rows.withColumn("_n", of_equal).filter(F.col("_n") <= k + 1).select("row", "id", "v"), "kept")
    n = kept.count()
    tasks = 2 * spark.sparkContext.defaultParallelism
    size = max(min(shard_rows, -(-n // tasks)), min(LEAST_SHARD_ROWS, shard_rows))
    sample = sampled(kept, width)
    top = top_tree(sample, n, size, longest)
    factor = tuned_factor(sample, k + 1, longest) if factor is None else factor
    shards = build_index(kept, top, width, longest, size)

    asking = rows.filter(F.col("id") % every == 0).select("row", "id", "k1", "k2")
    classes = rows.filter(F.col("id") % every == 0).groupBy("k1", "k2").agg(F.min(F.struct("row", "v")).alias("q"))
    queries = materialize(
        with_region(classes.select("k1", "k2", "q.row", "q.v"), top, width, longest, True), "queries"
    )
    begun = queries.select("row", "v", "region", F.lit(float("-inf")).alias("floor"))
    home = materialize(ask(shards, begun, True, k + 1, width, longest, factor, top), "home")
    if top is None:
        found = home
    else:
        place = Window.partitionBy("query").orderBy(F.desc("score"))
        kth = home.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") == k + 1)
        floors = kth.select(F.col("query").alias("row"), F.col("score").alias("floor"))
        again = queries.join(floors, "row", "left").select(
            "row", "v", "region", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
        )
        found = home.unionByName(ask(shards, again, False, k + 1, width, longest, factor, top))
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("_n") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("_n", "row", "id", "score"))).alias("best"))
    answers = queries.select("k1", "k2", F.col("row").alias("query")).join(lists, "query").drop("query")
    named = keyed_join(asking, answers, ["k1", "k2"])
    others = F.slice(F.filter("best", lambda b: b["row"] != F.col("row")), 1, k)
    return named.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score")
    )
