"""MinHash near-dedup with min-max hashing.

Each permutation of the shingles yields two values, the smallest and the largest; either agrees
between two sets with the probability of their similarity.  Half as many permutations give
signatures of the same length, and of less variance.  Bands of four values bring candidates
together; full sets confirm them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import give_back, model_of, small_batches, small_parts, split_words
from millrace.operators.joins import fits_broadcast, keyed_join, measure
from millrace.session import materialize, release

SHINGLE_WORDS = 4
PERMUTATIONS = 48
BAND_ROWS = 4
#: Buckets of at most this many texts are compared whole at once; larger ones through a hub first.
SMALL_BUCKET = 16
#: First shingles of a set that travel with each of its rows in a join.
CARRIED = 256
#: Text that a task turns into words at once; they take some twenty times its room.
BATCH_BYTES = 1 << 20
STEP = 1024

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    draw = lambda: rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
    return draw() | np.uint64(1), draw()


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words, one of them all."""
    size = min(size, len(hashes))
    n = len(hashes) - size + 1 if size else 0
    runs = np.full(n, size, np.uint64)
    for i in range(size):
        runs = _stir(runs) + hashes[i : i + n]
    return np.unique(_stir(runs))


def text_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of a string column."""
    words = split_words(texts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.distinct.to_pylist()), np.uint64, len(words.distinct))
    at, ends = hashes[words.at], np.cumsum(words.sizes)
    for start, end in zip((ends - words.sizes).tolist(), ends.tolist(), strict=True):
        yield shingle_set(at[start:end], size)


def set_key(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def band_keys(items: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Keys of the bands: for each four permutations one of their minima, one of their maxima."""
    factor, shift = permutations(n)
    low, high = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    for i in range(0, len(items), STEP):
        turned = items[i : i + STEP, None] * factor + shift
        np.minimum(low, turned.min(0), out=low)
        np.maximum(high, turned.max(0), out=high)
    values = np.concatenate([low, high]).reshape(-1, BAND_ROWS)
    keys = np.arange(len(values), dtype=np.uint64)
    for i in range(BAND_ROWS):
        keys = _stir(keys) + values[:, i]
    return _stir(keys).view(np.int64)


def signatures(docs: DataFrame, size: int, n: int) -> DataFrame:
    """``id, n_shingles, set_key, bands`` of every row of ``docs(id, text)``; no key without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of()
        for part in small_parts(batches, 1, BATCH_BYTES):
            sizes, keys, bands = [], [], []
            for items in text_sets(part.column(1), size):
                sizes.append(len(items))
                keys.append(set_key(items) if len(items) else None)
                bands.append(band_keys(items, n) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "set_key", "bands"],
            )
        give_back()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, n_shingles bigint, set_key binary, bands array<bigint>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``cls, items`` for the classes of ``wanted(cls, rep, set_key)``: the set as sorted bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of()
        for part in small_parts(batches, 2, BATCH_BYTES):
            keys, same, sets = part.column(1).to_pylist(), [], []
            for i, items in enumerate(text_sets(part.column(2), size)):
                if set_key(items) == keys[i]:
                    same.append(i)
                    sets.append(items.tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(same, pa.int64())), pa.array(sets, pa.binary())], ["cls", "items"]
            )
        give_back()

    stored = materialize(wanted, "wanted")
    side = F.broadcast(stored) if fits_broadcast(measure(stored)) else stored
    rows = docs.join(side, F.col("id") == F.col("rep")).select("cls", "set_key", "text")
    sets = materialize(rows.mapInArrow(run, "cls bigint, items binary").dropDuplicates(["cls"]), "sets")
    release(stored)
    return sets


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, similarity, linked`` of the pairs ``(a, b)``, from their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar, linked = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                either = len(x) + len(y) - both
                similar.append(both / either)
                linked.append(100 * both >= percent * either)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(similar, pa.float64()), pa.array(linked, pa.bool_())],
                ["a", "b", "similarity", "linked"],
            )
        give_back()

    named = lambda key, items: sets.select(F.col("cls").alias(key), F.col("items").alias(items))
    rows = pairs.join(named("a", "x"), "a").join(named("b", "y"), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a bigint, b bigint, similarity double, linked boolean")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``cls, comp`` after joining the components of ``labels(cls, comp)`` that ``links(a, b)`` touch.

    The smallest label spreads along links between components, and each label is replaced by the
    label of its label, so that chains halve with every step.  Every step is a stored table.
    """
    comp = lambda side: labels.select(F.col("cls").alias(side), F.col("comp").alias(f"c{side}"))
    between = (
        links.join(comp("a"), "a").join(comp("b"), "b").filter("ca <> cb")
        .select(F.least("ca", "cb").alias("u"), F.greatest("ca", "cb").alias("v")).distinct()
    )
    both = materialize(between.unionByName(between.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
    state = materialize(both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    if state.isEmpty():
        release(both, state)
        return labels
    held = state
    while True:
        near = (
            both.join(state, F.col("v") == F.col("node")).groupBy("u").agg(F.min("root").alias("least"))
        )
        spread = state.join(near, F.col("node") == F.col("u"), "left").select(
            "node", "root", F.least("root", "least").alias("next")
        )
        step = materialize(spread, "roots")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = materialize(
            step.join(jump, "next", "left").select("node", "root", F.least("next", "far").alias("new")), "roots"
        )
        release(held, step)
        held = moved
        changed = not moved.filter(F.col("new") != F.col("root")).isEmpty()
        state = moved.select("node", F.col("new").alias("root"))
        if not changed:
            break
    roots = state.select(F.col("node").alias("comp"), "root")
    joined = materialize(
        labels.join(roots, "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp")), "labels"
    )
    release(both, held, labels)
    return joined


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    shingle_words: int = SHINGLE_WORDS,
    permutations_: int = PERMUTATIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of distinct
    shingles; ``component_id`` is the smallest id that links lead to, ``kept`` tells whether it is
    the document's own.

    Equal sets are one class from the start, so copies never meet in a bucket.  Candidates are
    classes that share a band.  The hub of a bucket is the class that meets most others in all
    its buckets, which is near the middle of a family.  First each class is compared with the
    best of its hubs; then the classes of small buckets with one another and those of large
    buckets with the bucket's hub.  Classes of large buckets that still hold several components
    do not meet all with all: two sets that are similar enough share one of their rarest
    shingles (``prefix_pairs``), so only those that do are compared.  In a family whose members
    are less alike, the rare shingles of each are its own.
    Pairs within one component need no comparison any more, and neither do pairs whose distances
    to the hub they have in common differ by more than a link allows (1 minus the similarity is
    a metric).  So a family of near copies costs little more than a comparison each, and nothing
    is capped.  Only the sets of candidates are fetched.  Superseded tables are deleted.

    The chance to miss a link at exactly 80 % is that of sharing none of 24 bands, 3 in a
    million, and at 85 % 2 in a hundred million; a link that is missed matters only if nothing
    else connects the two.

    Texts of fewer words have their whole sequence as one shingle; null, empty and blank texts
    have none and are linked with nothing.  A row without an id is linked with nothing and kept.
    Rows that repeat an id are rows of their own with that id; other columns are ignored; an
    empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, percent, shingle_words, permutations_, id_col, text_col, small_bucket)


def _near_duplicates(
    docs: DataFrame, percent: int, shingle_words: int, permutations_: int, id_col: str, text_col: str, small_bucket: int
) -> DataFrame:
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = materialize(signatures(given, shingle_words, permutations_), "signatures")
    classes = materialize(
        signed.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    labels = link_classes(given, classes, percent, shingle_words, small_bucket)
    names = classes.select("cls", "set_key", "rep").join(labels, "cls")
    least = names.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_key = materialize(names.join(least, "comp").select("set_key", "component_id"), "components")
    release(classes, labels)
    linked = F.col("id").isNotNull() & F.col("set_key").isNotNull()
    found = keyed_join(
        signed.select("id", "n_shingles", F.when(linked, F.col("set_key")).alias("set_key")), by_key, ["set_key"],
        "left", measure(by_key),
    )
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def prefix_pairs(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of ``unsettled(cls, n, comp, pivot, similarity)`` that may be similar enough.

    Shingles are ordered by how many of these classes hold them, rare ones first.  Sets ``A`` and ``B``
    with ``100 |A and B| >= percent |A or B|`` share at least one of their first
    ``n - ceil(percent n / 100) + 1`` shingles, so only those are joined.  Of two sets' first shingles
    (at most ``CARRIED`` of them travel along) ``m`` agree.  The set whose last one comes earlier in the
    order has no other match for them, so both have at most ``m`` and the rest of that set in common;
    what is too little for a link does not leave the join, nor does a pair leave it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                items = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                for at in range(0, len(items), 1 << 16):
                    part = items[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), batch.column(0)[i].as_py())), pa.array(part)], ["cls", "item"]
                    )

    held = sets.join(unsettled.select("cls"), "cls").select("cls", "items")
    every = materialize(held.mapInArrow(run, "cls bigint, item bigint"), "items")
    counts = every.groupBy("item").agg(F.count("*").alias("held"))
    place = F.row_number().over(Window.partitionBy("cls").orderBy("held", "item")) - 1
    first = F.col("n") - F.ceil(F.col("n") * F.lit(percent / 100) - F.lit(1e-9)) + 1
    placed = every.join(counts, "item").withColumn("place", place).join(unsettled, "cls")
    ranked = F.struct("held", "item")
    heads = placed.filter(F.col("place") < F.least(first, F.lit(CARRIED))).groupBy("cls").agg(
        F.collect_list(F.when(F.col("held") > 1, F.col("item"))).alias("head"),  # at most CARRIED
        F.max(ranked).alias("last"), F.count("*").alias("p"),
    )
    prefixes = materialize(
        placed.filter((F.col("place") < first) & (F.col("held") > 1)).drop("held", "place").join(heads, "cls"), "prefixes"
    )
    side = lambda s: prefixes.select(
        F.col("item").alias(f"item_{s}"), F.col("cls").alias(s),
        *[F.col(c).alias(f"{c}_{s}") for c in ("n", "comp", "pivot", "similarity", "head", "last", "p")],
    )
    same = F.array_intersect("head_a", "head_b")
    rest = F.when(F.col("last_a") <= F.col("last_b"), F.col("n_a") - F.col("p_a")).otherwise(F.col("n_b") - F.col("p_b"))
    slack = 1 - percent / 100 + 1e-9
    near = (
        (F.col("a") < F.col("b")) & (F.col("comp_a") != F.col("comp_b"))
        & (F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
        & (F.coalesce(F.col("pivot_a") != F.col("pivot_b"), F.lit(True))
           | (F.abs(F.col("similarity_a") - F.col("similarity_b")) <= slack))
        & (F.lit(100 + percent) * (F.size(same) + rest) >= F.lit(percent) * (F.col("n_a") + F.col("n_b")))
        # what is left leaves the join once
        & ((F.size(same) == 0) | (F.array_min(same) == F.col("item_a")))
    )
    pairs = side("a").join(side("b"), (F.col("item_a") == F.col("item_b")) & near)
    found = materialize(pairs.select("a", "b").distinct(), "prefix-pairs")
    release(every, prefixes)
    return found


def link_classes(docs: DataFrame, classes: DataFrame, percent: int, shingle_words: int, small_bucket: int) -> DataFrame:
    """``cls, comp`` of all classes: which of them links connect."""
    placed = classes.select("cls", "n", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    met = materialize(placed.join(shared, "band"), "met")
    degrees = met.groupBy("cls").agg(F.sum("size").alias("degree"))
    with_degree = materialize(met.join(degrees, "cls"), "met")
    release(met)
    met = with_degree
    hub_of = met.groupBy("band").agg(F.max(F.struct("degree", "cls")).alias("hub"))
    members = materialize(
        met.join(hub_of, "band").select(
            "band", "cls", "n", "size", F.col("hub.cls").alias("hub"), F.col("hub.degree").alias("reach")
        ),
        "members",
    )
    labels = materialize(classes.select("cls", F.col("cls").alias("comp")), "labels")
    sizes = classes.select("cls", "n")
    size_of = lambda side: sizes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"))
    alike = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep", "set_key"), "cls")
    sets = full_sets(docs, wanted, shingle_words)
    tried: DataFrame | None = None
    spent: list[DataFrame] = []  # released at the end

    def compare(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Compares the pairs ``(a, b)`` of different components that were not tried yet; returns
        the labels then and what was found."""
        nonlocal tried
        comp = lambda side: labels.select(F.col("cls").alias(side), F.col("comp").alias(f"c{side}"))
        apart = pairs.join(comp("a"), "a").join(comp("b"), "b").filter("ca <> cb").select("a", "b").distinct()
        fresh = materialize(apart if tried is None else apart.join(tried, ["a", "b"], "left_anti"), "pairs")
        spent.append(fresh)
        tried = fresh if tried is None else tried.unionByName(fresh)
        found = materialize(compared(fresh, sets, percent), "compared")
        spent.append(found)
        return components(labels, found.filter("linked").select("a", "b")), found

    sized = lambda pairs: pairs.join(size_of("a"), "a").join(size_of("b"), "b").filter(alike).select("a", "b")
    to_hub = members.filter(F.col("cls") != F.col("hub"))
    best = to_hub.groupBy("cls").agg(F.max(F.struct("reach", "hub")).alias("h"))
    labels, first = compare(best.select(F.col("h.hub").alias("a"), F.col("cls").alias("b")))
    pivots = first.select(F.col("b").alias("cls"), F.col("a").alias("pivot"), "similarity")

    one = members.filter(F.col("size") <= small_bucket).select("band", F.col("cls").alias("a"), F.col("n").alias("na"))
    other = one.select("band", F.col("a").alias("b"), F.col("na").alias("nb"))
    within = one.join(other, "band").filter((F.col("a") < F.col("b")) & alike).select("a", "b")
    hubs = to_hub.filter(F.col("size") > small_bucket).select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    labels, _ = compare(within.unionByName(sized(hubs)))

    large = members.filter(F.col("size") > small_bucket).select("band", "cls", "n").join(labels, "cls")
    split = large.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    left = large.join(split.select("band"), "band").select("cls", "n", "comp").distinct().join(pivots, "cls", "left")
    unsettled = materialize(left, "unsettled")
    pairs = prefix_pairs(unsettled, sets, percent)
    labels, _ = compare(pairs)
    release(sets, members, met, unsettled, pairs, *spent)
    return labels
