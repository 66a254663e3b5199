"""Benchmark decontamination: a prefix-filtered join of word shingles, verified word by word.

A window of an item lies in a document only if every shingle of the window does, so one of them
is enough to find it: the one that is rarest in the documents.  Documents look up their shingles
among those few; each find says where the window would have to begin, which bounds the place, and
the words there decide.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import give_back, model_of, slices, small_batches, small_parts, utf8
from millrace.operators.joins import fits_broadcast, measure
from millrace.session import materialize

SHINGLE = 3
BITMAP_BITS = 1 << 24
BATCH_BYTES = 1 << 20

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def item_words(text: bytes | None) -> list[bytes]:
    """Runs of letters a-z (A-Z lower-cased), digits and all characters beyond ASCII."""
    return text.translate(_WORD_BYTES).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def shingle_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key for each run of ``size`` words, in order of their first word."""
    n = max(len(hashes) - size + 1, 0)
    key = np.full(n, size, np.uint64)
    for i in range(size):
        key = (key ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _bit(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) >> np.uint64(40)


class Bitmap:
    """A fixed-size filter of keys: it passes every key it holds and few others."""

    def __init__(self, words: dict[int, int]) -> None:
        packed = np.zeros(BITMAP_BITS // 64, "<i8")
        if words:
            packed[list(words)] = list(words.values())
        self.bits = packed.view(np.uint8)

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> Bitmap:
        """Built by an aggregate of at most ``BITMAP_BITS / 64`` rows, whatever the keys."""
        place = F.shiftrightunsigned(F.col(column), 40)
        rows = (
            keys.groupBy(F.shiftright(place, 6).alias("w"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, 40) & 63 as int))")).alias("v"))
            .collect()
        )
        return cls({r["w"]: r["v"] for r in rows})

    def passes(self, keys: np.ndarray) -> np.ndarray:
        place = _bit(keys)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _finds(
    texts: list[bytes | None], filters: dict[int, Bitmap]
) -> tuple[list[list[bytes]], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Words of each text; and for each shingle size the text, place and key of each find."""
    split = [item_words(t) for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    owner, first = np.repeat(np.arange(len(split)), counts), np.cumsum(counts) - counts
    hashes = word_hashes([w for ws in split for w in ws])
    finds = []
    for size, bitmap in filters.items():
        keys = shingle_keys(hashes, size)
        at = np.flatnonzero(bitmap.passes(keys))
        at = at[owner[at] == owner[at + size - 1]]
        finds.append((owner[at], at - first[owner[at]], keys[at]))
    return split, finds


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``item, words, n, size, keys``: each window with its shingles' keys, in order.

    A window is ``window`` consecutive words; an item of fewer, but not none, is one window.
    Shingles have ``SHINGLE`` words, or all words of a shorter window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, sizes, keys = [], [], [], []
            for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = item_words(text)
                n = min(window, len(words))
                for i in range(len(words) - n + 1 if words else 0):
                    part = words[i : i + n]
                    names.append(name)
                    texts.append(b" ".join(part).decode())
                    sizes.append(n)
                    keys.append(shingle_keys(word_hashes(part), min(SHINGLE, n)).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()),
                    pa.array([min(SHINGLE, n) for n in sizes], pa.int32()), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["item", "words", "n", "size", "keys"],
            )

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, words string, n int, size int, keys array<bigint>")


def shingle_counts(docs: DataFrame, filters: dict[int, Bitmap], text_col: str) -> DataFrame:
    """``key, seen`` over all documents, for the shingles that pass; added up in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of()
        for batch in batches:
            found = []
            for part in small_parts([batch], 0, BATCH_BYTES):
                found += [keys for _, _, keys in _finds(utf8(part.column(0)), filters)[1]]
            keys, seen = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(seen)], ["key", "seen"])
        give_back()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key bigint, seen bigint")
    return counted.groupBy("key").agg(F.sum("seen").alias("seen"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document.

    ``n_hit`` counts the document's words inside any occurrence of any item's window, ``n_items``
    the items with an occurring window; ``items_sha256`` is the SHA-256 of their ids, sorted as
    strings and joined by commas (of '' if there are none).

    The documents are read twice: to count how often each shingle of an item occurs, and to look
    up the rarest of each window.  What tasks get of the items is a bitmap of fixed size; all
    else is joined, with the items broadcast only if they were measured small.  A popular
    passage gathers only where it is its rarest shingle that is popular, and then the join is
    split.

    Null and empty texts have no words and no hits.  Repeated documents and null ids give a row
    each; repeated items count once; an item without an id marks words but is not counted.
    Either table may be empty.  Other columns are ignored.
    """
    with small_batches(docs.sparkSession, 10_000):
        return _find_items(docs, items, window, id_col, text_col, item_id_col, item_text_col)


def _find_items(
    docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str
) -> DataFrame:
    windows = materialize(item_windows(items, window, item_id_col, item_text_col), "windows")
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]
    keys = windows.select("size", F.explode("keys").alias("key"))
    every = {s: Bitmap.of(keys.filter(F.col("size") == s), "key") for s in sizes}
    counts = materialize(shingle_counts(docs, every, text_col), "shingle-counts")
    prefixes = windows.select("item", "words", "n", "size", F.posexplode("keys").alias("lead", "key")).join(
        counts, "key", "left"
    )
    rarest = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "lead", "key"))
    prefixes = materialize(
        prefixes.groupBy("item", "words", "n", "size").agg(rarest.alias("r"))
        .filter(F.col("r.seen") > 0)  # else no document holds the window
        .select("item", "words", "n", "size", "r.lead", "r.key"),
        "prefixes",
    )
    chosen = {s: Bitmap.of(prefixes.filter(F.col("size") == s), "key") for s in sizes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of()
        for batch in batches:
            for part in small_parts([batch], 2, BATCH_BYTES):
                split, finds = _finds(utf8(part.column(2)), chosen)
                row, name = part.column(0), part.column(1)
                n_words = pa.array([len(w) for w in split], pa.int64())
                nothing = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [row, name, n_words, nothing, nothing, nothing, pa.nulls(part.num_rows, pa.list_(pa.string()))], columns
                )
                for owner, place, key in finds:
                    for i, j in slices((1 for _ in owner), 50_000):
                        o = pa.array(owner[i:j])
                        near = [
                            [w.decode() for w in split[d][max(0, p - window) : p + window]]
                            for d, p in zip(owner[i:j].tolist(), place[i:j].tolist(), strict=True)
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                row.take(o), name.take(o), n_words.take(o), pa.array(key[i:j]), pa.array(place[i:j]),
                                pa.array(np.minimum(place[i:j], window)), pa.array(near, pa.list_(pa.string())),
                            ],
                            columns,
                        )
        give_back()

    columns = ["row", "id", "n_words", "key", "place", "before", "near"]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    looked = materialize(
        rows.mapInArrow(
            run,
            f"row bigint, id {kind}, n_words bigint, key bigint, place bigint, before bigint, near array<string>",
        ),
        "finds",
    )
    given = F.broadcast(prefixes) if fits_broadcast(measure(prefixes)) else prefixes
    start = F.col("place") - F.col("lead")
    there = F.array_join(F.slice("near", (F.col("before") - F.col("lead") + 1).cast("int"), F.col("n")), " ")
    hits = (
        looked.filter(F.col("key").isNotNull())
        .join(given, "key")
        .filter((F.col("lead") <= F.col("before")) & (start + F.col("n") <= F.col("n_words")))
        .filter(there == F.col("words"))
        .select("row", "item", start.alias("start"), "n")
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set("item").alias("items"))
    )
    inside = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    )
    listed = F.array_join(F.array_sort("items"), ",")
    return (
        looked.filter(F.col("key").isNull())
        .select("row", "id", "n_words")
        .join(hits, "row", "left")
        .select(
            F.col("id").alias(id_col), "n_words",
            F.coalesce(F.array_size(inside), F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.array_size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce(listed, F.lit("")), 256).alias("items_sha256"),
            F.col("spans").isNotNull().alias("contaminated"),
        )
    )
