"""LM scoring with a hidden Markov model.

States emit word classes: each of the most frequent words is a class of its own, the others share
classes by hash; within a class a word has its smoothed relative frequency.  Baum-Welch counts of
all training documents are added across partitions, round by round; the scaled forward recursion
gives the exact probability of each whole text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import held_out, slices, small_parts, split_words, with_ends
from millrace.operators.joins import measure
from millrace.session import materialize

STATES = 6
ROUNDS = 6
#: Words with a class of their own (of at most this many bytes each), and classes of the others.
HEAD_WORDS = 32_768
HEAD_WORD_BYTES = 64
TAIL_CLASSES = 4096
TRAIN_WINDOW = 1024
BATCH_BYTES = 4 << 20
#: Tokens side by side at once: training keeps two weights of each state for each, scoring keeps none.
TRAIN_TOKENS = 1 << 20
SCORE_TOKENS = 1 << 22
#: Steps after which state weights are scaled; a step makes them smaller by some 1e-12 at most.
RESCALE = 8
COUNTER_WORDS = 200_000
#: Words and counts of a shuffle partition are looked up unsorted if they are no more than this.
HASHED_BYTES = 64 << 20
#: Share of an emission that follows the words' overall frequency.
PRIOR_SHARE = 0.05
END = b""  # no word is empty


@dataclass(frozen=True)
class Model:
    tokens: int  # N
    types: int  # V
    head: tuple[tuple[bytes, int], ...]  # most frequent words with their counts
    tail_mass: np.ndarray  # words of a tail class: their counts, their number and one for the unknown
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # classes x K


class Classes(dict):
    """Class of a word: its place in the head, or a tail class by hash."""

    def __init__(self, model: Model) -> None:
        super().__init__((w, i) for i, (w, _) in enumerate(model.head))
        self.first_tail, self.tails = len(model.head), len(model.tail_mass)

    def __missing__(self, word: bytes) -> int:
        return self.first_tail + zlib.crc32(word) % self.tails

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


# sequences side by side


def lanes(lengths: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Sequences side by side, longest first: their order, how many of them have a step t, and the
    places where they start, in that order."""
    order = np.argsort(-lengths, kind="stable")
    live = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    return order, live.tolist(), (np.cumsum(lengths) - lengths)[order]


def ratios(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log of the largest emission of every class, and emissions as shares of it: weights fall slowly."""
    top = model.emit.max(1)
    return np.log(top), model.emit / top[:, None]


def expected_counts(
    tokens: np.ndarray, lengths: np.ndarray, model: Model
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected starts, moves and emissions of some sequences, and their log likelihood."""
    k, (_, live, starts), (logs, ratio) = len(model.start), lanes(lengths), ratios(model)
    at = np.concatenate([[0], np.cumsum(live, dtype=np.int64)]).tolist()
    steps = [slice(a, a + n) for a, n in zip(at, live, strict=False)]
    laid = np.empty(len(tokens), np.intp)  # step by step
    for t, (n, here) in enumerate(zip(live, steps, strict=True)):
        laid[here] = tokens[t:].take(starts[:n])
    emitted = ratio.take(laid, axis=0)
    ahead, last, fit = np.empty_like(emitted), np.empty(len(lengths)), 0.0
    for t, (n, here) in enumerate(zip(live, steps, strict=True)):
        state = ahead[here]
        if t:
            np.matmul(ahead[at[t - 1] : at[t - 1] + n], model.move, out=state)
            state *= emitted[here]
        else:
            np.multiply(model.start, emitted[here], out=state)
        if t % RESCALE == RESCALE - 1:
            total = state.sum(1)
            fit += np.log(total).sum()
            state /= total[:, None]
            emitted[here] /= total[:, None]
        after = live[t + 1] if t + 1 < len(live) else 0
        last[after:n] = state[after:].sum(1)
    fit += np.log(last).sum() + logs.take(laid).sum()
    back, moves, first = model.move.T.copy(), np.zeros((k, k)), live[0] if live else 0
    behind, weighted, known = np.empty((first, k)), np.empty((first, k)), 0
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        behind[known:n] = 1 / last[known:n, None]
        known = n
        if t:
            np.multiply(emitted[steps[t]], behind[:n], out=weighted[:n])
            moves += ahead[at[t - 1] : at[t - 1] + n].T @ weighted[:n]
        ahead[steps[t]] *= behind[:n]
        if t:
            np.matmul(weighted[:n], back, out=behind[:n])
    by_state = emitted.reshape(k, len(tokens))  # emissions are used up, their memory is not
    by_state[:] = ahead.T
    emissions = np.stack([np.bincount(laid, weights=w, minlength=len(model.emit)) for w in by_state], 1)
    return ahead[:first].sum(0), model.move * moves, emissions, float(fit)


def log_likelihoods(tokens: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Log probability of each whole class sequence: the scaled forward recursion."""
    if not len(lengths):
        return np.zeros(0)
    k, (order, live, starts), (logs, ratio) = len(model.start), lanes(lengths), ratios(model)
    emitted, *turns = (np.empty((live[0], k)) for _ in range(3))
    scale, last = np.zeros(len(lengths)), np.empty(len(lengths))
    for t, n in enumerate(live):
        state = turns[t % 2][:n]
        ratio.take(tokens[t:].take(starts[:n]), axis=0, out=emitted[:n], mode="clip")
        if t:
            np.matmul(turns[1 - t % 2][:n], model.move, out=state)
            state *= emitted[:n]
        else:
            np.multiply(model.start, emitted[:n], out=state)
        if t % RESCALE == RESCALE - 1:
            total = state.sum(1)
            scale[:n] += np.log(total)
            state /= total[:, None]
        after = live[t + 1] if t + 1 < len(live) else 0
        last[after:n] = state[after:].sum(1)
    out = np.add.reduceat(logs.take(tokens), np.cumsum(lengths) - lengths)
    out[order] += scale + np.log(last)
    return out


# training


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over all rows of ``docs(text)``; each text ends in ``END``.

    Tasks add up what they hold of the vocabulary before the shuffle, ``COUNTER_WORDS`` words at
    a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            counted = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(counted, ["word", "c"])

        for part in small_parts(batches, 0, BATCH_BYTES):
            split = split_words(part.column(0))
            counted = np.bincount(split.at, minlength=len(split.distinct)).tolist()
            held.update(dict(zip(split.distinct.to_pylist(), counted, strict=True)))
            held[END] += part.num_rows
            if len(held) > COUNTER_WORDS:
                yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def initial_model(counts: DataFrame, states: int, head_words: int, tail_classes: int, seed: int) -> Model:
    """Class masses from the stored counts, and states told apart by fixed noise.

    The driver gets the totals, the head (bounded in words and bytes) and one sum per tail class.
    """
    if head_words + tail_classes > 1 << 16:
        raise ValueError("class numbers have 16 bits")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    short = counts.filter(F.octet_length("word") <= HEAD_WORD_BYTES)
    order = [(F.col("word") == F.lit(END)).desc(), F.col("c").desc(), F.col("word")]
    head = [(bytes(r["word"]), r["c"]) for r in short.orderBy(*order).limit(head_words).collect()]
    spark = counts.sparkSession
    in_head = spark.createDataFrame(head, "word binary, c bigint").select("word")
    tail_class = (F.crc32("word") % tail_classes).cast("int")
    sums = (
        counts.join(F.broadcast(in_head), "word", "left_anti")  # at most HEAD_WORDS short words
        .groupBy(tail_class.alias("b"))
        .agg((F.sum("c") + F.count("*")).alias("mass"))
        .collect()
    )
    tail = np.ones(tail_classes)
    for r in sums:
        tail[r["b"]] += r["mass"]
    mass = np.concatenate([[c + 1.0 for _, c in head], tail])
    noise = np.random.default_rng(seed).normal(size=(len(mass), states))
    emit = (mass / mass.sum())[:, None] * np.exp(noise)
    stay = 0.9 if states > 1 else 1.0
    move = np.full((states, states), (1 - stay) / max(states - 1, 1))
    np.fill_diagonal(move, stay)
    return Model(
        total["n"] or 0, total["v"], tuple(head), tail, np.full(states, 1 / states), move, emit / emit.sum(0)
    )


def coded_documents(rows: DataFrame, model: Model) -> DataFrame:
    """``rows(row, id, learn, text)`` with texts as what training and scoring need of them, split once.

    ``ids``: the class numbers of the whole text; ``n``: how many; ``known`` and ``base``: how many are
    words of the head, and the logs of their counts; ``within``: the logs of the masses of the other
    words' classes; ``rare``: each of those words and how often it is there.
    """
    heads, tails = len(model.head), len(model.tail_mass)
    in_head = np.repeat([1, 0], [heads, tails])
    head_logs = np.concatenate([np.log10([c + 1.0 for _, c in model.head]), np.zeros(tails)])
    tail_logs = np.concatenate([np.zeros(heads), np.log10(model.tail_mass)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(model)
        for part in small_parts(batches, 3, BATCH_BYTES):
            n, split = part.num_rows, split_words(part.column(3))
            of_word = classes.of(split.distinct.to_pylist())
            lengths = split.sizes + 1
            tokens = with_ends(of_word[split.at], split.sizes, classes[END])
            ends = np.cumsum(lengths)
            sums = [np.add.reduceat(of_class.take(tokens), ends - lengths) for of_class in (in_head, head_logs, tail_logs)]
            places = pa.py_buffer(np.concatenate([[0], ends * 2]).astype(np.int32))
            ids = pa.Array.from_buffers(pa.binary(), n, [None, places, pa.py_buffer(tokens.astype("<u2"))])
            rare = of_word[split.at] >= heads
            types = max(len(split.distinct), 1)
            pairs, times = np.unique(np.repeat(np.arange(n), split.sizes)[rare] * types + split.at[rare], return_counts=True)
            words = split.distinct.take(pa.array(pairs % types)).cast(pa.binary())
            counted = pa.StructArray.from_arrays([words, pa.array(times, pa.int64())], ["word", "n"])
            by_row = np.searchsorted(pairs, np.arange(n + 1) * types).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), part.column(2), pa.array(lengths, pa.int64()),
                    *[pa.array(x, kind) for x, kind in zip(sums, (pa.int64(), pa.float64(), pa.float64()), strict=True)],
                    ids, pa.ListArray.from_arrays(pa.array(by_row), counted),
                ],
                names,
            )

    names = ["row", "id", "learn", "n", "known", "base", "within", "ids", "rare"]
    kind = rows.schema["id"].dataType.simpleString()
    shape = (
        f"row bigint, id {kind}, learn boolean, n bigint, known bigint, base double, within double, ids binary, "
        "rare array<struct<word: binary, n: bigint>>"
    )
    return rows.select("row", "id", "learn", "text").mapInArrow(run, shape)


def class_numbers(ids: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts with ``most`` tokens or little more: from, to, the class numbers and the lengths."""
    data = ids.to_pylist()
    for a, b in slices((len(x) // 2 for x in data), most):
        lengths = np.array([len(x) // 2 for x in data[a:b]])
        yield a, b, np.frombuffer(b"".join(data[a:b]), "<u2"), lengths


def windows(lengths: np.ndarray) -> np.ndarray:
    """Lengths of the windows of ``TRAIN_WINDOW`` tokens of texts; a text's last one has what is left."""
    many = -(-lengths // TRAIN_WINDOW)
    out = np.full(int(many.sum()), TRAIN_WINDOW)
    out[np.cumsum(many) - 1] = lengths - (many - 1) * TRAIN_WINDOW
    return out


def train_round(sequences: DataFrame, model: Model) -> tuple[Model, float]:
    """One round of Baum-Welch over the windows of all ``sequences(ids)``; the new model and the old one's likelihood.

    Every task adds up its expected counts; they are summed by class across partitions, so that
    the driver gets one row per class, whatever the corpus.
    """
    k = len(model.start)
    names = [f"s{i}" for i in range(k)]
    learner = replace(model, head=())  # classes are told already

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, moves, emissions, fit = np.zeros(k), np.zeros((k, k)), np.zeros(learner.emit.shape), 0.0
        for batch in batches:
            for _, _, tokens, lengths in class_numbers(batch.column(0), TRAIN_TOKENS):
                parts = windows(lengths)
                ends = np.cumsum([0, *parts])
                for a, b in slices(parts.tolist(), TRAIN_TOKENS + TRAIN_TOKENS // 4):  # more than that in long texts only
                    s, m, e, f = expected_counts(tokens[ends[a] : ends[b]], parts[a:b], learner)
                    starts, moves, emissions, fit = starts + s, moves + m, emissions + e, fit + f
        used = np.flatnonzero(emissions.sum(1))
        rows = np.concatenate([emissions[used], moves, [starts], [np.full(k, fit)]])
        index = np.concatenate([used, -1 - np.arange(k), [-1 - k, -2 - k]])
        yield pa.RecordBatch.from_arrays([pa.array(index), *[pa.array(rows[:, i]) for i in range(k)]], ["i", *names])

    shape = "i bigint, " + ", ".join(f"{n} double" for n in names)
    summed = sequences.mapInArrow(run, shape).groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect()
    counts, moves, starts, fit = np.zeros((len(model.emit), k)), np.zeros((k, k)), np.zeros(k), 0.0
    for r in summed:
        values = np.array(r[1:])
        if r["i"] >= 0:
            counts[r["i"]] = values
        elif r["i"] >= -k:
            moves[-1 - r["i"]] = values
        elif r["i"] == -1 - k:
            starts = values
        else:
            fit = values[0]
    mass = np.concatenate([[c + 1.0 for _, c in model.head], model.tail_mass])
    prior = (mass / mass.sum())[:, None]
    # every word's extra count, as in add-one smoothing, goes to the states by their shares
    added = np.maximum(mass - counts.sum(1), 0)[:, None]
    share = counts.sum(0) / counts.sum() if counts.sum() else np.full(k, 1 / k)
    seen = counts + added * np.maximum(share, 1e-6)
    seen /= seen.sum(0)
    move = moves + 0.01
    return replace(
        model,
        start=(starts + 0.01) / (starts.sum() + 0.01 * k),
        move=move / move.sum(1, keepdims=True),
        emit=(1 - PRIOR_SHARE) * seen + PRIOR_SHARE * prior,
    ), fit


def fit_model(
    docs: DataFrame, counts: DataFrame, states: int = STATES, rounds: int = ROUNDS, head_words: int = HEAD_WORDS,
    tail_classes: int = TAIL_CLASSES, seed: int = 7,
) -> tuple[Model, list[float]]:
    """The model of ``docs(text)`` and the log likelihood before each round."""
    model = initial_model(counts, states, head_words, tail_classes, seed)
    rows = docs.select(F.lit(0).cast("bigint").alias("row"), F.lit("").alias("id"), F.lit(True).alias("learn"), "text")
    return train(materialize(coded_documents(rows, model).select("ids"), "coded"), model, rounds)


def train(sequences: DataFrame, model: Model, rounds: int) -> tuple[Model, list[float]]:
    """The model after ``rounds`` over ``sequences(ids)``, and the log likelihood before each."""
    fits = []
    for _ in range(rounds):
        model, fit = train_round(sequences, model)
        fits.append(fit)
    return model, fits


# scoring


def looked_up(counts: DataFrame) -> DataFrame:
    """``counts`` for a join without sorts, if a partition of them is measured to fit in memory."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.hint("shuffle_hash") if measure(counts).bytes <= parts * HASHED_BYTES else counts


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS,
    head_words: int = HEAD_WORDS, tail_classes: int = TAIL_CLASSES, modulus: int = 7,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document.

    ``base_score`` is the add-one unigram score; ``score`` the log10 probability of the whole
    text under the model: the forward recursion over its classes, and each word within its
    class, where all words that were not learned share one place per tail class.  Training has
    all documents outside the held-out fold, in windows of ``TRAIN_WINDOW`` tokens, each a
    sequence; scores are of whole texts.

    The vocabulary is never sent to tasks: they hold the head, and rarer words are joined to
    their counts as (document, word) pairs, none of them frequent.

    A null text is empty: its one token is the end.  A null id counts as '' in the fold rule.
    Repeated rows are scored each (and learned from each).  With nothing to learn from, the base
    score is 0 and every word is unknown.  Other columns are ignored.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    learn = ~held_out(F.col("id"), modulus)
    counts = materialize(word_counts(given.filter(learn).select("text")).filter(F.col("c") > 0), "counts")
    model = initial_model(counts, states, head_words, tail_classes, 7)
    rows = given.select(F.monotonically_increasing_id().alias("row"), "id", learn.alias("learn"), "text")
    coded = materialize(coded_documents(rows, model), "coded")
    model, _ = train(coded.filter("learn").select("ids"), model, rounds)
    scorer = replace(model, head=())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, tokens, lengths in class_numbers(batch.column(5), SCORE_TOKENS):
                part = batch.slice(a, b - a)
                score = log_likelihoods(tokens, lengths, scorer) / math.log(10) - np.asarray(part.column(6))
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(score, pa.float64())], names)

    names = ["row", "id", "n", "known", "base", "score"]
    kind = rows.schema["id"].dataType.simpleString()
    scored = materialize(
        coded.select(*names[:5], "ids", "within").mapInArrow(
            run, f"row bigint, id {kind}, n bigint, known bigint, base double, score double"
        ),
        "scored",
    )
    rare = (
        coded.select("row", F.inline("rare"))
        .join(looked_up(counts), "word")
        .groupBy("row")
        .agg(F.sum("n").alias("rare"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log"))
    )
    size = math.log10(model.tokens + model.types + 1)
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return (
        scored.join(rare, "row", "left")
        .select(
            F.col("id").alias(id_col),
            held_out(F.col("id"), modulus).alias("held_out"),
            F.col("n").alias("n_tokens"),
            (F.col("known") + F.coalesce("rare", F.lit(0))).alias("n_known"),
            F.lit(model.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + rare_log - F.col("n") * size).alias("base_score"),
            (F.col("score") + rare_log).alias("score"),
        )
    )
