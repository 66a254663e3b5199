"""Token-ID output: one wavelet matrix per shard, read back by position or by token.

A shard file holds bit-planes of frequency-ranked token codes, most significant first.  Below a
plane all tokens whose bit is 0 precede those whose bit is 1, each in their order, so that rank
on the planes leads from a position to a token and from a token to its places.  Planes lie in
blocks that are compressed apart, with the count of ones before each block: a look-up reads one
block per plane, never the shard.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import give_back, model_of, open_file, put_file, slices, small_batches, small_parts, split_words, with_ends
from millrace.session import materialize, scratch_path

MAGIC = b"WVMX1\0"
BLOCK_BYTES = 1 << 16
STEP = 1 << 18
SHARD_TOKENS = 4 << 20
ENCODE_BYTES = 4 << 20
KNOWN_WORDS = 300_000
LINE_WORDS = 256
#: Lines, and bytes of single words, in a call of the library; its answers take many times their room.
LINES, CALL_BYTES = 16, 1 << 16
#: Signs that words end in; an apostrophe may belong to letters.
SIGNS = b"!#$%&()*+,-./:;=?@[]^_{|}~"
CUT_PROBE_PARTS = ["word", "." + SIGNS.decode(), " ", "\u00e9t\u00e9", ",,,", " ", "x", "!?"]
CUT_PROBE = "".join(CUT_PROBE_PARTS)
END_WORD = b""  # no word is empty
NOTHING = None  # in place of signs
READ_TASKS = 20_000


# one shard as bytes


def parted(seq: np.ndarray, bit: np.ndarray, zeros: int) -> np.ndarray:
    """Values without the bit, then those with it, each in their order.

    Places of ``STEP`` values at a time are taken: a mask costs numpy three times as much.
    """
    out, low, high = np.empty_like(seq), 0, zeros
    for a in range(0, len(seq), STEP):
        some, has = seq[a : a + STEP], bit[a : a + STEP]
        without, having = np.flatnonzero(~has), np.flatnonzero(has)
        out[low : low + len(without)] = some.take(without)
        out[high : high + len(having)] = some.take(having)
        low, high = low + len(without), high + len(having)
    return out


def folded(seq: np.ndarray, bit: np.ndarray, zeros: int, value: int) -> np.ndarray:
    """What ``parted`` was given, with ``value`` added where the bit is."""
    out, low, high = np.empty_like(seq), 0, zeros
    for a in range(0, len(seq), STEP):
        some, has = out[a : a + STEP], bit[a : a + STEP]
        without, having = np.flatnonzero(~has), np.flatnonzero(has)
        some[without] = seq[low : low + len(without)]
        some[having] = seq[high : high + len(having)] | seq.dtype.type(value)
        low, high = low + len(without), high + len(having)
    return out


def build(ids: np.ndarray | list[np.ndarray], doc_ids: pa.Array, lengths: np.ndarray) -> Iterator[bytes]:
    """The parts of a shard file.

    Ids may come in a list of arrays that follow one another; it is emptied as they are taken, so that
    ids and their codes are not both held whole.
    """
    packer = zstandard.ZstdCompressor(level=1)
    blobs: list[bytes] = []
    end = 0

    def keep(raw: bytes) -> tuple[int, int]:
        """Where a blob lies: its offset and size."""
        nonlocal end
        blobs.append(packer.compress(raw))
        end += len(blobs[-1])
        return end - len(blobs[-1]), len(blobs[-1])

    held = ids if isinstance(ids, list) else [ids]
    tokens, largest = sum(map(len, held)), max((int(x.max(initial=0)) for x in held), default=0)
    counts = np.zeros(largest + 1, np.int64)
    for some in held:
        for a in range(0, len(some), STEP):
            counts += np.bincount(some[a : a + STEP], minlength=len(counts))
    alphabet = np.flatnonzero(counts)
    alphabet = alphabet[np.argsort(-counts[alphabet], kind="stable")]
    kind = np.uint16 if len(alphabet) <= 1 << 16 else np.uint32
    code = np.zeros(len(counts), kind)
    code[alphabet] = np.arange(len(alphabet))
    seq, at = np.empty(tokens, kind), 0
    held.reverse()
    while held:
        some = held.pop()
        np.take(code, some, out=seq[at : at + len(some)], mode="clip")  # else numpy holds the part twice
        at += len(some)
    planes = []
    for shift in reversed(range(int(max(len(alphabet) - 1, 0)).bit_length())):
        bit = np.empty(tokens, bool)
        for a in range(0, tokens, STEP):
            bit[a : a + STEP] = seq[a : a + STEP] >> kind(shift) & kind(1)
        packed = np.packbits(bit)
        cuts = range(0, len(packed), BLOCK_BYTES)
        ones = [int(np.bitwise_count(packed[c : c + BLOCK_BYTES]).sum()) for c in cuts]
        planes.append({
            "zeros": int(len(seq) - sum(ones)),
            "ones_before": np.cumsum([0, *ones])[:-1].tolist(),
            "blocks": [keep(packed[c : c + BLOCK_BYTES].tobytes()) for c in cuts],
        })
        seq = parted(seq, bit, planes[-1]["zeros"])
    sink = pa.BufferOutputStream()
    docs = pa.record_batch([doc_ids, pa.array(lengths, pa.int64())], ["doc", "n"])
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_batch(docs)
    header = {
        "tokens": tokens,
        "alphabet": keep(alphabet.astype("<u4").tobytes()),
        "counts": keep(counts[alphabet].astype("<u8").tobytes()),
        "docs": keep(sink.getvalue().to_pybytes()),
        "planes": planes,
    }
    head = packer.compress(json.dumps(header).encode())
    yield MAGIC + struct.pack("<I", len(head)) + head
    yield from blobs


class Shard:
    """Reads of one shard file; only the blocks that an answer needs are fetched."""

    def __init__(self, path: str) -> None:
        self.file = open_file(path)
        prefix = len(MAGIC) + 4
        start = self.file.read_at(prefix, 0)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is no token shard")
        size = struct.unpack("<I", start[len(MAGIC) :])[0]
        self.base = prefix + size
        head = json.loads(zstandard.decompress(self.file.read_at(size, prefix)))
        self.tokens, self.planes = head["tokens"], head["planes"]
        self.alphabet = np.frombuffer(self._blob(head["alphabet"]), "<u4")
        self.counts = np.frombuffer(self._blob(head["counts"]), "<u8")
        self.docs_at = head["docs"]
        self._block = lru_cache(maxsize=64)(self._read_block)

    def _blob(self, at: list[int]) -> bytes:
        return zstandard.decompress(self.file.read_at(at[1], self.base + at[0]))

    def _read_block(self, plane: int, block: int) -> np.ndarray:
        return np.frombuffer(self._blob(self.planes[plane]["blocks"][block]), np.uint8)

    def documents(self) -> pa.RecordBatch:
        """Ids and token counts of the documents, in order."""
        return pa.ipc.open_stream(self._blob(self.docs_at)).read_next_batch()

    def codes(self) -> np.ndarray:
        """The places in ``alphabet`` of all tokens in order: the planes are folded back, last one first."""
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        seq = np.zeros(self.tokens, kind)
        for shift, plane in enumerate(reversed(range(len(self.planes)))):
            blocks = [self._read_block(plane, b) for b in range(len(self.planes[plane]["blocks"]))]
            bit = np.unpackbits(np.concatenate(blocks), count=self.tokens).view(bool)
            seq = folded(seq, bit, self.planes[plane]["zeros"], 1 << shift)
        return seq

    def decode(self) -> np.ndarray:
        """All tokens in order."""
        return self.alphabet[self.codes()] if self.tokens else np.zeros(0, np.uint32)

    def _ones(self, plane: int, place: int) -> int:
        """Ones before ``place``."""
        block, rest = divmod(place, BLOCK_BYTES * 8)
        before = self.planes[plane]["ones_before"]
        if block == len(before):
            return self.tokens - self.planes[plane]["zeros"]
        if not rest:
            return before[block]
        data = self._block(plane, block)
        whole, bits = divmod(rest, 8)
        ones = before[block] + int(np.bitwise_count(data[:whole]).sum())
        return ones + (int(data[whole]) >> (8 - bits)).bit_count() if bits else ones

    def _bit(self, plane: int, place: int) -> int:
        block, rest = divmod(place, BLOCK_BYTES * 8)
        return int(self._block(plane, block)[rest >> 3]) >> (7 - (rest & 7)) & 1

    def access(self, place: int) -> int:
        """The token at a position."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        code = 0
        for p, plane in enumerate(self.planes):
            bit, ones = self._bit(p, place), self._ones(p, place)
            place = plane["zeros"] + ones if bit else place - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        found = np.flatnonzero(self.alphabet == token)
        return int(found[0]) if len(found) else None

    def count(self, token: int) -> int:
        code = self._code(token)
        return 0 if code is None else int(self.counts[code])

    def rank(self, token: int, place: int) -> int:
        """How often the token occurs before a position."""
        code = self._code(token)
        if code is None:
            return 0
        first, last = 0, min(max(place, 0), self.tokens)
        for p, plane in enumerate(self.planes):
            a, b = self._ones(p, first), self._ones(p, last)
            if code >> (len(self.planes) - 1 - p) & 1:
                first, last = plane["zeros"] + a, plane["zeros"] + b
            else:
                first, last = first - a, last - b
        return last - first

    def _place_of(self, plane: int, bit: int, k: int) -> int:
        """The position of the ``k``-th (from 0) such bit of a plane."""
        before = self.planes[plane]["ones_before"]
        size = BLOCK_BYTES * 8

        def seen(block: int) -> int:
            return before[block] if bit else block * size - before[block]

        low, high = 0, len(before) - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if seen(middle) <= k else (low, middle - 1)
        left = min(self.tokens - low * size, size)
        places = np.flatnonzero(np.unpackbits(self._block(plane, low), count=left) == bit)
        return low * size + int(places[k - seen(low)])

    def select(self, token: int, k: int) -> int:
        """The position of the token's ``k``-th (from 0) occurrence."""
        code = self._code(token)
        if code is None or not 0 <= k < self.counts[code]:
            raise IndexError(k)
        place = 0
        for p, plane in enumerate(self.planes):
            ones = self._ones(p, place)
            place = plane["zeros"] + ones if code >> (len(self.planes) - 1 - p) & 1 else place - ones
        place += k
        for p in reversed(range(len(self.planes))):
            bit = code >> (len(self.planes) - 1 - p) & 1
            place = self._place_of(p, bit, place - self.planes[p]["zeros"] if bit else place)
        return place

    def occurrences(self, token: int) -> Iterator[int]:
        return (self.select(token, k) for k in range(self.count(token)))


# encoding


class WordIds:
    """Ids of texts with a tokenizer whose tokens never reach over white space.

    A text is cut at ASCII white space; each different word, without signs at its end, goes through the
    library once while it is remembered.
    """

    def __init__(self, path: str, end: int, room: int | None = None) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_padding()
        self.model.no_truncation()
        self.lowers = "Lowercase" in str(self.model.normalizer)
        self.added = [t.content.encode().lower().decode() for t in self.model.get_added_tokens_decoder().values()]
        self.end, self.room = end, KNOWN_WORDS if room is None else room
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        #: by id, whether a token ends a word; None if the tokenizer does not mark it
        self.closes = None
        cut = lambda t: self.model.encode(t, add_special_tokens=False).ids
        if suffix and cut(CUT_PROBE) == [i for part in CUT_PROBE_PARTS for i in cut(part)]:
            names = (self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size()))
            self.closes = np.fromiter((n.endswith(suffix) for n in names), bool, self.model.get_vocab_size())
        self.forget()
        self.remember([END_WORD, NOTHING], np.array([1, 0]), np.array([self.end], np.uint32))

    def forget(self) -> None:
        self.known: dict[bytes | None, int] = {}
        self.odd: set[bytes] = set()
        self.count = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.uses = (np.zeros(1 << 14, np.int32) for _ in range(3))

    def make_room(self) -> None:
        """Forget the units that the fewest parts of text had, so that at most half the room is taken."""
        units, at = list(self.known), np.fromiter(self.known.values(), np.int64, len(self.known))
        self.uses[[self.known[END_WORD], self.known[NOTHING]]] = np.iinfo(np.int32).max
        uses = self.uses[at]
        least = 2
        while (uses >= least).sum() > max(self.room // 2, 2):
            least *= 2
        kept = np.flatnonzero(uses >= least)
        sizes, flat, odd = self.sizes[at[kept]], self.gathered(at[kept])[0], self.odd
        self.forget()
        self.remember([units[i] for i in kept.tolist()], sizes, flat)
        self.odd = odd.intersection(self.known)
        self.uses[: self.count] = uses[kept] // 2

    def one_run(self, word: bytes) -> bool:
        """Whether a word is letters only, and stays so when the tokenizer has normalised it."""
        if word.isascii():
            return word.isalpha()
        text = word.decode()
        return text.isalpha() and text.lower().isalpha() and unicodedata.is_normalized("NFC", text)

    def units(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """What is encoded for words: each one's form, or letters and the signs after them apart.

        Words that differ in ASCII capitals only share a form, as a tokenizer that lower-cases reads them
        alike.  Added tokens are matched by case before that, so a word that would hold one in
        lower case stays as it is, whole.
        """
        if not len(words):
            return words, words
        lower = pc.ascii_lower(words)
        added = pa.array(np.zeros(len(words), bool))
        for token in self.added:
            added = pc.or_(added, pc.match_substring(lower, token))
        form = words
        if self.lowers:
            form = pc.if_else(pc.and_not(pc.string_is_ascii(words), added), lower, words)
        letters = pc.ascii_rtrim(form, characters=SIGNS.decode())
        size, whole = pc.binary_length(letters), pc.binary_length(form)
        cut = pc.and_(pc.and_not(pc.less(size, whole), added), pc.utf8_is_alpha(letters))
        cut = np.asarray(cut) if self.closes is not None else np.zeros(len(words), bool)
        signs = np.where(cut, np.asarray(whole) - np.asarray(size), 0)
        ends = np.frombuffer(form.buffers()[1], np.int32, len(form) + 1, 4 * form.offset)[1:].astype(np.int64)
        through = np.cumsum(signs)
        places = np.repeat(ends - through, signs) + np.arange(int(signs.sum()))
        text = np.frombuffer(form.buffers()[2], np.uint8) if len(places) else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], through]).astype(np.int32)
        tails = pa.Array.from_buffers(pa.string(), len(signs), [None, pa.py_buffer(offsets), pa.py_buffer(text[places])])
        return pc.if_else(pa.array(cut), letters, form), tails

    def places(self, units: pa.Array) -> np.ndarray:
        """Where units are remembered; new ones are learned."""
        told = units.dictionary_encode()
        distinct = told.dictionary.cast(pa.binary()).to_pylist()
        place = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0).tolist()
        if new:
            self.learn([distinct[i] for i in new])
            place[new] = [self.known[distinct[i]] for i in new]
        self.uses[place] += 1
        return place[np.asarray(told.indices)]

    def learn(self, units: list[bytes]) -> None:
        """Encode new units, each once.

        Letters are encoded many words to a line: one by one, the library spends more on each call than
        on the word; a token that ends a word tells where the next begins.  That holds for a
        tokenizer that marks ends of words and cuts between letters and signs; it is tried out on
        every line and on ``CUT_PROBE`` once, else words are encoded one by one, and are ``odd``.
        """
        alone, letters = [], []
        for w in units:
            (letters if self.closes is not None and (w.isalpha() or self.one_run(w)) else alone).append(w)
        self.odd.update(w for w in alone if not w.isascii())
        lines = [letters[i : i + LINE_WORDS] for i in range(0, len(letters), LINE_WORDS)]
        for i in range(0, len(lines), LINES):
            some = lines[i : i + LINES]
            found = self.model.encode_batch_fast([b" ".join(x).decode() for x in some], add_special_tokens=False)
            for line, encoded in zip(some, found, strict=True):
                ids = np.array(encoded.ids, np.uint32)
                ends = np.flatnonzero(self.closes[ids]) + 1
                if len(ends) == len(line) and ends[-1] == len(ids):
                    self.remember(line, np.diff(ends, prepend=0), ids)
                else:
                    alone += line
                    self.odd.update(line)
        for a, b in slices(map(len, alone), CALL_BYTES):
            found = [x.ids for x in self.model.encode_batch_fast([w.decode() for w in alone[a:b]], add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.remember(alone[a:b], sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))

    def remember(self, new: list[bytes], sizes: np.ndarray, flat: np.ndarray) -> None:
        n, end = self.count, self.used + len(flat)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(end, np.uint32)])
        if n + len(new) > len(self.starts):
            more = n + len(new)
            self.starts, self.sizes, self.uses = (
                np.concatenate([x, np.zeros(more, np.int32)]) for x in (self.starts, self.sizes, self.uses)
            )
        self.flat[self.used : end] = flat
        self.sizes[n : n + len(new)] = sizes
        self.starts[n : n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.used, self.count = end, n + len(new)
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered words in a row, and where each word's end."""
        sizes = self.sizes[at]
        through = np.cumsum(sizes, dtype=np.int32)
        total = int(through[-1]) if len(through) else 0
        return self.flat[np.repeat(self.starts[at] - through + sizes, sizes) + np.arange(total, dtype=np.int32)], through

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column with the end id after each text, and the count of each text.

        Letters that signs follow are put together from both parts, as no token holds letters and signs.
        """
        if len(self.known) > self.room:
            self.make_room()
        split = split_words(texts, lower=False)
        words = split.distinct.cast(pa.string())
        heads, tails = self.units(words)
        at = np.stack([self.places(heads), np.full(len(words), self.known[NOTHING])], 1)
        cut = np.flatnonzero(np.asarray(pc.binary_length(tails)))
        if self.odd:  # letters to Arrow, but not as the tokenizer takes them: encoded with their signs
            odd = pa.array([w.decode() for w in self.odd], pa.string())
            strange = np.asarray(pc.is_in(heads.take(cut), odd))
            both = cut[strange]
            at[both, 0] = self.places(pc.binary_join_element_wise(heads.take(both), tails.take(both), ""))
            cut = cut[~strange]
        at[cut, 1] = self.places(tails.take(cut))
        # words of this batch, and last the end
        known, through = self.gathered(np.append(at.ravel(), self.known[END_WORD]))
        ends = np.append(through[1::2], len(known))
        sizes = np.diff(ends, prepend=0)
        said = with_ends(split.at, split.sizes, len(words))
        long = sizes[said]
        until = np.cumsum(long, dtype=np.int64)
        total = int(until[-1]) if len(until) else 0
        place = np.int32 if max(total, len(known)) < 1 << 31 else np.int64
        at = np.repeat(((ends - sizes)[said] - until + long).astype(place), long)
        at += np.arange(total, dtype=place)
        return known.take(at), np.diff(until[np.cumsum(split.sizes + 1) - 1], prepend=0)


def word_ids(path: str, end: int, room: int | None = None) -> WordIds:
    return model_of(WordIds, path, end, room)


# jobs


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = ENCODE_BYTES,
    room: int | None = None,
) -> DataFrame:
    """Write the ids of every whole text, in ascending id order, to shard files in ``folder``.

    Returns the stored manifest: ``part, seq, path, n_docs, n_tokens, bytes, start`` (``start``:
    ids in all shards before).  Documents are dealt by ranges of their id, so that shards follow
    one another; a task closes a shard when it has ``shard_tokens`` ids.  Files appear whole
    under fixed names, so a task that runs again replaces them by the same.

    A null text is empty and has only the end id.  Null ids come first; rows that share an id
    follow one another in the order of a hash of their text.  An empty table writes no shard.

    ``part_bytes`` of text are encoded at once, and ``room`` words are remembered (``KNOWN_WORDS``): less
    takes less memory and more time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(tokenizer, end_id, room), TaskContext.get().partitionId()
        held, names, counts, size, seq = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/shard-{part:07d}-{seq:05d}.wvm"
            lengths = np.concatenate(counts)
            give_back()  # what encoding left, before the planes take theirs
            data = build(held, pa.concat_arrays(names), lengths)
            written = put_file(path, data)
            row = [[part], [seq], [path], [len(lengths)], [int(lengths.sum())], [written]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], manifest)

        manifest = ["part", "seq", "path", "n_docs", "n_tokens", "bytes"]
        for part_of in small_parts(batches, 1, min(part_bytes, 2 * shard_tokens)):
            ids, lengths = encoder.encode(part_of.column(1))
            held.append(ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids)
            names.append(part_of.column(0))
            counts.append(lengths)
            size += len(ids)
            if size >= shard_tokens:
                yield close()
                give_back()
                held, names, counts, size, seq = [], [], [], 0, seq + 1
        if size:
            yield close()
        held, names, counts = [], [], []
        give_back()

    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        # rows without an id, or with the same one, are dealt by a hash of their text as well
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("id", "h")
        .sortWithinPartitions("id", "h", "text")
        .drop("h")
    )
    shape = "part bigint, seq bigint, path string, n_docs bigint, n_tokens bigint, bytes bigint"
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    with small_batches(docs.sparkSession, 10_000, part_bytes):
        manifest = materialize(rows.mapInArrow(run, shape), "shards")
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _spread(manifest: DataFrame) -> DataFrame:
    """One task per shard."""
    return manifest.repartition(max(1, min(manifest.count(), READ_TASKS)))


def read_documents(manifest: DataFrame, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shard files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of()
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(path)
                docs, codes, ids = shard.documents(), shard.codes(), shard.alphabet
                lengths = docs.column(1).to_numpy()
                ends = np.cumsum(lengths)
                # ids of one document at a time: codes take half their room
                crc = [
                    zlib.crc32(ids[codes[a:b]])
                    for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [docs.column(0), pa.array(start + ends - lengths), docs.column(1), pa.array(crc, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )
        give_back()

    shape = f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return _spread(manifest.select("path", "start")).mapInArrow(run, shape).withColumnRenamed("id", id_col)


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """``position`` (among all ids) of every occurrence of a token, by select on the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = Shard(path).occurrences(token)
                yield pa.RecordBatch.from_arrays([pa.array([start + p for p in places], pa.int64())], ["position"])

    return _spread(manifest.select("path", "start")).mapInArrow(run, "position bigint")


def count_token(manifest: DataFrame, token: int) -> int:
    """Occurrences of a token in all shards; only directories are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([Shard(p.as_py()).count(token) for p in batch.column(0)], pa.int64())], ["n"])

    return _spread(manifest.select("path")).mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def token_digest(
    docs: DataFrame, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text", part_bytes: int = ENCODE_BYTES, room: int | None = None,
) -> DataFrame:
    """Encode and write all documents, read the shards back, and report each document."""
    folder = scratch_path(docs.sparkSession, "token-shards")
    manifest = write_shards(docs, tokenizer, folder, end_id, shard_tokens, id_col, text_col, part_bytes, room)
    return read_documents(manifest, docs.schema[id_col].dataType.simpleString(), id_col)
