"""Language ID by compression: the language whose dictionary packs a text best."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import driver_rows, give_back, held_out, model_of, unused

#: Bounds of what is fitted: this many languages, sampled rows of each, this much of a row, this
#: much in all.  A dictionary is full with fewer than all sampled rows, as rows are seldom short; a
#: bound for each row keeps one long text from being all of it.  The rest covers every row and
#: every text whole.
LANGUAGES = 1000
SAMPLE_ROWS = 400
SAMPLE_ROW_BYTES = 1000
DICTIONARY_BYTES = 96 << 10
LEVEL = 9
PIECE_BYTES = 2048
LEAST_MARGIN = 0.004

_NO_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def normal_form(text: str) -> bytes:
    """Lower-case words without ASCII digits and signs; a word said again at once counts once.

    This is what is packed: what it leaves out says little about the language, and a word repeated a
    thousand times would pack alike in all.
    """
    return b" ".join(w for w, _ in groupby(text.lower().encode().translate(_NO_LETTERS).split()))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def pieces(data: bytes) -> Iterator[bytes]:
    """A long text is packed in pieces, so that the dictionary counts throughout."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        cut = data.rfind(b" ", start + 1, start + PIECE_BYTES)
        cut = cut if cut > 0 else start + PIECE_BYTES
        yield data[start:cut]
        start = cut
    yield data[start:]


def fit_dictionaries(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS
) -> dict[str, bytes]:
    """A raw-content dictionary for each language, from rows outside the held-out fold.

    The rows of a language with the smallest hashes of id and text are the sample: ``rows`` of them,
    whatever ids they share.  Of each the first ``SAMPLE_ROW_BYTES`` of its normal form are used.
    Languages are the ``LANGUAGES`` with the most rows, ties in order of name.  So what reaches the
    driver is bounded in rows, bytes and languages.  Rows without an id, a text or a language are not
    learned from.
    """
    given = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("language"),
        F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"),
    ).filter(
        F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("language").isNotNull() & ~held_out(F.col("id"), 4)
    )
    counts = given.groupBy("language").agg(F.count("*").alias("n"))
    most = counts.orderBy(F.desc("n"), "language").limit(LANGUAGES).collect()
    # hashes under a bound that some four times ``rows`` of a language will meet are ranked
    limits = driver_rows(
        given.sparkSession,
        [(r["language"], min(4.0 * rows / r["n"], 1.0) * float(1 << 64) - float(1 << 63)) for r in most],
        "language string, bound double",
    )
    few = given.join(F.broadcast(limits), "language").filter(F.col("h").cast("double") <= F.col("bound"))
    order = Window.partitionBy("language").orderBy("h", "id")
    start = F.substring("text", 1, 4 * SAMPLE_ROW_BYTES)
    few = few.select("language", "h", "id", start.alias("text")).distinct()
    sample = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows).collect()
    content: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r["language"], r["place"])):
        if has_letter(r["text"]):
            content.setdefault(r["language"], []).append(normal_form(r["text"])[:SAMPLE_ROW_BYTES])
    return {lang: b" ".join(parts)[:DICTIONARY_BYTES] for lang, parts in content.items()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.packers = []
        for lang, content in sorted(dictionaries.items()):
            if len(content) >= 8:  # the library takes no smaller dictionary
                primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                primed.precompute_compress(level=LEVEL)
                packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, **plain)
            else:
                packer = zstandard.ZstdCompressor(level=LEVEL, **plain)
            self.packers.append((lang, packer))
        self.unprimed = zstandard.ZstdCompressor(level=LEVEL, **plain)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and margin: how much larger the second smallest size is, as a share of it.

        With one language the second is the size without a dictionary.
        """
        if not text or not self.packers or not has_letter(text):
            return "und", 0.0
        parts = list(pieces(normal_form(text) or text.lower().encode()))
        sizes = [(sum(len(p.compress(x)) for x in parts), lang) for lang, p in self.packers]
        if len(sizes) == 1:
            sizes.append((sum(len(self.unprimed.compress(x)) for x in parts), ""))
            return sizes[0][1], max(0.0, 1 - sizes[0][0] / sizes[1][0])
        (best, lang), (second, _) = sorted(sizes)[:2]
        return lang, 1 - best / second


def classifier(dictionaries: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(dict(dictionaries))


def language_of(text: Column, dictionaries: dict[str, bytes]) -> Column:
    """``struct(lang string, margin double)`` for a text column."""
    model = tuple(sorted(dictionaries.items()))

    @F.arrow_udf("lang string, margin double")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decide = model_of(classifier, model)
        for texts in batches:
            found = [decide(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "margin"],
            )
        give_back()

    return identify(text)


def identify_languages(
    docs: DataFrame,
    least_margin: float = LEAST_MARGIN,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every document.

    ``score`` is the margin between the two smallest sizes, 0 to 1.  A document is rejected if
    the margin is under ``least_margin`` or it has no language (``und``: null, without a letter,
    or nothing was learned).  Ties go to the language that sorts first, and are rejected.  A null
    id counts as an empty text in the fold rule; rows without one are judged but not learned
    from.  Repeated rows are judged each; other columns are ignored.
    """
    found = language_of(F.col("text"), fit_dictionaries(docs, id_col, text_col, lang_col))
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .select("id", found.alias("f"))
        .select(
            F.col("id").alias(id_col), held_out(F.col("id"), 4).alias("held_out"),
            F.col("f.lang").alias("lang_pred"), F.col("f.margin").alias("score"),
            ((F.col("f.lang") == "und") | (F.col("f.margin") < least_margin)).alias("rejected"),
        )
    )


def keep_identified(
    docs: DataFrame, least_margin: float = LEAST_MARGIN, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The documents, all columns, that ``identify_languages`` does not reject."""
    found = language_of(F.col(text_col), fit_dictionaries(docs, id_col, text_col, lang_col))
    name = unused(docs.columns, "language_found")
    kept = docs.withColumn(name, found).filter(
        (F.col(name).getField("lang") != "und") & (F.col(name).getField("margin") >= least_margin)
    )
    return kept.drop(name)
