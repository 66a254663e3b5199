"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import slices

#: A single space between two characters that no definition of white space includes.  Byte-level
#: BPE always begins a new word at such a space, and no special token contains one.
SAFE_BOUNDARY = re.compile(r" (?<=[!-~\w] )(?=[!-~\w])")
BATCH_BYTES = 2 << 20
KNOWN_PIECES = 400_000


class Lengths:
    """Token counts of pieces, each different piece encoded once while it is remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.splits = False
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_padding()
            model.no_truncation()
            self.splits = True
            self.encode = lambda texts: [
                len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text: the sum over its pieces, which are encoded in even batches."""
        split = [SAFE_BOUNDARY.split(t) if self.splits else [t] for t in texts]
        known = self.known
        if len(known) > KNOWN_PIECES:
            known.clear()
        # all but a text's first piece begin with the space they were cut at
        new = [p for pieces in split for p in {*pieces[1:]} if p not in known]
        new = list(dict.fromkeys(new))
        for a, b in slices(map(len, new), BATCH_BYTES):
            known.update(zip(new[a:b], self.encode([" " + p for p in new[a:b]]), strict=True))
        heads = self.encode([pieces[0] for pieces in split])
        return [
            head + sum(map(known.__getitem__, pieces[1:]))
            for head, pieces in zip(heads, split, strict=True)
        ]


@lru_cache(maxsize=2)
def lengths(path: str) -> Lengths:
    return Lengths(path)


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, over whole texts.

    ``tokenizer`` is a file that every executor can read: ``.json`` for tokenizers, ``.model``
    for sentencepiece.  Nothing is padded, cut or added; special strings inside a text count as
    the library takes them by default.  Texts are cut at safe boundaries (``SAFE_BOUNDARY``), so
    that no call gets a long text whole where it can be cut, and pieces go to the library in
    batches of about ``BATCH_BYTES``.

    Null and empty texts have 0 bytes and 0 tokens.  Each row of the table gives one row, also
    when rows repeat or ids are null.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = lengths(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(t.encode()) for t in texts]
            tokens = []
            for a, b in slices(sizes, BATCH_BYTES):
                tokens += counter.count(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    ).withColumnRenamed("id", id_col)
