from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries, wavelet
from millrace.session import scratch_path
from tests.llm.helpers import SMALL, documents, empty, needs_tables, odd_documents, rows

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["İx", "Straße", "ǅ", "ﬁ", "ῼ", *"aB1 .'\n\t_-\x0b\x1c", "\u0085", " ", " ", "é", "é", "́", "Σ", "<|endoftext|>", "  ", "'s"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS)).map("".join))
def test_words_encode_as_the_whole_text(plain, text):
    ids, sizes = wavelet.word_ids(WORDS, 1).encode(pa.array([text, None], pa.string()))
    assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1, 1]
    assert sizes.tolist() == [len(ids) - 1, 1]


def test_little_memory_for_words_changes_no_ids(plain):
    encoder = wavelet.WordIds(WORDS, 1, room=6)
    texts = ["the the. cat, İx. ε\u0301é! a1.", "the İx. İx dog, dog; dog", "ΣΣ. the cat. e\u0301. É, x'S. <|endoftext|>. <|ENDOFTEXT|>."] * 4
    for text in texts:
        ids, _ = encoder.encode(pa.array([text], pa.string()))
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert len(encoder.known) < 6 + 20


def test_letters_are_encoded_once_whatever_signs_follow(monkeypatch):
    encoder, learned = wavelet.WordIds(WORDS, 1), []
    learn = wavelet.WordIds.learn
    monkeypatch.setattr(wavelet.WordIds, "learn", lambda self, units: (learned.extend(units), learn(self, units)))
    encoder.encode(pa.array(["Word word, WORD; word. (word) été. été!"], pa.string()))
    assert sorted(learned) == sorted([b"word", "été".encode(), b",", b";", b".", b"!", b"(word)"])


def test_a_worker_keeps_one_model():
    from millrace.llm import base

    first = wavelet.word_ids(WORDS, 1)
    assert wavelet.word_ids(WORDS, 1) is first
    base.model_of()
    assert base._MODEL == [None, None] and wavelet.word_ids(WORDS, 1) is not first


@pytest.mark.parametrize("text", [
    "<|ENDOFTEXT|>", "<|EndOfText|>", "aB<|ENDOFTEXT|>c Word WORD", "<|STARTOFTEXT|><|endoftext|>",
    "<|endoftext|> <|ENDOFTEXT|> <|endoftext|>X", "X<|EndOfText|> x<|endoftext|>",
])
def test_added_tokens_keep_their_case(plain, text):
    ids, _ = wavelet.word_ids(WORDS, 1).encode(pa.array([text], pa.string()))
    assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 5, 6, 70_000, 9]), max_size=60))
def test_shard_answers(tmp_path_factory, ids):
    path = str(tmp_path_factory.mktemp("s") / "x.wvm")
    array = np.array(ids, np.uint32)
    wavelet.put_file(path, wavelet.build(array, pa.array([7], pa.int64()), np.array([len(ids)])))
    shard = wavelet.Shard(path)
    assert shard.decode().tolist() == ids
    assert [shard.access(i) for i in range(len(ids))] == ids
    for token in {*ids, 3}:
        places = [i for i, x in enumerate(ids) if x == token]
        assert shard.count(token) == len(places) and [*shard.occurrences(token)] == places
        assert [shard.rank(token, i) for i in range(len(ids) + 1)] == [ids[:i].count(token) for i in range(len(ids) + 1)]


def test_shard_of_many_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BYTES", 16)
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint32)
    path = str(tmp_path / "x.wvm")
    wavelet.put_file(path, wavelet.build(ids, pa.array(["a", None]), np.array([10, 4990])))
    shard = wavelet.Shard(path)
    assert np.array_equal(shard.decode(), ids) and shard.documents().column(0).to_pylist() == ["a", None]
    for i in range(0, 5000, 97):
        token = int(ids[i])
        assert shard.access(i) == token and shard.rank(token, i) == (ids[:i] == token).sum()
        assert shard.select(token, shard.rank(token, i)) == i


def test_ids_in_parts_make_the_same_shard_in_less_memory():
    parts = [np.random.default_rng(i).integers(0, 40_000, 100_000).astype(np.uint16) for i in range(20)]
    whole, doc = np.concatenate(parts), pa.array([7], pa.int64())
    expected = b"".join(wavelet.build(whole, doc, np.array([len(whole)])))
    tracemalloc.start()
    blobs = list(wavelet.build(parts, doc, np.array([len(whole)])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b"".join(blobs) == expected and not parts
    # measured: 9.6 bytes an id, of them 4 for codes twice; 23 with the ids in one and masks of a whole plane
    assert most < 12 * len(whole)


def brute(docs, plain):
    out, start = [], 0
    for r in sorted(docs, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_odd_documents(spark, plain):
    docs = odd_documents(spark)
    for most in (20, 1 << 20):
        got = wavelet.token_digest(docs, WORDS, shard_tokens=most)
        assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute(docs.collect(), plain)
    assert wavelet.token_digest(empty(docs), WORDS).count() == 0


def test_look_ups_over_shards(spark, plain):
    docs = documents(spark, [(i, "blue green " * (i % 5) + "red", "en", "a") for i in range(40)])
    manifest = wavelet.write_shards(docs, WORDS, scratch_path(spark, "look"), shard_tokens=50)
    ids = [x for i in range(40) for x in [*plain.encode("blue green " * (i % 5) + "red", add_special_tokens=False).ids, 1]]
    assert manifest.count() > 3
    token = plain.encode("green", add_special_tokens=False).ids[0]
    assert wavelet.count_token(manifest, token) == ids.count(token)
    places = sorted(r.position for r in wavelet.find_token(manifest, token).collect())
    assert places == [i for i, x in enumerate(ids) if x == token]


@needs_tables
def test_whole_table(spark, plain):
    got = queries.QUERIES["op6_wavelet_tokens"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute(docs, plain)
