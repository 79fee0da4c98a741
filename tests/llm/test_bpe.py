import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from chronoline.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = ["a", "b", "the", "The ", " ", "  ", "\n", "\t", "'", "'s", "'re", "!", "==", "ß", "é", "日", "本語", "😀", "1",
            "22", " ", "\x1c", "　", "’", "ing", "-", "Ünder", " x", "'ll", "\r\n", "​", "٣"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, P.PATTERN)


@pytest.mark.parametrize("leaf,leaf_bytes,window", [(8, 4, 4), (32, 8, 8)])
def test_tree_equals_library(codec, monkeypatch, leaf, leaf_bytes, window):
    """Small leaves put a join at nearly every place of a text."""
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
    monkeypatch.setattr(bpe, "WINDOW_CHARS", window)
    r = random.Random(leaf)
    for _ in range(1500):
        parts = r.sample(ALPHABET, r.choice([1, 2, 3, 8, len(ALPHABET)]))
        text = "".join(r.choice(parts) for _ in range(r.choice([5, 20, 60, 200])))
        ids = codec.encode(text)
        assert ids.tolist() == codec._enc.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, "=" * 9_000 + "b", " " * 9_000 + "x", "日本" * 6_000, "ab1" * 4_000])
def test_long_matches(codec, text):
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    assert ids.tolist() == codec._enc.encode_ordinary(text)


def test_digests(spark, codec, awkward, nothing):
    got = bpe.token_digests(awkward, RANKS, P.PATTERN).collect()
    want = []
    for r in awkward.select("doc_id", "text").collect():
        ids = codec._enc.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.token_digests(nothing, RANKS, P.PATTERN).count() == 0


def test_round_trip_frames(spark, awkward):
    ids = bpe.encode(awkward, RANKS, P.PATTERN)
    back = {(r["doc_id"], bytes(r["decoded"])) for r in bpe.decode(ids, RANKS, P.PATTERN).collect()}
    assert back == {(r["doc_id"], (r["text"] or "").encode()) for r in awkward.collect()}
    assert bpe.tokenized(awkward, RANKS, P.PATTERN).filter("NOT round_trip").count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(none, RANKS, P.PATTERN).first()["decoded"]) == b""
    assert np.asarray(ids.filter("doc_id = 4").first()["ids"]).size == 0
