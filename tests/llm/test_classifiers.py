import functools
import zlib

import numpy as np
import public_tokenizers as P

from chronoline.llm import langid, quality
from chronoline.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.conftest import frame

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def crc(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_quality_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, SF01).collect()
    assert len(rows) == 1000
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"], 5) == 0)
        assert r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_quality_reads_texts_and_unheld_labels_alone(spark):
    """Scores do not change with ids, languages, sources, order or held-out labels."""
    docs = [(i, ("good words make a sentence " if i % 2 else "### $$$ ### ") * (3 + i % 5)) for i in range(200)]
    flip = lambda i: (i % 2) ^ (crc(i, 5) == 0)
    a = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    b = spark.createDataFrame([(i, flip(i)) for i, _ in docs], "doc_id long, quality int")
    one = quality.score(frame(spark, docs), quality.fit(frame(spark, docs), a)).collect()
    df = frame(spark, docs[::-1], ("de",), ("z",)).repartition(5)
    two = quality.score(df, quality.fit(df, b)).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in one} == {r["doc_id"]: round(r["score"], 9) for r in two}
    assert all(r["predicted"] == r["doc_id"] % 2 for r in one)


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, None), (7, 0), (8, 0), (8, 1), (None, 1)], "doc_id long, quality int")
    for docs in (awkward, nothing):
        for known in (labels, labels.limit(0)):
            model = quality.fit(docs, known)
            rows = quality.score(docs, model).collect()
            assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert quality.accepted(docs, model).columns == docs.columns


def test_quality_pools_whole_texts():
    v = np.random.default_rng(0).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    text = "one two, three ### " * 30_000
    ids = np.concatenate(list(quality.token_ids(text)))
    w = v[ids].astype(float)
    want = np.concatenate([w.mean(0), (w[:-1] * w[1:]).mean(0)])
    assert np.allclose(quality.features(text, v)[:2 * quality.DIM], want, atol=1e-3)


def test_language_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = QUERIES["op5_langid"](spark, SF01).collect()
    assert len(rows) == 1000
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98


def test_forward_adds_all_segmentations():
    vocabulary = langid.pieces(RANKS)
    r = np.random.default_rng(1)
    prob = r.random((len(vocabulary) + 2, 2)) * 0.01
    prob[0] = 0

    @functools.cache
    def total(w):
        if not w:
            return np.ones(2)
        out = np.zeros(2)
        for k in range(1, len(w) + 1):
            p = vocabulary.get(w[:k], len(vocabulary) + 1 if k == 1 else 0)
            out = out + prob[p] * total(w[k:])
        return out
    group = ["_a", "_the", "_sprache", "_日本語", "_œuvre", "_" + "internationalization" * 2, "_responsibilities"]
    assert vocabulary.longest > 12 and any(len(p) == vocabulary.longest for p in vocabulary)
    assert np.allclose(langid.forward(group, vocabulary, prob), [np.log(total(w)) for w in group])
    one = langid._expected(group, np.ones(len(group)), vocabulary, prob[:, :1])
    # each letter lies in exactly one piece of a segmentation
    letters = sum(len(p) * one[i] for p, i in vocabulary.items()) + one[-1]
    assert np.isclose(letters, sum(map(len, group)))


def test_language_awkward(spark, awkward, nothing):
    model = langid.fit(awkward, RANKS)
    rows = langid.predict(awkward, model, RANKS).collect()
    assert len(rows) == awkward.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert langid.fit(nothing, RANKS)[0] == []
    none = langid.predict(awkward, langid.fit(nothing, RANKS), RANKS).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.predict(nothing, model, RANKS).collect() == []


def test_number_signs_are_no_letters(spark):
    docs = frame(spark, list(enumerate(["½ ② ³", "Ⅷ", "a½", "١٢٣", "_", "ª"])))
    model = (["en"], np.full((len(langid.pieces(RANKS)) + 2, 1), 1e-4))
    assert [r["lang_pred"] for r in langid.predict(docs, model, RANKS).orderBy("doc_id").collect()] == [
        "und", "und", "en", "und", "und", "en"]


def test_words_of_long_texts():
    assert [w for part in langid.words("x" * 100) for w in part] == ["_" + "x" * 31] * 3 + ["_" + "x" * 7]
    assert sum(len(p) for p in langid.words("ab cd " * 400_000)) == 800_000
