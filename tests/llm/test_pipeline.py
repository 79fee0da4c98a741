import public_tokenizers as P

import corpus_pipeline
from chronoline.llm import bpe
from tests.conftest import SF01
from tests.llm.conftest import frame
from tests.llm.test_scans import base_spans
from tests.llm.test_setsketch import brute


def test_stages_in_order(spark):
    """Each stage against a plain version of its decision, on what it was given."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, rows = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF01).cache()
        rows[name] = docs.collect()
        assert name == "bpe" or docs.columns == columns
        old = {r["doc_id"]: r for r in before.collect()}
        if name == "quality":
            bad = {r["doc_id"] for r in spark.read.parquet(f"{SF01}/labels.parquet").filter("quality = 0").collect()}
            good = {r["doc_id"] for r in spark.read.parquet(f"{SF01}/labels.parquet").filter("quality = 1").collect()}
            kept = {r["doc_id"] for r in rows[name]}
            assert len(good & kept) > 0.98 * len(good) and len(bad & kept) < 0.1 * len(bad)
        if name == "near_duplicates":
            want = brute([(i, r["text"]) for i, r in old.items()], 5, 80)
            assert {r["doc_id"] for r in rows[name]} == {i for i in want if want[i][1] == i}
        if name == "secrets":
            assert len(rows[name]) == len(old)
            for r in rows[name]:
                assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
                assert ("[REDACTED]" in r["text"]) == bool(base_spans(old[r["doc_id"]]["text"]))
        if name == "bpe":
            enc = bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)._enc
            assert len(rows[name]) == len(rows["mixing"]) and all(r["round_trip"] for r in rows[name])
            assert all(r["ids"] == enc.encode_ordinary(old[r["doc_id"]]["text"]) for r in rows[name][:100])


def test_awkward_rows(spark, awkward):
    """Nulls, empty texts, repeats and odd columns pass every stage."""
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF01)
    ids = {r["doc_id"] for r in docs.collect()}
    assert ids <= {r["doc_id"] for r in awkward.collect()}
    one = corpus_pipeline.drop_near_duplicates(spark, awkward, SF01).collect()
    assert sorted((r["doc_id"] for r in one), key=str) == [1, 3, 4, 5, 6, 7, 8, None]


def test_rows_are_kept_by_row(spark):
    """Rows that share an id but not the text, copies under several ids and rows
    without an id; columns with the stage's own names."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, b), (5, a), (5, b), (None, c), (None, c + " more"), (7, c), (None, "x y"), (None, "x y"), (None, None),
            (None, None), (None, ""), (9, " "), (9, " "), (9, ""), (2, a + " end")]
    docs = spark.createDataFrame([(i, t, "k", "k", "k") for i, t in rows],
                                 "doc_id long, text string, row_key string, kept_id string, component_id string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF01)
    assert got.columns == docs.columns
    want = [(1, b), (2, a + " end"), (7, c), (None, "x y"), (None, None), (None, ""), (9, " "), (9, "")]
    assert sorted([tuple(r)[:2] for r in got.collect()], key=str) == sorted(want, key=str)


def test_empty_table(spark, nothing):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF01)
    assert docs.count() == 0
