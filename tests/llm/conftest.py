"""Small tables with every awkward case, and frames made of them."""

import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 20_000

# doc_id, text: null, empty, blank, very long, repeated rows, ties, other scripts.
DOCS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the angry bear"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the angry bear"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the angry bear"),
    (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "日本語のテキスト、空白なし"), (8, "a"),
    (9, "THE QUICK brown fox jumps over the lazy dog and runs away from the angry bear"),
    (None, "a text without an id"),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("size", T.StringType()), T.StructField("row", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("shard", T.StringType())])


def frame(spark, docs, langs=("en",), sources=("s0",)):
    rows = [(i, t, langs[n % len(langs)], sources[n % len(sources)], len(t or ""), "x", "x", "x", "x", "x")
            for n, (i, t) in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def awkward(spark):
    return frame(spark, DOCS, ("en", None, "de"), ("s0", None, "s1", "s0")).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
