"""A training corpus from ``documents``: quality, near-duplicates, secrets, mix and
tokens.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm import bpe, mixing, quality, secrets, setsketch
from chronoline.llm.common import cut
from chronoline.session import scratch_path

# Near duplicates here: five-word shingles and a similarity of 0.8 or more.
SHINGLE_WORDS, LEAST_PERCENT = 5, 80
SENT_ROWS = 1_000_000   # most dropped rows whose keys are sent to every task

# No SQL: the first stage is a fitted network, the last a tokenizer.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.  It is fitted on
    ``docs`` and the labels of those that are not held out."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest id,
    rows without an id last.  Equal texts are one group whatever their ids.  Documents
    without words stay, but rows that repeat an id and text stay once.

    Every row gets a key, written with it, and groups, links and decisions go by that
    key, so rows that share an id, or have none, are told apart.  Only keys are
    shuffled for the decision; the dropped ones are sent to every task up to
    ``SENT_ROWS``, and joined by shuffle beyond.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    rows = cut(docs.withColumn(key, F.monotonically_increasing_id()))
    found = setsketch.near_duplicates(rows, SHINGLE_WORDS, LEAST_PERCENT, id_col=key)
    text = F.coalesce("text", F.lit(""))
    ids = rows.select(F.col(key).alias("r"), F.col("doc_id").alias("i"),
                      F.sha2(text, 256).alias("d"), F.col("text").isNull().alias("none"))
    # Without words: a group for each id and text.  Else the group is the component.
    groups = (found.select(key, "n_shingles", "component_id").join(ids, F.col(key) == F.col("r"))
              .select("r", "i", F.when(F.col("n_shingles") > 0, F.struct("component_id")).alias("c"),
                      F.when(F.col("n_shingles") == 0, F.struct("i", "d", "none")).alias("w")))
    order = F.struct(F.col("i").isNull(), "i", "r")
    best = groups.groupBy("c", "w").agg(F.min(order).alias("best")).select(F.col("best.r").alias("kept_r"))
    gone = cut(groups.select("r").join(best, F.col("r") == F.col("kept_r"), "left_anti"))
    gone = F.broadcast(gone) if gone.count() <= SENT_ROWS else gone
    return rows.join(gone, F.col(key) == F.col("r"), "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; ``n_chars`` follows where a text changes.
    No document is dropped."""
    clean = secrets.redact(docs.withColumn("n_chars", F.struct(F.col("n_chars").alias("n"), F.xxhash64("text").alias("h"))))
    same = F.col("n_chars.h") == F.xxhash64("text")
    return clean.withColumn("n_chars", F.when(same, F.col("n_chars.n")).otherwise(F.char_length("text"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents up to its target; a document that the mix takes
    several times is there several times."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` for every document of the mix."""
    import public_tokenizers as P
    return bpe.tokenized(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage returns is written to the shared
    folder and deleted when the next stage is written; the last is returned."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            gone = spark._jvm.org.apache.hadoop.fs.Path(before)
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
