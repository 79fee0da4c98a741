"""Quality classifier: random-indexing word vectors and a two-layer network
(operator 4)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import cut, ship, text_blocks, whole_text

BUCKETS = 8192       # hashed vocabulary: the word vectors' size does not grow with the corpus
DIM = 48             # length of a word vector
NONZERO = 4          # entries of an index vector
WINDOW = 2           # neighbours on either side that make a context
SLICES = 64          # rows in which a table of counts travels
FAN_IN = 64          # tables that one task adds up
TRAIN_ROWS = 20_000  # bound of the labelled sample that the network is fitted on
HIDDEN, EPOCHS, BATCH, STEP = 32, 40, 256, 3e-3
FOLDS = 5            # rows with crc32(id) mod FOLDS = 0 are held out
THRESHOLD = 0.3
SEED = 11

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= 1 << 18:
            self.clear()
        b = self[word] = xxhash.xxh3_64_intdigest(word) % BUCKETS
        return b


_BUCKET = _Buckets()


def token_ids(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's words, numbers and runs of signs, in parts."""
    for part in text_blocks(text):
        words = _TOKEN.findall(part.lower())
        yield np.fromiter(map(_BUCKET.__getitem__, words), np.int64, len(words))


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector; one
    more row, for no word, has sign 0."""
    rng = np.random.default_rng(SEED)
    place = np.argsort(rng.random((BUCKETS + 1, DIM)), 1)[:, :NONZERO]
    sign = rng.choice([-1.0, 1.0], (BUCKETS + 1, NONZERO))
    sign[BUCKETS] = 0
    return place, sign


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors of each bucket's neighbours over one partition."""
    place, sign = _index_vectors()
    total = np.zeros((BUCKETS + 1) * DIM)
    gap = np.full(WINDOW, BUCKETS)

    def add(parts: list[np.ndarray]) -> None:
        ids = np.concatenate(parts)
        for o in range(1, WINDOW + 1):
            for a, b in ((ids[:-o], ids[o:]), (ids[o:], ids[:-o])):
                at = a[:, None] * DIM + place[b]
                total[:] += np.bincount(at.ravel(), sign[b].ravel(), len(total))

    for batch in batches:
        parts, n = [gap], 0
        for text in batch.column("text"):
            for ids in token_ids(text.as_py()):
                parts += [ids, gap]
                n += len(ids)
                if n > 1 << 18:
                    add(parts)
                    parts, n = [gap], 0
        add(parts)
    yield from _slices(total[:BUCKETS * DIM])


def _slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = total.astype(np.int64).reshape(SLICES, -1)
    yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                          ["slice", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the slices that share a slice number and a part number."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for *k, v in zip(batch["slice"].to_pylist(), batch["part"].to_pylist(), batch["sums"].to_pylist()):
            total[tuple(k)] = total.get(tuple(k), 0) + np.frombuffer(v, np.int64)
    if total:
        yield pa.record_batch([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                               pa.array([v.tobytes() for v in total.values()], pa.binary())], ["slice", "part", "sums"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """``BUCKETS x DIM`` unit vectors from the contexts of all documents, with each
    word's own index vector added.

    Every partition adds up a table of fixed size; tables are added in a tree of
    ``FAN_IN``, slice by slice.  The result is ``BUCKETS * DIM`` numbers at any
    input size, and only these reach the driver."""
    ship(docs.sparkSession)
    parts = cut(docs.select(whole_text(text_col).alias("text")).mapInArrow(_contexts, "slice int, sums binary")
                .withColumn("part", F.spark_partition_id()))
    n = parts.agg(F.max("part")).first()[0] or 0
    while n:
        n //= FAN_IN
        parts = (parts.select("slice", F.floor(F.col("part") / FAN_IN).cast("int").alias("part"), "sums")
                 .repartition("slice", "part").mapInArrow(_added, "slice int, part int, sums binary"))
    total = np.zeros((SLICES, BUCKETS * DIM // SLICES))
    for r in parts.collect():
        total[r["slice"]] += np.frombuffer(r["sums"], np.int64)
    place, sign = _index_vectors()
    own = np.zeros((BUCKETS, DIM))
    np.add.at(own, (np.arange(BUCKETS)[:, None], place[:BUCKETS]), sign[:BUCKETS])
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    return (unit(total.reshape(BUCKETS, DIM)) + unit(own)).astype(np.float32)


def features(text: str, vectors: np.ndarray) -> np.ndarray:
    """A document's pooled word vectors: their mean, the mean product of each with
    its follower (which tells repetition and order), and the mean's length.  An
    empty text has zeros."""
    n, first, pairs = 0, np.zeros(DIM), np.zeros(DIM)
    last = np.zeros((0, DIM), np.float32)
    for ids in token_ids(text):
        for at in range(0, len(ids), 1 << 14):
            v = np.concatenate([last, vectors[ids[at:at + (1 << 14)]]])
            first += v[len(last):].sum(0)
            pairs += np.einsum("ij,ij->j", v[:-1], v[1:])
            n += len(v) - len(last)
            last = v[-1:]
    first, pairs = first / max(n, 1), pairs / max(n - 1, 1)
    return np.concatenate([first, pairs, [np.sqrt(first @ first), pairs.sum()]])


@dataclass
class Network:
    """Standardized features, one hidden layer, a logit and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Network:
    """Adam on cross-entropy over folds other than 1; fold 1 sets the temperature
    with the least cross-entropy.  Rows must come in a fixed order: the result then
    is a function of them.  With no rows, or one label alone, the score is the
    smoothed share of that label."""
    d = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    flat = Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), math.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return flat
    use = np.flatnonzero(fold != 1)
    if len(set(y[use].tolist())) < 2:
        use = np.arange(len(y))
    rng = np.random.default_rng(SEED)
    net = Network(x[use].mean(0), x[use].std(0) + 1e-6, rng.normal(0, math.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, math.sqrt(1 / HIDDEN), HIDDEN), 0.0)
    z = (x - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(use), max(1, len(use) // BATCH)):
            h = np.maximum(z[at] @ params[0] + params[1], 0)
            g = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -60, 60))) - y[at]
            g /= len(at)
            back = np.outer(g, params[2]) * (h > 0)
            grads = [z[at].T @ back + 1e-4 * params[0], back.sum(0), h.T @ g + 1e-4 * params[2], np.array([g.sum()])]
            step += 1
            for p, m, gr in zip(params, moment, grads):
                m[0] += 0.1 * (gr - m[0])
                m[1] += 0.001 * (gr * gr - m[1])
                p -= STEP * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    held = np.flatnonzero(fold == 1)
    if len(held):
        logit, label = net.logits(x[held]), y[held]
        loss = lambda t: np.logaddexp(0, np.where(label > 0, -logit, logit) / t).mean()
        net.temperature = float(min(np.geomspace(0.25, 16, 97), key=loss))
    return net


def fold_of(id_: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds


def _pooled(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py(), vectors) for t in batch.column("text")]
            yield pa.record_batch([*(batch.column(c) for c in ("id", "fold", "y")), pa.array(x, pa.list_(pa.float64()))],
                                  ["id", "fold", "y", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all ``docs`` and a network from the labels of rows that
    are not held out.

    At most about ``max_rows`` labelled rows are used, chosen by a hash of the id;
    that bound holds for the broadcast and for what reaches the driver.  A document
    with several labels has their majority; null labels are left out.  Input order
    does not matter."""
    vectors = word_vectors(docs, text_col)
    fold = fold_of(F.col(id_col), FOLDS)
    known = (labels.filter(F.col(label_col).isNotNull() & (fold != 0) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("l_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y")))
    n = known.count()
    known = known.filter(F.pmod(F.xxhash64("l_id", F.lit(SEED)), F.lit(1 << 30)) * max(n, 1) < max_rows * (1 << 30))
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"), fold.cast("int").alias("fold"))
    rows = rows.join(F.broadcast(known), F.col("id") == F.col("l_id")).select("id", "text", "fold", "y")
    id_type = docs.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(_pooled(vectors), f"id {id_type}, fold int, y int, x array<double>").toArrow()
    got = got.take(np.argsort(got["id"].to_numpy(), kind="stable"))
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(got), 2 * DIM + 2)
    return vectors, fit_network(x, got["y"].to_numpy().astype(np.float64), got["fold"].to_numpy())


def _scored(vectors: np.ndarray, net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = np.stack([features(t.as_py(), vectors) for t in batch.column("text")])
                yield pa.record_batch([batch.column("id"), batch.column("fold"), pa.array(net.scores(x))],
                                      ["id", "fold", "score"])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, Network], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, score, predicted``.  The
    score depends on the whole text alone.  Null and empty texts have the score of
    no words; repeated rows repeat; no rows: no rows."""
    ship(docs.sparkSession)
    vectors, net = model
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"),
                       fold_of(F.col(id_col), FOLDS).cast("int").alias("fold"))
    return (rows.mapInArrow(_scored(vectors, net), f"id {id_type}, fold int, score double")
            .select(F.col("id").alias(id_col), (F.col("fold") == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: tuple[np.ndarray, Network], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches :data:`THRESHOLD`."""
    ship(docs.sparkSession)
    vectors, net = model

    @F.pandas_udf("double")
    def score_of(texts: pd.Series) -> pd.Series:
        return pd.Series([net.scores(features(t, vectors)[None])[0] for t in texts], dtype=float)

    return docs.filter(score_of(whole_text(text_col)) >= THRESHOLD)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
