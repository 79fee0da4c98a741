"""Exact top-k inner products by distributed histogram selection (operator 8)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import cut, ship

BINS = 4096          # bins of one histogram
QUERY_BLOCK = 1024   # most queries of a tile, about
ROW_BLOCK = 8192     # rows of a tile, about
STRIPE = 128         # queries scored at once inside a tile
EXACT_FLOAT = 2 ** 53


def finite(vec: Column) -> Column:
    """True for a vector that is not null and has only finite components."""
    x_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vec.isNotNull() & F.forall(vec, x_ok), F.lit(False))


def scaled_ints(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``key, vec_id, ints``: each component as ``floor(scale * x)``, x as double; ``key``
    tells rows apart that share an id or have none."""
    vec = F.col(vec_col).cast("array<double>")
    return (vectors.filter(finite(vec))
            .select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vec, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("ints")))


def _scores(queries: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stripes of queries, the rows' keys and tie order, their scores (int64) and which
    of these count: vectors of the same length, other than the query's own row."""
    for dim, some in rows.groupby(rows["ints"].str.len()):
        mine = queries[queries["ints"].str.len() == dim]
        if mine.empty:
            continue
        keys, ties = some["key"].to_numpy(), some["tie"].to_numpy()
        r = np.stack(some["ints"].to_list()) if dim else np.zeros((len(some), 0), np.int64)
        for at in range(0, len(mine), STRIPE):
            part = mine.iloc[at:at + STRIPE]
            q = np.stack(part["ints"].to_list()) if dim else np.zeros((len(part), 0), np.int64)
            top = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * max(dim, 1)
            if top < EXACT_FLOAT:   # every partial sum is an exact double
                s = (q.astype(np.float64) @ r.T.astype(np.float64)).astype(np.int64)
            else:
                s = q @ r.T
            yield part, keys, ties, s, part["key"].to_numpy()[:, None] != keys[None, :]


def _histogram(k: int):
    """Counts by query and bin in one tile, of the scores from ``lo`` to below
    ``end``; those from ``end`` on are in ``above`` already.  Bins under the tile's
    own kth score are left out: the kth score of all rows is never below it."""
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, _, _, s, counts in _scores(queries, rows):
            lo, end, width = (part[c].to_numpy()[:, None] for c in ("lo", "end", "width"))
            bins = (s - lo) // width
            ok = counts & (s >= lo) & (s < end)
            n = len(part)
            flat = (np.arange(n)[:, None] * BINS + bins)[ok]
            found, c = np.unique(flat, return_counts=True)
            q, b = found // BINS, found % BINS
            order = np.lexsort((-b, q))
            q, b, c = q[order], b[order], c[order]
            upto = np.cumsum(c)
            start = np.concatenate([[0], upto])[np.searchsorted(q, q)]
            keep = upto - c - start < k
            out.append(pd.DataFrame({"query": part["key"].to_numpy()[q[keep]], "bin": b[keep],
                                     "n": c[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "bin": [], "n": []}, dtype="int64")
    return run


def _select(k: int):
    """Of one tile, the k best rows of each query at or above its threshold."""
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, keys, ties, s, counts in _scores(queries, rows):
            q, r = np.nonzero(counts & (s >= part["lo"].to_numpy()[:, None]))
            score = s[q, r]
            order = np.lexsort((keys[r], ties[r], -score, q))
            q, score, r = q[order], score[order], r[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append(pd.DataFrame({"query": part["key"].to_numpy()[q[keep]], "key": keys[r[keep]],
                                     "tie": ties[r[keep]], "score": score[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "key": [], "tie": [], "score": []}, dtype="int64")
    return run


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, scale: int = 1024,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``query_every``, its ``k`` largest integer inner products with the other rows
    (all, if fewer), ties to the smaller id.

    Every pass scores all rows against all queries in tiles (a block of queries
    by a block of rows, both of bounded size) and keeps only a histogram of each
    query's scores.  The bin that holds the kth score becomes the next pass's
    range, until it is one score wide or holds few rows.  The last pass returns
    the rows above each threshold, of a tile at most ``k`` for each query, however
    many tie, and one window ranks them.  Scores are never stored.

    Vectors that are null or hold null or non-finite components take no part; vectors
    of different lengths are not compared; an empty vector scores 0.  Every row counts:
    rows that share an id are candidates, and queries, of their own (a repeated query
    id has a list for each of its rows), and a row with a null id is a candidate, the
    last of equal scores.  Scores must fit a 64-bit integer.  No queries or no rows: no rows.
    """
    ship(vectors.sparkSession)
    v = cut(scaled_ints(vectors, id_col, vec_col, scale)
            .withColumn("tie", F.coalesce("vec_id", F.lit(2 ** 63 - 1))))
    squares = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    is_query = F.coalesce(F.pmod("vec_id", F.lit(query_every)) == 0, F.lit(False))
    size = v.agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q"),
                 F.max(squares).alias("m")).first()
    n_tiles = max(1, math.ceil(size["n"] / ROW_BLOCK))
    n_blocks = max(1, math.ceil((size["q"] or 0) / QUERY_BLOCK))
    bound = min(2 ** 62, int(size["m"] or 0) + 1)   # |a.b| <= max |x|^2
    rows = (v.withColumn("tile", F.pmod(F.xxhash64("key"), F.lit(n_tiles).cast("long")))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    queries = v.filter(is_query).withColumn("block", F.pmod(F.hash("key"), F.lit(n_blocks)).cast("int"))
    width = -(-(2 * bound + 1) // BINS)
    state = queries.select(F.col("key").alias("query"), F.lit(-bound).cast("long").alias("lo"),
                           F.lit(BINS * width - bound).cast("long").alias("end"), F.lit(width).cast("long").alias("width"),
                           F.lit(0).cast("long").alias("above"))

    def tiles(state: DataFrame):
        now = (queries.join(state.withColumnRenamed("query", "s_id"), F.col("key") == F.col("s_id"))
               .select(F.col("key").alias("key"), F.col("ints").alias("ints"), "lo", "end", "width", "block",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long"))).alias("tile")))
        return now.groupBy("block", "tile").cogroup(rows.groupBy("block", "tile"))

    down = Window.partitionBy("query").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    while size["q"]:
        hist = (tiles(state).applyInPandas(_histogram(k), "query long, bin long, n long")
                .groupBy("query", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down)))
        short = F.col("above") + F.col("upto") < k
        edge = (state.join(hist.withColumnRenamed("query", "h_id"), F.col("query") == F.col("h_id"), "left")
                .groupBy("query", "lo", "width", "above")
                # the highest bin that reaches k; with fewer rows than k, the lowest that has any
                .agg(F.min(F.struct(F.coalesce(short, F.lit(True)).alias("short"),
                                    F.when(short, F.col("bin")).otherwise(-F.col("bin")).alias("order"),
                                    "bin", "n", "upto")).alias("e")))
        lo = F.col("lo") + F.coalesce(F.col("e.bin"), F.lit(0)) * F.col("width")
        state = cut(edge.select(
            "query", lo.alias("lo"), (lo + F.col("width")).alias("end"),
            F.ceil(F.col("width") / BINS).cast("long").alias("width"),
            (F.col("above") + F.coalesce(F.col("e.upto") - F.col("e.n"), F.lit(0))).alias("above"),
            F.coalesce(F.col("e.n"), F.lit(0)).alias("inside")))
        most = state.agg(F.max(F.col("above") + F.col("inside"))).first()[0]
        state = state.drop("inside")
        if width == 1 or most <= 4 * k:
            break
        width = -(-width // BINS)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "tie", "key")
    names = v.select(F.col("key").alias("n_key"), F.col("vec_id").alias("name"))
    asked = queries.select(F.col("key").alias("q_key"), F.col("vec_id").alias("query_id"))
    found = (tiles(state).applyInPandas(_select(k), "query long, key long, tie long, score long")
             .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))
    return (found.join(names, F.col("key") == F.col("n_key")).join(asked, F.col("query") == F.col("q_key"))
            .select("query_id", "rank", F.col("name").alias("vec_id"), "score"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.ints, v.ints)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
