"""Embedding near-duplicates by cross-polytope hashing with multiprobe buckets
(operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import connected_components, cut, fresh, ship
from chronoline.llm.topk import finite

TABLES = 8       # hash tables
HASHES = 3       # cross-polytope hashes of one table
PROBES = 4       # buckets of a vector in one table, its own and the next likeliest
CHOICES = 4      # coordinates of a hash that a probe may choose from
TILE = 512       # rows on either side of one comparison
SEED = 20240229


def hadamard(y: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = y.shape
    h = 1
    while h < d:
        y = y.reshape(n, d // (2 * h), 2, h)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return y


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, by way of their largest component, so that no square
    overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_codes(x: np.ndarray) -> np.ndarray:
    """``TABLES * PROBES`` bucket codes of each unit row, smallest table first.

    One hash is the nearest signed axis after three rounds of random signs and a
    Hadamard transform.  The probes of a table are the combinations of nearby axes
    with the least sum of squared gaps to the nearest ones.
    """
    n, d = x.shape
    wide = max(8, 1 << (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - d))) / wide ** 1.5
    rng = np.random.default_rng(SEED)
    pick = np.indices([CHOICES] * HASHES).reshape(HASHES, -1)
    out = np.empty((n, TABLES, PROBES), np.int64)
    for t in range(TABLES):
        gap, code = 0.0, 0
        for k in range(HASHES):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], wide))
            axes = np.argsort(-np.abs(y), 1, kind="stable")[:, :CHOICES]
            at = np.take_along_axis(y, axes, 1)
            gap = gap + ((np.abs(at[:, :1]) - np.abs(at)) ** 2)[:, pick[k]]
            code = code * (2 * wide) + (2 * axes + (at < 0))[:, pick[k]]
        best = np.argsort(gap, 1, kind="stable")[:, :PROBES]
        out[:, t] = t * (2 * wide) ** HASHES + np.take_along_axis(code, best, 1)
    return out.reshape(n, TABLES * PROBES)


def _rows(column: pa.ListArray, a: int, b: int) -> np.ndarray:
    """Rows a to b of a list column with lists of one length, as a matrix."""
    offsets = column.offsets
    return (column.values.slice(offsets[a].as_py(), offsets[b].as_py() - offsets[a].as_py())
            .to_numpy(zero_copy_only=False).reshape(b - a, -1))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the codes; rows of one length go together."""
    for batch in batches:
        size = np.diff(batch.column("vec").offsets.to_numpy())
        codes = np.empty((len(batch), TABLES * PROBES), np.int64)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            x = _rows(batch.column("vec").take(pa.array(at)), 0, len(at))
            codes[at] = bucket_codes(unit(x))
        offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * codes.shape[1])
        yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))],
                              names=[*batch.schema.names, "codes"])


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row of its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            seen = edge = np.zeros(len(linked), bool)
            edge[i] = True
            while edge.any():
                seen = seen | edge
                edge = linked[edge].any(0) & ~seen
            root[seen] = i
    return root


def _first_meeting(a: np.ndarray, b: np.ndarray, code: int) -> np.ndarray:
    """Whether ``code`` is the first bucket that rows of codes have in common."""
    first = np.ones(len(a), bool)
    for t in range(TABLES):
        at = slice(t * PROBES, (t + 1) * PROBES)
        live = np.flatnonzero(first)
        both = (a[live, at, None] == b[live, None, at]).any(2)
        has = (a[:1, at] == code).any()
        if not has:
            first[live[both.any(1)]] = False
        else:
            low = np.where(both, a[live, at], np.iinfo(np.int64).max).min(1)
            first[live[low != code]] = False
            break
    return first


def _compare(least: float):
    """Links inside each tile: ``rep, other, links`` rows, where ``links`` adds to
    the number of linked vectors, and ``other`` joins the row to its component's
    first in this tile.  A pair counts in the first bucket that it shares."""
    def tile(t: pa.Table, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = t["rep"].chunk(0).slice(a, b - a).to_numpy()
        n = t["n"].chunk(0).slice(a, b - a).to_numpy()
        x = unit(_rows(t["vec"].chunk(0), a, b))
        codes = _rows(t["codes"].chunk(0), a, b)
        side = t["side"].chunk(0).slice(a, b - a).to_numpy()
        i, j = t["i"].chunk(0)[a].as_py(), t["j"].chunk(0)[a].as_py()
        linked = x @ x.T >= least
        np.fill_diagonal(linked, False)
        mine = np.triu(linked) if i == j else linked & (side[:, None] == i) & (side[None, :] == j)
        p, q = np.nonzero(mine)
        links = np.zeros(len(ids), np.int64)
        for at in range(0, len(p), 1 << 16):
            r, s = p[at:at + (1 << 16)], q[at:at + (1 << 16)]
            once = _first_meeting(codes[r], codes[s], t["code"].chunk(0)[a].as_py())
            np.add.at(links, r[once], n[s[once]])
            np.add.at(links, s[once], n[r[once]])
        root = _forest(linked) if len(p) else np.arange(len(ids))
        keep = (links > 0) | (root != np.arange(len(ids)))
        return ids[keep], ids[root[keep]], links[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in _with_end(batches):
            if batch is not None:
                held.append(batch)
                if sum(map(len, held)) < 4 * TILE:
                    continue
            if not held:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            keys = np.stack([t[c].to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            ends = [*cuts.tolist(), *([t.num_rows] if batch is None else [])]
            out, a = [], 0
            for b in ends:
                if b - a > 1:
                    out.append(tile(t, a, b))
                a = b
            held = t.slice(a).combine_chunks().to_batches() if a < t.num_rows else []
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["rep", "other", "links"])
    return run


def _with_end(batches):
    yield from batches
    yield None


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Links join vectors with a cosine of ``least`` or more, in double precision.
    Equal vectors form a class, and only one of a class is hashed.  Vectors that
    share a bucket are compared exactly; a bucket with more than :data:`TILE`
    vectors is dealt into blocks, and every pair of blocks is one task's tile, so
    no bucket is gathered whole and no vector is left out.  Tiles return counts and
    spanning forests, never pairs.  Recall of the hashing at a cosine of 0.95 is
    above 0.999 (measured in the tests against brute force).

    Vectors that are null, zero, empty or hold null or non-finite components have
    no links and are components of their own.  Vectors of different lengths are
    never linked.  Every row is a vector of its own, with a key of its own: rows that
    share an id and a vector link with each other, and a row with a null id links like
    any other (its component is null only where no member has an id).  No rows: no
    rows.
    """
    ship(vectors.sparkSession)
    vec = F.col(vec_col).cast("array<double>")
    rows = cut(vectors.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
               .withColumn("ok", finite(F.col("vec")) & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))))
    firsts = cut(rows.filter("ok").groupBy("vec").agg(F.min("key").alias("rep"), F.count("*").alias("n"), F.min("id").alias("first_id")))
    reps = firsts.select("rep", "n", "vec")
    fields = "rep long, n long, vec array<double>, codes array<long>"
    reps = cut(reps.mapInArrow(_hashed, fields))
    codes = reps.select("rep", F.size("vec").alias("dim"), F.explode("codes").alias("code"))
    codes = codes.withColumn("bucket", F.xxhash64("dim", "code"))
    crowds = codes.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1").select(
        fresh("bucket").alias("c_bucket"), F.ceil(F.col("c") / TILE).cast("int").alias("blocks"))
    side = F.pmod(F.hash("rep"), F.col("blocks"))
    tiles = (codes.join(crowds, F.col("bucket") == F.col("c_bucket"))
             .select(F.col("rep").alias("t_rep"), "code", "bucket", side.alias("side"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
             .withColumn("i", F.least("side", "o")).withColumn("j", F.greatest("side", "o")).drop("o"))
    order = ["bucket", "i", "j"]
    tiles = (tiles.join(reps, F.col("t_rep") == F.col("rep")).repartition(*order).sortWithinPartitions(*order, "rep")
             .select("bucket", "i", "j", "side", "code", "rep", "n", "vec", "codes"))
    found = cut(tiles.mapInArrow(_compare(least), "rep long, other long, links long"))
    links = found.groupBy(F.col("rep").alias("l_rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found, "rep", "other")
    classes = (firsts.select("rep", "n", "first_id", F.col("vec").alias("r_vec"))
               .join(links, F.col("rep") == F.col("l_rep"), "left")
               .join(parts, F.col("rep") == F.col("node"), "left")
               .select("r_vec", "first_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                       F.coalesce("component", "rep").alias("label")))
    least_ids = classes.groupBy("label").agg(F.min("first_id").alias("component")).select(
        fresh("label").alias("i_label"), "component")
    classes = classes.join(least_ids, F.col("label") == F.col("i_label")).select("r_vec", "links", "component")
    good = rows.filter("ok").join(classes, F.col("vec") == F.col("r_vec")).select("id", "links", "component")
    alone = rows.filter("NOT ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return good.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0
    AND len([y FOR y IN embedding IF y <> 0]) > 0),
e AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach(u, w) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.u, e.w FROM reach AS r JOIN e ON r.w = e.u)
SELECT d.vec_id, (SELECT count(*) FROM e WHERE e.u = d.vec_id) AS n_links,
  r.component_id, d.vec_id = r.component_id AS kept
FROM embeddings AS d JOIN (SELECT u, min(w) AS component_id FROM reach GROUP BY u) AS r ON r.u = d.vec_id
"""
