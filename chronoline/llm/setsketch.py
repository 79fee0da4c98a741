"""Near-duplicate documents by SetSketch registers (operator 7)."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import connected_components, cut, fresh, release, ship, whole_text

REGISTERS = 128      # a power of two
BASE, RATE = 1.001, 20.0   # register values are spaced by BASE; RATE scales the variates
TOP = 2 ** 16 - 1    # largest register value
BAND_RECALL = 0.998  # least chance that a pair at the threshold shares a band
SIGMAS = 3.2         # estimates so far below the threshold are not verified
PIVOTS = 3           # members of a bucket that are compared with all of it first
TILE = 256           # rows on either side of one comparison in a crowded bucket
TILE_SHINGLES = 1 << 21    # and about as many shingles
CHUNK = 64           # members verified together with one pivot
WORDS_CACHED = 1 << 18


class _WordHash(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= WORDS_CACHED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; A-Z are lower-cased, words
    are split at ASCII white space; fewer than k words are one shingle."""
    words = text.encode().lower().split()   # bytes: ASCII letters and white space alone
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(_HASH.__getitem__, words), _U, len(words))
    k = min(k, len(h))
    s = np.full(len(h) - k + 1, _U(k))
    for i in range(k):
        s = _mix(s + h[i:len(h) - k + 1 + i])
    return np.unique(s)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes, as 16-bit integers.

    Each element gives every register an exponential variate; register i keeps the
    least, as ``floor(1 - log_BASE(x))`` cut to 0..TOP.  An element's variates are
    drawn in strata: the j-th smallest lies in the j-th of REGISTERS equal slices
    of probability and goes to the j-th register of the element's own order, so
    strata that no register can still use are never drawn.  Registers of a union
    are the greatest of the registers of its parts.
    """
    m = REGISTERS
    if not len(s):
        return np.zeros(m, np.uint16)
    low = np.full(m, 1.0)
    first = (s >> _U(57)).astype(np.int64)
    stride = ((s >> _U(50)) & _U(127)).astype(np.int64) | 1
    j = 0
    while j < m and low.max() > j / m:
        step = min(m - j, max(1, -(-6 * m // len(s))))
        for at in range(0, len(s), 1 << 14):
            part = slice(at, at + (1 << 14))
            strata = np.arange(j, j + step)
            u = (_mix(s[part, None] + (strata.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)) >> _U(11)) * 2.0 ** -53
            to = (first[part, None] + strata * stride[part, None]) & (m - 1)
            np.minimum.at(low, to.ravel(), ((strata + u) / m).ravel())
        j += step
    x = -np.log1p(-np.minimum(low, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / math.log(BASE)), 0, TOP).astype(np.uint16)


_GRID = np.linspace(0.0, 1.0, 201)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarities of row pairs of registers by maximum likelihood, given
    the set sizes: the joint law of the numbers of greater, smaller and equal
    registers.  Searched on a grid of the possible values."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = REGISTERS - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    j = _GRID[None, :] * np.minimum(u / v, v / u)
    p = lambda x: np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-12)
    p_more, p_less = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    law = more * np.log(p_more) + less * np.log(p_less) + same * np.log(np.maximum(1 - p_more - p_less, 1e-12))
    return np.take_along_axis(j, law.argmax(1)[:, None], 1)[:, 0]


def band_rows(threshold: float) -> int:
    """Most registers in a band so that a pair at the threshold shares a band with
    a chance of BAND_RECALL."""
    return max(r for r in range(1, 33) if 1 - (1 - threshold ** r) ** (REGISTERS // r) >= BAND_RECALL or r == 1)


def _sketched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, regs = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                k1.append(int(_mix(s).sum(dtype=_U).astype(np.int64)))
                k2.append(int(np.bitwise_xor.reduce(_mix(s + _U(1)), initial=_U(0)).astype(np.int64)))
                regs.append(registers(s).tobytes())
            yield pa.record_batch([batch.column("id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                                   pa.array(k2, pa.int64()), pa.array(regs, pa.binary())],
                                  ["id", "n", "k1", "k2", "regs"])
    return run


def _matrix(column) -> np.ndarray:
    """Registers of a binary column as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(least: float):
    """Keeps pairs whose estimate reaches ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                j = estimate(_matrix(batch["ra"]), _matrix(batch["rb"]), batch["na"].to_numpy(), batch["nb"].to_numpy())
                yield batch.select(["a", "b"]).filter(pa.array(j >= least))
    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, int, int]]:
    """Runs of equal keys in sorted batches, as (table, begin, end); a run is held
    whole, so keys must bound it.  ``most``: rows to gather before looking."""
    held: list[pa.RecordBatch] = []
    ended = False
    while not ended:
        batch = next(batches, None)
        ended = batch is None
        if batch is not None:
            held.append(batch)
        if not held or (not ended and sum(map(len, held)) < most):
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        k = np.stack([t[c].to_numpy() for c in keys])
        cuts = (np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1).tolist()
        a = 0
        for b in [*cuts, *([t.num_rows] if ended else [])]:
            if b > a:
                yield t, a, b
            a = b
        held = t.slice(a).to_batches() if a < t.num_rows else []


def _candidates(part: pa.Table, threshold: float, least: float, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and estimates of a tile's pairs that lie in different components
    and are close enough; each pair only in the first band that it shares."""
    rep, n, label, side = (part[c].to_numpy() for c in ("rep", "n", "label", "side"))
    i, j, nth = (part[c][0].as_py() for c in ("i", "j", "nth"))
    p, q = np.nonzero((label[:, None] != label[None, :]) & (side[:, None] == i) & (side[None, :] == j)
                      & (np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]))
                      & ((i != j) | (rep[:, None] < rep[None, :])))
    regs, found = _matrix(part["regs"]), [(np.zeros(0, int),) * 2 + (np.zeros(0),)]
    for x in range(0, len(p), 1 << 13):
        r, s = p[x:x + (1 << 13)], q[x:x + (1 << 13)]
        before = (regs[r, :nth * rows] == regs[s, :nth * rows]).reshape(len(r), nth, rows).all(2).any(1)
        r, s = r[~before], s[~before]
        j_hat = estimate(regs[r], regs[s], n[r], n[s])
        found.append((r[j_hat >= least], s[j_hat >= least], j_hat[j_hat >= least]))
    return tuple(np.concatenate(c) for c in zip(*found))


TILE_KEY = ["band", "i", "j"]


def _active(threshold: float, least: float, rows: int):
    """The rows of each tile that are in a candidate pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at, to in groups(batches, TILE_KEY, 4 * TILE):
            part = t.slice(at, to - at)
            p, q, _ = _candidates(part, threshold, least, rows) if to - at > 1 else ([],) * 3
            if len(p):
                yield from part.take(np.unique(np.concatenate([p, q]))).combine_chunks().to_batches()
    return run


def _tile_links(k: int, percent: int, threshold: float, least: float, rows: int):
    """Exact check of a tile's candidate pairs, likeliest first; ``src, dst`` are
    components.  A pair whose components have met in the tile is not checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at, to in groups(batches, TILE_KEY, 1):
            part = t.slice(at, to - at)
            label, met = part["label"].to_pylist(), {}
            p, q, j_hat = _candidates(part, threshold, least, rows)

            def root(x: int) -> int:
                while met.get(x, x) != x:
                    x = met[x]
                return x

            @functools.lru_cache(2 * TILE)
            def shingles(r: int) -> np.ndarray:
                return shingle_set(part["text"][r].as_py(), k)

            for x in np.argsort(-j_hat, kind="stable"):
                r, s = int(p[x]), int(q[x])
                if root(label[r]) != root(label[s]) and _linked(shingles(r), shingles(s), percent):
                    lo, hi = sorted((root(label[r]), root(label[s])))
                    met[hi] = lo
            if met:
                yield pa.record_batch([pa.array(list(met.values()), pa.int64()), pa.array(list(met), pa.int64())], ["src", "dst"])
    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(k: int, percent: int):
    """Exact check of a pivot's members: ``src, dst`` of the links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivot = None, None
        for batch in batches:
            src, dst = [], []
            for a, chunk, member, id_, text in zip(*(batch.column(c) for c in ("a", "chunk", "member", "id", "text"))):
                s = shingle_set(text.as_py(), k)
                if not member.as_py():
                    key, pivot = (a.as_py(), chunk.as_py()), s
                    continue
                if key != (a.as_py(), chunk.as_py()):
                    raise ValueError("a member came without its pivot")
                if _linked(pivot, s, percent):
                    src.append(a.as_py())
                    dst.append(id_.as_py())
            yield pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])
    return run


def _verify(texts: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The links among ``pairs`` (``a, b``), from whole sets.  Members meet their
    pivot in chunks, so a pivot of very many members is many small groups."""
    chunks = pairs.groupBy(F.col("a").alias("c_a")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    chunks = chunks.select(fresh("c_a").alias("c_a"), "chunks")
    placed = (pairs.join(chunks, F.col("a") == F.col("c_a"))
              .select("a", F.pmod(F.hash("b"), F.col("chunks")).alias("chunk"), "b"))
    roles = (placed.select("a", "chunk", F.lit(1).alias("member"), F.col("b").alias("p_id"))
             .unionByName(placed.select("a", "chunk").distinct()
                          .select("a", "chunk", F.lit(0).alias("member"), F.col("a").alias("p_id"))))
    return (texts.join(roles, F.col("id") == F.col("p_id")).select("a", "chunk", "member", "id", "text")
            .repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member", "id")
            .mapInArrow(_verified(k, percent), "src long, dst long"))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept``.

    Links join documents whose sets of k-word shingles have a Jaccard similarity
    of ``percent`` or more, confirmed on whole sets; a component is named by its
    smallest id, and that document is kept.

    Equal sets form a class; one of a class is compared.  Bands of register values
    make buckets.  First each bucket's pivots are compared with all of it; then,
    where a bucket still spans several components, all pairs of different
    components in it, inside tiles of bounded size.  Likelihood estimates choose the
    pairs that are verified.  A pair inside one component is never compared again,
    pairs leave no task, and no pair of texts that share a band is left out.

    Null and empty texts, and texts without words, have no shingles and are
    components of their own.  Repeated rows repeat, in one component.  Ids are
    64-bit integers; rows with a null id are components of their own (null).  No
    rows: no rows.
    """
    ship(docs.sparkSession)
    threshold = percent / 100
    least = threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / REGISTERS)
    rows = band_rows(threshold)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    sketches = cut(texts.mapInArrow(_sketched(k), "id long, n long, k1 long, k2 long, regs binary"))
    named = (F.col("n") > 0) & F.col("id").isNotNull()
    key = ["k1", "k2", "n"]
    classes = cut(sketches.filter(named).groupBy(*key).agg(F.min("id").alias("rep"), F.first("regs").alias("regs")))

    bands = classes.select("rep", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // rows - 1)),
        lambda b: F.xxhash64(b, F.substring("regs", b * (2 * rows) + 1, F.lit(2 * rows))))).alias("nth", "band"))
    drawn = [F.min(F.struct(F.xxhash64("rep", F.lit(i)).alias("h"), "rep")).alias(f"p{i}") for i in range(PIVOTS)]
    crowds = bands.groupBy("band").agg(F.count("*").alias("c"), *drawn).filter("c > 1").select(
        fresh("band").alias("c_band"), "c", F.array(*[F.col(f"p{i}.rep") for i in range(PIVOTS)]).alias("pivots"))
    members = cut(bands.join(crowds, F.col("band") == F.col("c_band")).select("band", "nth", "c", "rep", "n", "pivots"))
    pairs = (members.select("rep", F.explode("pivots").alias("p")).filter("rep <> p")
             .select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct())

    tried = cut(_estimated(pairs, classes, threshold, least))
    links = cut(_verify(texts, tried, k, percent))
    release(docs.sparkSession)
    parts = cut(connected_components(links))

    labels = F.coalesce(F.col("component"), F.col("rep"))
    known = (members.filter("c > 2").join(parts, F.col("rep") == F.col("node"), "left")
             .select("band", "nth", F.col("rep").alias("t_rep"), F.col("n").alias("t_n"), labels.alias("label")))
    split = known.groupBy("band").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.ceil(F.greatest(F.count("*") / TILE, F.sum("t_n") / TILE_SHINGLES)).cast("int").alias("blocks"))
    split = split.filter("lo <> hi").select(fresh("band").alias("s_band"), "blocks")
    tiles = (known.join(split, F.col("band") == F.col("s_band"))
             .select("band", "nth", "t_rep", "label", F.pmod(F.hash("t_rep"), "blocks").alias("side"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
             .withColumn("i", F.least("side", "o")).withColumn("j", F.greatest("side", "o")))
    sorted_by_tile = lambda df: df.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "rep")
    fields = ["band", "i", "j", "nth", "side", "rep", "n", "label", "regs"]
    shape = "band long, i int, j int, nth int, side int, rep long, n long, label long, regs binary"
    close = (threshold, least, rows)
    active = cut(sorted_by_tile(tiles.join(classes, F.col("t_rep") == F.col("rep")).select(*fields))
                 .mapInArrow(_active(*close), shape))
    release(docs.sparkSession)
    late = (sorted_by_tile(active.join(texts, F.col("rep") == F.col("id")).select(*fields, "text").distinct())
            .mapInArrow(_tile_links(k, percent, *close), "src long, dst long"))
    joined = connected_components(late).select(F.col("node").alias("j_node"), F.col("component").alias("j"))

    final = (classes.select(*[F.col(c).alias(f"f_{c}") for c in key], "rep")
             .join(parts, F.col("rep") == F.col("node"), "left")
             .select(*[f"f_{c}" for c in key], labels.alias("label"))
             .join(joined, F.col("label") == F.col("j_node"), "left")
             .select(*[f"f_{c}" for c in key], F.coalesce("j", "label").alias("component")))
    same = [F.col(c) == F.col(f"f_{c}") for c in key]
    has = sketches.filter(named).select("id", *key).join(final, same[0] & same[1] & same[2]).select("id", "n", "component")
    alone = sketches.filter(~named).select("id", "n", F.col("id").alias("component"))
    id_type = docs.schema[id_col].dataType
    return has.unionByName(alone).select(
        F.col("id").cast(id_type).alias(id_col), F.col("n").alias("n_shingles"),
        F.col("component").cast(id_type).alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float, least: float) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose estimate comes near it."""
    side = lambda s: classes.select(F.col("rep").alias(f"{s}_rep"), F.col("n").alias(f"n{s}"), F.col("regs").alias(f"r{s}"))
    both = (pairs.join(side("a"), F.col("a") == F.col("a_rep")).join(side("b"), F.col("b") == F.col("b_rep"))
            .filter(F.least("na", "nb") >= threshold * F.greatest("na", "nb")))
    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(least), "a long, b long")


def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# Exact Jaccard similarities and their transitive closure; for small tables.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT u, v FROM p JOIN n AS x ON x.doc_id = u JOIN n AS y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.u, e.v FROM reach AS r JOIN both_ways AS e ON r.v = e.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) AS c ON c.u = d.doc_id
"""
