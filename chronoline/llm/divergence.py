"""How the sources of a language differ in their terms (operator 12): terms counted in
length buckets of packed words, then exact integer divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import cut, fresh, ship, whole_text

# Fixed by the result contract.
LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

PIECE = 1 << 22        # bytes of text that are packed and sorted at once
BLOCK_TERMS = 4096     # terms of one divergence block, about
TILE_SOURCES = 128     # sources of one side of a divergence block

# Bytes of a term: letters of ASCII and everything above ASCII.
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# --- counting terms: numpy over the bytes of many documents -------------------

def radix_order(words: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """The stable order of uint64 ``words``, on top of the order ``first``: four
    passes over 16 bits, lowest first; passes where all digits agree are left out."""
    order = np.arange(len(words)) if first is None else first
    for shift in range(0, 64, 16):
        digit = ((words >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]  # a radix sort for 16 bits
    return order


def _pack(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as one big-endian word, filled up with zeros."""
    words = np.zeros(len(starts), dtype=np.uint64)
    for i in range(8):
        byte = np.where(i < lengths, data[np.minimum(starts + i, len(data) - 1)], 0)
        words = (words << np.uint64(8)) | byte.astype(np.uint64)
    return words


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Terms of one long bucket as fixed-width byte strings."""
    at = np.arange(width)
    block = np.where(at < lengths[:, None], data[np.minimum(starts[:, None] + at, len(data) - 1)], 0)
    return np.ascontiguousarray(block.astype(np.uint8)).view(f"S{width}").ravel()


def _runs(changed: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], changed))) if len(changed) else np.zeros(1, dtype=np.int64)


def _count(order: np.ndarray, differs: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple:
    """Runs of equal (term, group) in sorted ``order``: the first place of each run,
    its length and its number of documents.  ``differs`` marks a new term."""
    g, d = group[order], doc[order]
    new = differs | (g[1:] != g[:-1])
    at = _runs(new)
    new_doc = np.concatenate(([True], new | (d[1:] != d[:-1]))).astype(np.int64)
    return order[at], np.diff(np.append(at, len(order))), np.add.reduceat(new_doc, at)


def count_terms(data: np.ndarray, group: np.ndarray, doc: np.ndarray, starts: np.ndarray,
                lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(width, places, counts, documents)``, by length bucket, of all equal (term, group).

    ``doc`` and ``group`` belong to each term, in rising order.  Terms of at most 8
    and of at most 16 bytes become one and two uint64 words, which a stable radix sort
    orders; equal words lie in runs, inside them groups and documents in their order.
    Longer terms are sorted as bytes, one bucket for each power of two.
    """
    buckets = np.where(lengths <= 8, 8, np.where(lengths <= 16, 16, 0))
    long = np.flatnonzero(buckets == 0)
    if len(long):
        buckets[long] = 1 << np.ceil(np.log2(lengths[long])).astype(np.int64)
    for width in np.unique(buckets):
        at = np.flatnonzero(buckets == width)
        s, n = starts[at], lengths[at]
        if width <= 16:
            high = _pack(data, s, n)
            if width == 8:
                order = radix_order(high)
                keys = high[order]
                differs = keys[1:] != keys[:-1]
            else:
                low = _pack(data, s + 8, n - 8)
                order = radix_order(high, radix_order(low))
                hi, lo = high[order], low[order]
                differs = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        else:
            keys = _matrix(data, s, n, int(width))
            order = np.argsort(keys, kind="stable")
            differs = keys[order[1:]] != keys[order[:-1]]
        places, counts, docs = _count(order, differs, group[at], doc[at])
        yield int(width), at[places], counts, docs


def _terms(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of all terms; ``data`` begins and ends outside a term."""
    edges = np.diff(_IN_TERM[data].astype(np.int8))
    starts = np.flatnonzero(edges == 1) + 1
    return starts, np.flatnonzero(edges == -1) + 1 - starts


def _pieces(sizes: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``piece`` bytes; a longer row is a range of its own."""
    at, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and held + n > piece:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and _IN_TERM[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _binary(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes at each start as an Arrow column, gathered at once."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


def _counts_of(texts: list[bytes], group_of: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """``group, term, count, documents`` columns of the texts of one piece, which come in
    the order of their groups; one set for each length bucket."""
    data = _LOWER[np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", dtype=np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, lengths = _terms(data)
    doc = np.searchsorted(ends, starts - 1, side="right")
    group = group_of[doc]
    for _, places, counts, docs in count_terms(data, group, doc, starts, lengths):
        yield group[places], _binary(data, starts[places], lengths[places]), counts, docs


def _long_counts(text: bytes, size: int) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The same of one long text, counted in parts; each term is in one document."""
    sums: dict[bytes, int] = {}
    for part in _parts(text, size):
        for _, terms, counts, _ in _counts_of([part], np.zeros(1, dtype=np.int64)):
            for t, n in zip(terms.to_pylist(), counts.tolist()):
                sums[t] = sums.get(t, 0) + n
    return (np.zeros(len(sums), np.int64), pa.array(list(sums), pa.binary()),
            np.array(list(sums.values()), np.int64), np.ones(len(sums), np.int64))


def _piece_rows(lang: pa.Array, source: pa.Array, text: pa.Array, size: int) -> Iterator[pa.RecordBatch]:
    """The counted terms of one piece as rows."""
    group, names = pd.MultiIndex.from_arrays([lang.to_pandas(), source.to_pandas()]).factorize()
    order = np.argsort(group, kind="stable")   # documents in the order of their groups
    texts = text.to_pylist()
    named = [pa.array([x[c] for x in names], pa.string()) for c in range(2)]
    if len(texts) == 1 and len(texts[0]) > size:
        found = [_long_counts(texts[0], size)]
    else:
        found = _counts_of([texts[i] for i in order], group[order])
    for g, terms, counts, docs in found:
        yield pa.RecordBatch.from_arrays(
            [*(x.take(pa.array(g)) for x in named), terms, pa.array(counts, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of every term and documents that
    hold it, by language and source (``docs``: lang, source, text; null as ``''``).

    A term is a maximal run of ASCII letters, lower-cased, and characters above ASCII.
    Texts stay where they are read: each Arrow batch is counted in pieces of ``piece`` bytes and
    only counts are shuffled.  A longer text is counted in parts; its distinct terms
    are then held in memory.  A term of any length is whole.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in _pieces(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False), piece):
                yield from _piece_rows(*[b.column(c).slice(i, j - i) for c in range(3)], piece)

    rows = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"),
                       whole_text("text").cast("binary").alias("text"))
    found = rows.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- divergences --------------------------------------------------------------

def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, piece: int = PIECE) -> DataFrame:
    """``lang, source, term, n`` of the terms in at least ``least_docs`` documents of
    their language, written once."""
    all_docs = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return cut(term_counts(docs, piece).withColumn("all_docs", all_docs).filter(F.col("all_docs") >= least_docs)
               .select("lang", "source", "term", "n"))


def _share(count: str, n: str, v: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (n + 2 v))`` in exact decimals; null without terms."""
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(20,0)) * {SCALE}) div CAST(nullif({n} + 2 * {v}, 0) AS DECIMAL(20,0))")


def _difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (language, source) of ``docs``: ``g_lang, g_source, n_group, n_lang,
    v`` (0 without kept terms) and ``sid``, the source's place in its language."""
    named = docs.select(whole_text("lang").alias("g_lang"), whole_text("source").alias("g_source")).distinct()
    by_group = (kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
                .select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), "n_group"))
    sums = (kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count("*").alias("v"))
            .withColumnRenamed("lang", "v_lang"))
    place = F.row_number().over(Window.partitionBy("g_lang").orderBy("g_source")) - 1
    return cut(named.join(by_group, (F.col("g_lang") == F.col("k_lang")) & (F.col("g_source") == F.col("k_source")), "left")
               .join(sums, F.col("g_lang") == F.col("v_lang"), "left")
               .select("g_lang", "g_source", place.alias("sid"),
                       *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_group", "n_lang", "v")]))


def _top_terms(kept: DataFrame, group: DataFrame, top: int) -> DataFrame:
    in_lang = (kept.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"))
               .select(F.col("lang").alias("t_lang"), F.col("term").alias("t_term"), "in_lang"))
    rows = (kept.join(in_lang, (F.col("lang") == F.col("t_lang")) & (F.col("term") == F.col("t_term")))
            .join(group, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
            .withColumn("p", _share("n", "n_group", "v")).withColumn("q", _share("in_lang", "n_lang", "v"))
            .filter("p > q").withColumn("value", _difference("p", "q")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return (rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                    "value", "rank"))


def _tile_sums(pdf: pd.DataFrame, tile: int) -> pd.DataFrame:
    """Sums of one block: all its terms, the sources of tile ``a`` by those of ``b``.
    Rows without a term say each source's share where a term does not occur."""
    lang, a, b = pdf["lang"].iloc[0], pdf["a"].iloc[0], pdf["b"].iloc[0]
    base = pdf[pdf["term"].isna()].sort_values("sid")
    sid = base["sid"].to_numpy()
    seen = pdf[pdf["term"].notna()]
    at, terms = pd.factorize(seen["term"])
    p = np.repeat(base["p"].to_numpy(dtype=np.int64)[:, None], len(terms), axis=1)
    p[np.searchsorted(sid, seen["sid"].to_numpy()), at] = seen["p"].to_numpy(dtype=np.int64)
    out = []
    for i in np.flatnonzero(sid // tile == a):
        js = np.flatnonzero((sid // tile == b) & (sid > sid[i]))
        for j in js:
            d = p[i] - p[j]
            out.append((lang, int(sid[i]), int(sid[j]), int((d * d // (p[i] + p[j])).sum()), len(terms)))
    return pd.DataFrame(out, columns=["lang", "i", "j", "value", "terms"])


def _pairs(kept: DataFrame, group: DataFrame, tile: int, block: int) -> DataFrame:
    """All pairs of sources of a language: sums over blocks of terms, a tile of sources
    by another at a time, so that a task holds a bounded matrix however many there are.
    A count is sent once for each tile of its language.  ``terms`` is the number of
    terms in the sum: those that a source of one of the two tiles has."""
    g = group.filter("v > 0").withColumn("tiles", F.max("sid").over(Window.partitionBy("g_lang")).cast("long"))
    g = g.withColumn("tiles", F.floor(F.col("tiles") / tile) + 1)
    blocks = F.ceil(F.col("v") / block)
    seen = (kept.join(g, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
            .select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "term", "sid", "tiles",
                    _share("n", "n_group", "v").alias("p")))
    absent = (g.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
              .select(F.col("g_lang").alias("lang"), "block", F.lit(None).cast("binary").alias("term"), "sid", "tiles",
                      _share("0", "n_group", "v").alias("p")))
    own, other = F.floor(F.col("sid") / tile), F.col("other")
    rows = (seen.unionByName(absent)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .select("lang", "block", F.least(own, other).alias("a"), F.greatest(own, other).alias("b"), "term", "sid", "p"))
    sums = (rows.groupBy("lang", "block", "a", "b").applyInPandas(lambda pdf: _tile_sums(pdf, tile), "lang string, i int, j int, value long, terms long")
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    return sums


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, piece: int = PIECE,
               tile: int = TILE_SOURCES, block: int = BLOCK_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of each language, its
    divergence from every other one (part ``pair``) and its ``top`` terms above the
    language's share (part ``term``).

    Shares are smoothed integers, ``1 + floor(10^9 (count + 2) / (N + 2 V))`` over the V
    terms in at least ``least_docs`` documents of the language; a value is the sum of
    ``floor((p - q)^2 / (p + q))``.  All arithmetic is on integers.

    Null language, source and text count as ``''``; each row is a document, repeated
    rows and ids included.  A group without terms still has pairs; a language without
    kept terms has pairs of value 0.  Ties go by the bytes of the item.  No rows: no
    rows.  Other columns are not read.
    """
    kept = kept_counts(docs, least_docs, piece)
    group = groups(docs, kept)
    sums = _pairs(kept, group, tile, block).withColumnRenamed("lang", "s_lang")
    left = group.select(F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), F.col("sid").alias("l"), "v",
                        _share("0", "n_group", "v").alias("p0"))
    right = group.select(F.col("g_lang").alias("r_lang"), F.col("g_source").alias("item"), F.col("sid").alias("r"),
                         _share("0", "n_group", "v").alias("q0"))
    # The report itself: each source beside each other one of its language.
    pairs = (left.join(right, (F.col("lang") == F.col("r_lang")) & (F.col("l") != F.col("r")))
             .join(sums, (F.col("lang") == F.col("s_lang")) & (F.least("l", "r") == F.col("i"))
                   & (F.greatest("l", "r") == F.col("j")), "left")
             .withColumn("neither", (F.col("v") - F.col("terms")) * _difference("p0", "q0"))
             .withColumn("value", F.coalesce(F.col("value") + F.col("neither"), F.lit(0).cast("long"))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (pairs.withColumn("rank", F.row_number().over(order))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))
    return pairs.unionByName(_top_terms(kept, group, top))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT row_id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n_lang FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(any_value(v.v), 0) AS v, coalesce(any_value(v.n_lang), 0) AS n_lang,
    coalesce(any_value(s.n_group), 0) AS n_group
  FROM d LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n_group FROM c GROUP BY ALL) s
    USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n_group + 2 * g.v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (kept.n + 2)) // (g.n_lang + 2 * g.v))::BIGINT AS q
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
term AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM term),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
