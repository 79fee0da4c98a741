"""How filters overlap: removals of every coalition, step counts of every order and
Shapley values by exact constrained least squares (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import lru_cache
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import cut, fresh, ship, split_words, whole_text

# Fixed by the result contract: the filters' letters, in the order of their mask bits.
LETTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _text_mask(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails."""
    words = split_words(text)
    n_words, upper = F.size(words), F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    fails = [n_words < 100,
             F.size(F.array_distinct(words)) * 100 < n_words * 80,
             upper * 100 > F.char_length(text) * 10,
             text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by language, the filters they fail
    (bit i: ``LETTERS[i]``) and their labels.

    E compares texts by their SHA-256 digest, so texts are not shuffled.  A document
    fails it unless it has the smallest id of its digest; the smallest id is a partial
    aggregation, and it is joined by id and digest, so a text with very many copies is
    no hot key.  Rows equal in id, language, digest and mask are counted before that.

    Null text is empty text; a null language and an empty one share part ``''``.  A
    null id is neither smaller nor larger than another: such a row passes E, makes no
    other row fail it and has no label.  Rows that repeat an id with the same text all
    pass E.  An id with several label rows is good (toxic) if one of them says so.
    No documents: no rows.  Other columns are not read.
    """
    text = whole_text("text")
    rows = (docs.select(F.col("doc_id").alias("id"), whole_text("lang").alias("part"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), _text_mask(text).alias("mask"))
            .groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    rows = cut(rows)
    named = rows.filter("id IS NOT NULL")
    firsts = (named.groupBy("digest").agg(F.min("id").alias("first"))
              .select(F.col("digest").alias("f_digest"), fresh("first").alias("first")))
    marks = (labels.groupBy("doc_id")
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
             .select(fresh("doc_id").alias("l_id"), "good", "toxic"))
    no = F.lit(False)
    seen = (named.join(firsts, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("f_digest")), "left")
            .withColumn("mask", F.col("mask") + F.when(F.col("first").isNull(), 16).otherwise(0))
            .join(marks, F.col("id") == F.col("l_id"), "left")
            .select("part", "mask", F.coalesce("good", no).alias("good"),
                    F.coalesce("toxic", no).alias("toxic"), "n"))
    nameless = rows.filter("id IS NULL").select("part", "mask", no.alias("good"), no.alias("toxic"), "n")
    return (seen.unionByName(nameless).groupBy("part", "mask", "good", "toxic")
            .agg(F.sum("n").alias("n")))


def coalitions(failed: DataFrame, n_filters: int) -> DataFrame:
    """``part, coalition, total, v, v_good, v_toxic``: for every set of filters (bits),
    the documents that at least one of them removes.  All sets, zeros included."""
    hit = F.when(F.col("mask").bitwiseAND(F.col("coalition")) != 0, F.col("n")).otherwise(0)
    return (failed.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
            .groupBy("part", "coalition")
            .agg(F.sum("n").alias("total"), F.sum(hit).alias("v"),
                 F.sum(F.when(F.col("good"), hit).otherwise(0)).alias("v_good"),
                 F.sum(F.when(F.col("toxic"), hit).otherwise(0)).alias("v_toxic")))


def _solve(rows: list[list[Fraction]], n: int) -> list[list[Fraction]]:
    """Gauss-Jordan elimination in rationals: the columns after the first ``n``."""
    for i in range(n):
        p = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[p] = rows[p], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                f = rows[r][i]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def _kernel(m: int, size: int) -> Fraction:
    return Fraction(m - 1, comb(m, size) * size * (m - size))


@lru_cache(maxsize=None)
def _inverse(m: int) -> list[list[Fraction]]:
    """Inverse of the normal equations of the kernel-weighted least squares with the
    efficiency constraint: ``[[Z'WZ, 1], [1', 0]]`` over all proper coalitions."""
    a = [[Fraction(0)] * (m + 1) for _ in range(m + 1)]
    for s in range(1, (1 << m) - 1):
        w = _kernel(m, s.bit_count())
        for i in range(m):
            for j in range(m):
                if s >> i & 1 and s >> j & 1:
                    a[i][j] += w
    for i in range(m):
        a[i][m] = a[m][i] = Fraction(1)
    unit = [[Fraction(int(i == j)) for j in range(m + 1)] for i in range(m + 1)]
    return _solve([r + u for r, u in zip(a, unit)], m + 1)


def shapley(v: Sequence[int], m: int) -> list[Fraction]:
    """Shapley values of the game ``v`` (one number for each coalition, as bits;
    ``v[0]`` is 0): the exact minimum of ``sum w(S) (v(S) - sum of S's values)^2``
    whose values sum to the grand coalition's."""
    b = [Fraction(0)] * m + [Fraction(int(v[-1]))]
    for s in range(1, (1 << m) - 1):
        w = _kernel(m, s.bit_count()) * int(v[s])
        for i in range(m):
            if s >> i & 1:
                b[i] += w
    return [sum(x * y for x, y in zip(row, b)) for row in _inverse(m)[:m]]


def _steps(part: str, total: int, v: list[int], good: list[int], toxic: list[int], letters: str) -> Iterator[tuple]:
    m, full = len(letters), (1 << len(letters)) - 1
    in_all = [int(x * factorial(m)) for x in shapley(v, m)]
    for order in permutations(range(m)):
        before, name = 0, "".join(letters[i] for i in order)
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = v[after] - v[before]
            yield (part, name, step, total - v[after], removed, v[1 << i] - removed,
                   v[full] - v[full ^ 1 << i], good[after] - good[before], toxic[after] - toxic[before], in_all[i])
            before = after


def audit(failed: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, filter_order, step`` and the counts of that step, for every part of
    ``failed`` (``part, mask, good, toxic, n``) and every order of the filters.

    All counts are differences of coalition removals: 2 ** m numbers a part, which are
    partial aggregations.  ``shapley`` is a filter's removals summed over all orders:
    m! times its Shapley value, from exact least squares in rationals.  A task holds
    one part's coalitions, never documents.  No rows: no rows.
    """
    ship(failed.sparkSession)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("coalition")
        v, good, toxic = ([int(x) for x in pdf[c]] for c in ("v", "v_good", "v_toxic"))
        rows = _steps(pdf["part"].iloc[0], int(pdf["total"].iloc[0]), v, good, toxic, letters)
        return pd.DataFrame(list(rows), columns=["part", "filter_order", "step", *COUNTS])

    return coalitions(failed, len(letters)).groupBy("part").applyInPandas(table, schema)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/labels.parquet")))


# Shapley here by its definition: removals summed over all orders.
OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
    (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > first_id, false)::INT AS mask
  FROM w LEFT JOIN l USING (doc_id) GROUP BY ALL),
c AS (
  SELECT part, s.c, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (mask & s.c <> 0), 0)::BIGINT AS v,
    coalesce(sum(n) FILTER (mask & s.c <> 0 AND good), 0)::BIGINT AS vg,
    coalesce(sum(n) FILTER (mask & s.c <> 0 AND toxic), 0)::BIGINT AS vt
  FROM f, (SELECT unnest(range(32))::INT AS c) s GROUP BY part, s.c),
i AS (SELECT unnest(range(5))::INT AS i),
p AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
k AS (
  SELECT list_aggregate(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), 'string_agg', '') AS filter_order,
    s.step::INT AS step, o[s.step] AS i,
    list_sum(list_transform(o[1:s.step], lambda x: 1 << x))::INT AS after_set
  FROM p, (SELECT unnest(range(1, 6)) AS step) s),
r AS (
  SELECT a.part, k.filter_order, k.step, k.i, a.total - a.v AS kept, a.v - b.v AS removed,
    o.v - (a.v - b.v) AS redundant, e.v - u.v AS unique_fails, a.vg - b.vg AS good_lost, a.vt - b.vt AS toxic_lost
  FROM k JOIN c a ON a.c = after_set JOIN c b ON b.part = a.part AND b.c = after_set - (1 << k.i)
  JOIN c o ON o.part = a.part AND o.c = (1 << k.i) JOIN c e ON e.part = a.part AND e.c = 31
  JOIN c u ON u.part = a.part AND u.c = 31 - (1 << k.i))
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, i)::BIGINT AS shapley
FROM r
"""
