"""Mixing sources to target weights by nested hash-threshold histograms (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import count_words, cut

# Fixed by the result contract: source weights by code point, and the repeat limit.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3

POINT_BITS = 60   # hash points are the first 15 hex digits of an md5
LEVEL_BITS = 10   # buckets of one histogram: 2 ** LEVEL_BITS
SENT_SOURCES = 10_000   # most sources whose cuts are sent to every task


def hash_point(key: Column) -> Column:
    """60 bits of ``md5(key)``; a null key counts as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15),
                  16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row a
    source).  All sizes are shared out by weight; a target above ``MAX_REPEATS``
    times its source's size stops there and the excess is shared again.

    Resharing stops the sources in order of ``limit / weight``, so running sums in
    that order say which stop.  The window has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(w) for w in WEIGHTS])
    s = (sizes.withColumn("at", F.row_number().over(by_name))
         .withColumn("w", F.element_at(weight, (F.pmod(F.col("at") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
         .withColumn("limit", F.col("source_size") * MAX_REPEATS))
    by_ratio = Window.orderBy(F.col("limit") / F.col("w"), "at")
    left = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    s = (s.withColumn("w_left", F.sum("w").over(left))
         .withColumn("t_left", F.sum("source_size").over(everything)
                     - F.coalesce(F.sum("limit").over(before), F.lit(0)))
         .withColumn("stops", F.col("limit") * F.col("w_left") < F.col("t_left") * F.col("w")))
    free = ~F.col("stops")
    t_free = F.max(F.when(free, F.col("t_left"))).over(everything)
    w_free = F.max(F.when(free, F.col("w_left"))).over(everything)
    return s.select("source", "source_size",
                    F.when(free, t_free.cast("double") * F.col("w") / w_free)
                    .otherwise(F.col("limit").cast("double")).alias("target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       count_words(F.col(text_col)).alias("size"), hash_point(F.col(id_col)).alias("point"))


def source_cuts(rows: DataFrame) -> DataFrame:
    """One row per source of ``rows`` (``source, size, point``): ``p_source,
    source_size, target, copies, threshold, shift, edge_in``.

    A source gives ``floor(target / size)`` whole copies, and of one more copy the
    documents whose hash point lies under the threshold.  Sizes are summed by source
    and hash bucket; the bucket where the running sum passes the budget is split
    into finer buckets, and only its rows are read again, until each boundary is one
    hash point.  That point is taken if it brings the sum nearer to the target.
    Nothing is sorted; every step is a partial aggregation, so a source with most of
    the rows is no hot task.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = cut(source_targets(sizes).withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("int"))
        .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("below", F.lit(0).cast("long"))    # sizes under the threshold so far
        .withColumn("prefix", F.lit(0).cast("long")))  # the boundary bucket, as leading bits
    for shift in range(POINT_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        plan, splits = _refine(rows, plan, shift)
        if not splits:
            break
    cuts = plan.select(F.col("source").alias("p_source"), "source_size", "target", "copies",
                       F.col("prefix").alias("threshold"), F.lit(shift).alias("shift"),
                       (F.col("budget") - F.col("below") >= F.col("below") + F.col("edge") - F.col("budget"))
                       .alias("edge_in"))
    # With more sources, an ordinary join by source.
    return F.broadcast(cuts) if plan.count() <= SENT_SOURCES else cuts


def _repeats() -> Column:
    """How often the mix takes a row with ``point``, given its source's cut."""
    bucket = F.expr("shiftright(point, shift)")
    more = (bucket < F.col("threshold")) | ((bucket == F.col("threshold")) & F.col("edge_in"))
    return F.col("copies") + F.when((F.col("copies") < MAX_REPEATS) & more, 1).otherwise(0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, source_size, target, taken``
    and ``repeats``, the number of times (0 to 3) that the mix takes the document;
    see :func:`source_cuts`.  ``size`` counts words.

    Null text has size 0, and a document of size 0 takes 0 words.  A null source
    is a source of its own, the last.  Rows that repeat a doc_id share one hash
    point: they are taken or left together.  No rows: no rows.
    """
    rows = cut(_keyed(docs, id_col, text_col, source_col))
    out = rows.join(source_cuts(rows), F.col("source").eqNullSafe(F.col("p_source")))
    return (out.withColumn("repeats", _repeats())
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    (F.col("size") * F.col("repeats")).alias("taken"), "repeats"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """The rows of the mix: each row of ``docs``, all its columns, as often as
    :func:`mix` takes it.  Texts are not shuffled while there are at most
    ``SENT_SOURCES`` sources."""
    cuts = source_cuts(cut(_keyed(docs, id_col, text_col, source_col)))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.col(source_col).cast("string").alias("source"), hash_point(F.col(id_col)).alias("point"))
    taken = rows.join(cuts, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("repeats", _repeats())
    return (taken.filter("repeats > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("nth")).select("row.*"))


def _refine(rows: DataFrame, plan: DataFrame, shift: int) -> tuple[DataFrame, bool]:
    """The boundary buckets of one level, and whether one has several hash points."""
    keys = plan.select(F.col("source").alias("p_source"), "prefix")
    inside = rows.join(keys, F.col("source").eqNullSafe(F.col("p_source"))
                       & (F.shiftright("point", shift + LEVEL_BITS) == F.col("prefix")))
    bars = (inside.groupBy("source", F.shiftright("point", shift).alias("bucket"))
            .agg(F.sum("size").alias("bar"), F.min("point").alias("lo"), F.max("point").alias("hi")))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    bars = (bars.withColumn("upto", F.sum("bar").over(run))
            .select(F.col("source").alias("b_source"), "bucket", "bar", "upto", "lo", "hi"))
    # The first bucket whose running sum passes the budget; the last one if none does.
    step = plan.join(bars, F.col("source").eqNullSafe(F.col("b_source")), "left")
    passed = F.col("below") + F.col("upto") > F.col("budget")
    pick = F.struct((~passed).alias("short"),
                    F.when(passed, F.col("bucket")).otherwise(-F.col("bucket")).alias("order"),
                    "bucket", "bar", (F.col("upto") - F.col("bar")).alias("under"), "lo", "hi")
    step = (step.groupBy("source", "source_size", "target", "copies", "budget", "below")
            .agg(F.min(pick).alias("p"))
            .select("source", "source_size", "target", "copies", "budget",
                    (F.col("below") + F.coalesce(F.col("p.under"), F.lit(0))).alias("below"),
                    F.col("p.bucket").alias("prefix"), F.coalesce(F.col("p.bar"), F.lit(0)).alias("edge"),
                    (F.col("p.lo") < F.col("p.hi")).alias("splits")))
    step = cut(step)
    return step, bool(step.filter("splits").limit(1).count())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The last point below the budget of one more copy, by running sums in hash order.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS point
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM s0),
s2 AS (SELECT *, (pos - 1) % 3 + 1 AS w, 3 * source_size AS lim FROM s1),
s3 AS (SELECT *, sum(w) OVER (ORDER BY lim::DOUBLE / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
         (SELECT sum(source_size) FROM s0) - coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / w, pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t_left FROM s2),
s4 AS (SELECT *, lim * w_left < t_left * w AS stops FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN stops THEN lim::DOUBLE
         ELSE (SELECT max(t_left) FROM s4 WHERE NOT stops)::DOUBLE * w
              / (SELECT max(w_left) FROM s4 WHERE NOT stops) END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM s5),
r AS (SELECT d.doc_id, d.size, s6.source_size, s6.target, s6.copies,
        s6.target - s6.copies * s6.source_size AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.point) AS upto,
        sum(d.size) OVER (PARTITION BY d.source, d.point) AS edge
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (copies + CASE WHEN copies < 3 AND (upto <= budget
     OR (upto - edge <= budget AND budget - (upto - edge) >= upto - budget)) THEN 1 ELSE 0 END))::BIGINT AS taken,
  (copies + CASE WHEN copies < 3 AND (upto <= budget
     OR (upto - edge <= budget AND budget - (upto - edge) >= upto - budget)) THEN 1 ELSE 0 END)::INTEGER AS repeats
FROM r
"""
