"""Quality rules whose cutoffs hold a limit on false rejections (operator 11).

DataFrame functions alone: word statistics of whole texts, then per stratum and rule
the best cutoff among those that an exact binomial test allows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import cut, fresh, split_words, whole_text

# Fixed by the result contract.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
LEAST_WORDS = 50
MOST_REPEATED = 50      # percent of the words

ALPHA = 0.05   # good documents of a stratum that the rules together may reject, as a share
DELTA = 0.05   # chance that any stratum exceeds it
TOP = 1000     # rule values are whole numbers from 0 to TOP; higher is worse
SENT_STRATA = 10_000   # most strata whose cutoffs are sent to every task

RULES = {
    "symbols": "least({top}, 1000 * n_symbols div word_chars)",
    "lines": "1000 * n_dup_lines div n_lines",
    "repeats": "1000 * n_repeat_words div n_words",
    "lengths": "least({top}, abs(100 * word_chars div n_words - 500))",
}


def _windows(words: str) -> Column:
    """A hash of each three words in a row, in order."""
    w = F.col(words)
    h = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) > 2, F.slice(h, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))).otherwise(
        F.array().cast("array<bigint>"))


def _covered(order: str) -> Column:
    """Words inside windows whose hash stands beside an equal one in sorted ``order``."""
    g = F.col(order)
    twice = F.filter(g, lambda x, i: (x["h"] == F.get(g, i + 1)["h"]) | (x["h"] == F.get(g, i - 1)["h"]))
    at = F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    return F.coalesce(F.size(F.array_distinct(F.flatten(at))), F.lit(0))


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               stratum_col: str = "lang") -> DataFrame:
    """``id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words`` of every row.

    Repeated windows are found inside the row: window hashes (64 bits) are sorted with
    their places, only where one occurs twice.  Memory follows one text; nothing is
    shuffled.  Null text counts as empty.
    """
    text = whole_text(text_col)
    without = lambda chars: F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    a = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"),
                    split_words(text).alias("words"), lines.alias("lines"),
                    (F.char_length(text) - without(SPACES)).alias("word_chars"), without(SYMBOLS).alias("n_symbols"))
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    b = a.select("id", "stratum", F.size("words").alias("n_words"), "word_chars", "n_symbols",
                 F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                 _windows("words").alias("windows"))
    w = F.col("windows")
    c = b.select("id", "stratum", *counts, F.when(
        F.size(F.array_distinct(w)) < F.size(w),
        F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("order"))
    return c.select("id", "stratum", *[F.col(x).cast("long").alias(x) for x in counts],
                    F.when(F.col("order").isNotNull(), _covered("order")).otherwise(0).cast("long")
                    .alias("n_repeat_words"))


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def _values() -> list[Column]:
    """The rules' values; only rows that pass the base have words to divide by."""
    return [F.when(~F.col("base_failed"), F.expr(e.format(top=TOP))).alias(name) for name, e in RULES.items()]


def most_rejections(n: Column, alpha: float, delta: Column) -> Column:
    """The most rejections among ``n`` good rows that show, at level ``delta``, a
    rejection rate of at most ``alpha``: the largest k for which at most k of n
    happen with a chance of at most ``delta`` when the rate is ``alpha`` (the exact
    one-sided binomial test); -1 where not even none of n does."""
    odds, start = math.log(alpha / (1 - alpha)), n * math.log(1 - alpha)

    def step(s: Column, k: Column) -> Column:
        cdf = s["cdf"] + F.exp(s["log_term"])
        return F.struct((s["log_term"] + F.log((n - k) / (k + 1)) + odds).alias("log_term"), cdf.alias("cdf"),
                        F.when(cdf <= delta, k).otherwise(s["most"]).alias("most"))

    zero = F.struct(start.alias("log_term"), F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("most"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * alpha)), zero, step, lambda s: s["most"])


def calibrate(rows: DataFrame, rules: list[str], alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum of labelled ``rows`` (``stratum, good`` and one whole number
    from 0 to ``TOP`` per rule): ``c_stratum`` and for each rule the least value it
    rejects, null where it rejects nothing.

    Each rule may reject ``alpha / rules`` of a stratum's good rows, so all together
    reject at most ``alpha``.  Per stratum and rule the cutoffs are tested from the
    most lenient one on, which needs no correction inside the sequence; ``delta`` is
    shared by all strata and rules (Bonferroni).  So with a chance of ``1 - delta``
    every cutoff that passes is within its limit, in every stratum at once, and any
    of them may be taken: here the one that rejects most of the bad rows beyond its
    share of the good ones, the more lenient of equals, none if none gains.  A stratum
    with few good rows has no passing cutoff.

    Rows are reduced to histograms (at most ``TOP + 1`` values a stratum and rule).
    A null stratum is one of its own.  A null value is not counted.
    """
    sizes = cut(rows.groupBy("stratum").agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))
                .filter("n_good > 0"))
    level = F.lit(delta / max(1, sizes.count() * len(rules)))
    limits = sizes.select(F.col("stratum").alias("s"), "n_good", "n_bad",
                          most_rejections(F.col("n_good"), alpha / len(rules), level).alias("most"))
    bars = (rows.select("stratum", "good", F.explode(F.array(*[
                F.struct(F.lit(r).alias("rule"), F.col(r).cast("long").alias("value")) for r in rules])).alias("x"))
            .select("stratum", "good", "x.*").filter("value IS NOT NULL")
            .groupBy("stratum", "rule", "value")
            .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("value"))
    tested = (bars.withColumn("good", F.sum("good").over(above)).withColumn("bad", F.sum("bad").over(above))
              .join(limits, F.col("stratum").eqNullSafe(F.col("s")))
              .withColumn("gain", F.col("bad") * F.col("n_good") - F.col("good") * F.col("n_bad"))
              .filter("good <= most AND gain > 0"))
    best = lambda r: F.max(F.when(F.col("rule") == r, F.struct("gain", "value")))["value"]
    return tested.groupBy(F.col("stratum").alias("c_stratum")).agg(*[best(r).alias(f"c_{r}") for r in rules])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` with its statistics, ``base_failed``, ``failed_rules``
    (comma-joined) and ``kept``.

    Base: under 50 words, or over half of the words in three-word windows that the
    text repeats.  Rules (see ``RULES``) are judged on rows that pass it: symbols a
    word character, repeated lines, repeated words, and the distance of the mean word
    length from 5.  Their cutoffs come from :func:`calibrate` on the labelled rows,
    good being ``quality = 1``.

    ``labels`` (doc_id, quality): an id with several rows is good if one says so;
    null labels and null ids say nothing.  Rows that repeat an id and its statistics
    count once in the calibration.  A stratum without labels has no cutoffs, and its
    rows are kept if they pass the base.  Null text is empty.  No rows: no rows.
    Other columns are not read.
    """
    stats = cut(text_stats(docs, id_col, text_col, stratum_col).withColumn("base_failed", _base_failed())
                .select("*", *_values()))
    rules = list(RULES)
    marks = (labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"))
             .select(fresh("doc_id").alias("l_id"), "good"))
    labelled = (stats.filter(~F.col("base_failed")).select("id", "stratum", *rules)
                .join(marks, F.col("id") == F.col("l_id")).drop("l_id").distinct())
    cuts = cut(calibrate(labelled, rules, alpha, delta))
    cuts = F.broadcast(cuts) if cuts.count() <= SENT_STRATA else cuts
    found = F.concat_ws(",", *[F.when(F.col(r) >= F.col(f"c_{r}"), r) for r in rules])
    return (stats.join(cuts, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left")
            .withColumn("failed_rules", found)
            .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "failed_rules", (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept")))


def op11_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang AS stratum, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT row_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
x2 AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w[i], w[i + 1], w[i + 2]) AS c FROM x),
rep AS (SELECT row_id, count(DISTINCT i + k) AS n FROM x2, (SELECT unnest(range(3)) AS k) WHERE c > 1 GROUP BY row_id),
ln AS (SELECT row_id, unnest(string_split(t, chr(10))) AS line FROM d),
ld AS (SELECT row_id, count(*) AS n, count(DISTINCT line) AS nd FROM ln
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
s0 AS (
  SELECT d.row_id, doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(ld.n, 0)::BIGINT AS n_lines, coalesce(ld.n - ld.nd, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (row_id) LEFT JOIN ld USING (row_id)),
s1 AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s0),
s AS (
  SELECT *, CASE WHEN base_failed THEN NULL ELSE [
    {'rule': 'symbols', 'value': least(1000, 1000 * n_symbols // word_chars)},
    {'rule': 'lines', 'value': 1000 * n_dup_lines // n_lines},
    {'rule': 'repeats', 'value': 1000 * n_repeat_words // n_words},
    {'rule': 'lengths', 'value': least(1000, abs(100 * word_chars // n_words - 500))}] END AS vals FROM s1),
m AS (SELECT doc_id, bool_or(quality = 1) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
lab AS (SELECT DISTINCT doc_id, stratum, vals, good FROM s JOIN m USING (doc_id) WHERE NOT base_failed),
sizes AS (SELECT stratum, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad
          FROM lab GROUP BY stratum HAVING count(*) FILTER (good) > 0),
term AS (
  SELECT stratum, k, n_good * ln(0.9875) + coalesce(sum(ln((n_good - k + 1) / k) + ln(0.0125 / 0.9875)) FILTER (k > 0)
    OVER (PARTITION BY stratum ORDER BY k), 0) AS log_term
  FROM (SELECT stratum, n_good, unnest(range(0, floor(n_good * 0.0125)::BIGINT + 1)) AS k FROM sizes)),
cdf AS (SELECT stratum, k, sum(exp(greatest(log_term, -700))) OVER (PARTITION BY stratum ORDER BY k) AS c FROM term),
lim AS (SELECT stratum, max(k) AS most FROM cdf
        WHERE c <= 0.05 / ((SELECT count(*) FROM sizes) * 4) GROUP BY stratum),
bars AS (
  SELECT stratum, v.rule AS rule, v.value AS value, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM (SELECT stratum, good, unnest(vals) AS v FROM lab) GROUP BY ALL),
above AS (
  SELECT stratum, rule, value, sum(good) OVER (PARTITION BY stratum, rule ORDER BY value DESC) AS good,
    sum(bad) OVER (PARTITION BY stratum, rule ORDER BY value DESC) AS bad FROM bars),
tested AS (
  SELECT a.stratum, a.rule, a.value, a.bad * z.n_good - a.good * z.n_bad AS gain
  FROM above a JOIN sizes z ON a.stratum IS NOT DISTINCT FROM z.stratum
  JOIN lim l ON a.stratum IS NOT DISTINCT FROM l.stratum WHERE a.good <= l.most),
cuts AS (
  SELECT stratum, rule, value FROM tested WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, value DESC) = 1),
failed AS (
  SELECT row_id, string_agg(c.rule, ',' ORDER BY list_position(['symbols', 'lines', 'repeats', 'lengths'], c.rule)) AS failed_rules
  FROM (SELECT row_id, stratum, unnest(vals) AS v FROM s) q
  JOIN cuts c ON q.stratum IS NOT DISTINCT FROM c.stratum AND q.v.rule = c.rule AND q.v.value >= c.value GROUP BY row_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(failed_rules, '') AS failed_rules, NOT base_failed AND failed_rules IS NULL AS kept
FROM s LEFT JOIN failed USING (row_id)
"""
