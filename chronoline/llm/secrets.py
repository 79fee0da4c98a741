"""Secret scan: fixed patterns and a randomness test battery (operator 6), in
DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import cut, whole_text

# Fixed by the result contract, in its order: kind, pattern, group whose length
# counts (of the pattern; 0: all of it) and its least length.
BASE = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# Runs that drop their failing matches whole are searched by the length at once.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

RANDOM = "random"      # kind of the spans that the battery adds
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
LEAST_BITS = 100       # least length of a tested string, as bits of its encoding
FALSE_RATE = 0.05      # rate of the false-discovery control
SENT_SPANS = 1_000_000  # most spans of a redaction that are sent to every task
STEPS = 8              # histogram steps of a p value, for each halving

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest on: name, alphabet, form; a letter and a digit at
# least, and both cases where the alphabet has both.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    ("hex_upper", _DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    ("base32", _UP + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    ("lower36", _DIGITS + _LOW, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    ("upper36", _DIGITS + _UP, r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    ("base62", _UP + _LOW + _DIGITS, r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$"),
    ("base64", _UP + _LOW + _DIGITS + "+/", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$"),
    ("base64url", _UP + _LOW + _DIGITS + "-_", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$"),
)

# For redaction: one more encoding, and the parts of a run that are tested beside it
# (between all separators, between '/' and '+', between '-' and '_').  Strings of
# letters alone, and lower case cut by '-' and '_', stay untested: the battery cannot
# tell 20 to 40 characters of them from words.
WIDER = (*ENCODINGS, ("upper36dash", _DIGITS + _UP + "-", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z-]+$"))
PARTS = (r"[A-Za-z0-9]{20,}", r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9+/]{20,}={0,2}")


def _hits(text: Column, pattern: str, group: int = 0) -> tuple[Column, Column, Column]:
    """Of each match, in order: the length up to its end from the end of the one
    before, its text and its group's text.  Empty arrays without a match."""
    # \\G: each match begins where the last one ended, so the rest is searched once.
    lazy = lambda inner: F.lit(rf"(?s)\G.*?{inner}")
    all_of = lambda p, i: F.when(text.rlike(pattern), F.regexp_extract_all(text, lazy(p), F.lit(i))).otherwise(
        F.array().cast("array<string>"))
    spans = F.transform(all_of(f"({pattern})", 0), F.char_length)
    hits = all_of(f"({pattern})", 1)
    return spans, hits, (all_of(f"(?:{pattern})", group) if group else hits)


def _base_hits(text: Column, k: int) -> Column:
    kind, pattern, group, least = BASE[k]
    upto, hits, judged = _hits(text, LONG_ENOUGH.get(kind, pattern), group)
    zipped = F.arrays_zip(upto.alias("a"), hits.alias("b"), judged.alias("c"))
    return F.transform(zipped, lambda x: F.struct(
        F.lit(k).alias("kind"), x["a"].alias("upto"), F.char_length(x["b"]).alias("long"),
        (F.char_length(x["c"]) >= least).alias("ok"), F.lit(None).cast("string").alias("token")))


def _found(text: Column) -> Column:
    """Array of (kind, upto, long, ok, token) over all kinds; kind is a number."""
    parts = [_base_hits(text, k) for k in range(len(BASE))]
    upto, hits, _ = _hits(text, CANDIDATE)
    parts.append(F.transform(F.arrays_zip(upto.alias("a"), hits.alias("b")), lambda x: F.struct(
        F.lit(len(BASE)).alias("kind"), x["a"].alias("upto"), F.char_length(x["b"]).alias("long"),
        F.lit(True).alias("ok"), x["b"].alias("token"))))
    return F.concat(*parts)


def _two_sided(z: Column) -> Column:
    """The normal p value of |z| by a logistic form (absolute error below 2e-4
    in the middle; far out it only has to be small, and above 0)."""
    a = F.least(F.abs(z), F.lit(20.0))
    return F.lit(2.0) / (1 + F.exp(1.5976 * a + 0.070566 * a * a * a))


def _with_parts(hits: DataFrame) -> DataFrame:
    """``hits`` and, as rows with ``part`` true, the parts (:data:`PARTS`) of the
    candidate runs that are not the whole run."""
    runs = hits.filter((F.col("kind") == len(BASE)) & F.col("token").rlike("[+/_-]"))
    run = Window.partitionBy("row", "from", "sort").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    found = []
    for sort, pattern in enumerate(PARTS):
        upto, got, _ = _hits(F.col("token"), pattern)
        found.append(F.transform(F.arrays_zip(F.array_repeat(F.lit(sort), F.size(upto)).alias("s"), upto.alias("a"), got.alias("b")),
                                 lambda x: F.struct(x["s"].alias("sort"), x["a"].alias("upto"), x["b"].alias("part"))))
    parts = (runs.select("row", "kind", F.col("start").alias("from"), F.col("stop").alias("to"), F.posexplode(F.concat(*found)).alias("nth", "x"))
             .select("row", "kind", "from", "to", "nth", "x.*")
             .withColumn("stop", F.col("from") + F.sum("upto").over(run))
             .withColumn("start", F.col("stop") - F.char_length("part"))
             .filter((F.col("start") > F.col("from")) | (F.col("stop") < F.col("to"))))
    # One part can be found by several patterns.
    parts = parts.select("row", "kind", "start", "stop", F.col("part").alias("token"), F.lit(True).alias("part")).distinct()
    return hits.withColumn("part", F.lit(False)).unionByName(parts)


def test_battery(tokens: DataFrame, col: str = "token", wide: bool = False) -> DataFrame:
    """``tokens`` with ``encoding``, ``stratum`` and ``p``, the combined p value of
    the hypothesis that the token is random in its encoding; null where no
    encoding fits or the token is too short to tell.  ``wide`` takes the
    encodings of :data:`WIDER`.

    Three tests: chi-squared of the symbol counts against uniform, with its exact
    mean and variance; runs above and below the middle of the alphabet; serial
    correlation at lag one.  Combined by Bonferroni.  A stratum is an encoding and
    a doubling of length.
    """
    body = F.regexp_replace(F.col(col), "=+$", "")
    name = alphabet = F.lit(None).cast("string")
    for enc, chars, form in reversed(WIDER if wide else ENCODINGS):
        name = F.when(F.col("_body").rlike(form), enc).otherwise(name)
        alphabet = F.when(F.col("_body").rlike(form), chars).otherwise(alphabet)
    t = (tokens.withColumn("_body", body).withColumn("encoding", name).withColumn("_alpha", alphabet)
         .withColumn("_a", F.char_length("_alpha").cast("double"))
         .withColumn("_n", F.char_length("_body").cast("double"))
         .withColumn("_use", F.coalesce(F.col("_n") * F.log2("_a") >= LEAST_BITS, F.lit(False)))
         .withColumn("_c", F.when(F.col("_use"), F.split("_body", "")))
         .withColumn("_v", F.expr("transform(_c, c -> cast(instr(_alpha, c) - 1 as double))"))
         .withColumn("_next", F.expr("slice(_v, 2, size(_v))"))
         .withColumn("_sq", F.expr("aggregate(array_distinct(_c), 0D, (s, c) -> "
                                   "s + pow(_n - char_length(replace(_body, c, '')), 2))"))
         .withColumn("_sum", F.expr("aggregate(_v, 0D, (s, x) -> s + x)"))
         .withColumn("_ss", F.expr("aggregate(_v, 0D, (s, x) -> s + x * x)"))
         .withColumn("_lag", F.expr("aggregate(zip_with(slice(_v, 1, size(_v) - 1), _next, (x, y) -> x * y), 0D, (s, x) -> s + x)"))
         .withColumn("_hi", F.expr("aggregate(_v, 0D, (s, x) -> s + if(2 * x >= _a, 1, 0))"))
         .withColumn("_runs", F.expr("1 + aggregate(zip_with(slice(_v, 1, size(_v) - 1), _next, "
                                     "(x, y) -> if((2 * x >= _a) <> (2 * y >= _a), 1D, 0D)), 0D, (s, x) -> s + x)")))
    n, a = F.col("_n"), F.col("_a")
    chi = ((a / n) * F.col("_sq") - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    both = 2 * F.col("_hi") * (n - F.col("_hi"))
    spread = both * (both - n) / (n * n * (n - 1))
    runs = F.when(spread > 0, (F.col("_runs") - 1 - both / n) / F.sqrt(spread)).otherwise(30.0)
    mean = F.col("_sum") / n
    var = F.col("_ss") - n * mean * mean
    first, last = F.expr("element_at(_v, 1)"), F.expr("element_at(_v, -1)")
    lagged = F.col("_lag") - mean * (2 * F.col("_sum") - first - last) + (n - 1) * mean * mean
    serial = F.when(var > 0, (lagged / var + 1 / n) * F.sqrt(n)).otherwise(30.0)
    p = F.least(F.lit(1.0), 3 * F.least(_two_sided(chi), _two_sided(runs), _two_sided(serial)))
    drop = [c for c in t.columns if c.startswith("_")]
    return (t.withColumn("p", F.when(F.col("_use"), p))
            .withColumn("stratum", F.when(F.col("_use"), F.concat_ws("/", "encoding", F.floor(F.log2("_n")).cast("string"))))
            .drop(*drop))


def not_random(tokens: DataFrame) -> DataFrame:
    """``f_stratum, f_step``: in each stratum, the histogram step of p up to which
    Benjamini-Hochberg rejects randomness (steps count halvings of p, so larger
    steps are smaller p).  Distinct tokens count once each."""
    step = F.floor(-F.log2(F.col("p")) * STEPS).cast("int")
    bars = (tokens.filter(F.col("p").isNotNull()).groupBy("token", "stratum", step.alias("step")).agg(F.lit(1).alias("one"))
            .groupBy("stratum", "step").agg(F.count("*").alias("n")))
    down = Window.partitionBy("stratum").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (bars.withColumn("upto", F.sum("n").over(down))
            .withColumn("m", F.sum("n").over(Window.partitionBy("stratum")))
            .filter(F.pow(F.lit(2.0), -F.col("step") / STEPS) <= FALSE_RATE * F.col("upto") / F.col("m"))
            .groupBy(F.col("stratum").alias("f_stratum")).agg(F.min("step").alias("f_step")))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False,
               wide: bool = False) -> DataFrame:
    """``row, id, kind, start, stop`` for every secret, and one row with null kind
    for each document without; ``row`` tells rows with the same id apart, and
    ``h``, if asked for, is the text's 64-bit hash.

    Spans count code points.  Kinds are those of :data:`BASE`, leftmost and without
    overlap within a kind, then ``random``: strings of 20 and more letters, digits
    and ``+/_-`` that overlap no base span and that the battery does not reject as
    random.  Rejection is controlled for false discoveries in each stratum of
    encoding and length, over the distinct strings of all documents, so many short
    strings do not loosen the test of the long ones, nor do copies.

    With ``wide``, the encodings are :data:`WIDER` and the parts of a run between its
    separators are tested too, in strata of their own: the spans are those without
    ``wide`` and more, which may overlap.

    Null text counts as empty, and has no spans; repeated rows repeat; no rows give
    none.  Lengths go through one running sum for each document.
    """
    text = whole_text(text_col)
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                           F.xxhash64(text).alias("h"), _found(text).alias("found")))
    run = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    hits = (rows.select("row", F.posexplode("found").alias("nth", "x")).select("row", "nth", "x.*")
            .withColumn("stop", F.sum("upto").over(run)).filter("ok")
            .select("row", "kind", (F.col("stop") - F.col("long")).alias("start"), "stop", "token"))
    if wide:
        hits = _with_parts(cut(hits))
    is_base = F.col("kind") < len(BASE)
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(is_base, F.col("stop"))).over(by_start)
    after = F.min(F.when(is_base, F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    hits = hits.withColumn("_b", before).withColumn("_a", after).filter(
        is_base | ~(F.coalesce(F.col("_b") > F.col("start"), F.lit(False))
                    | F.coalesce(F.col("_a") < F.col("stop"), F.lit(False)))).drop("_a", "_b")
    hits = test_battery(hits, wide=wide)
    if wide:
        hits = hits.withColumn("stratum", F.when(F.col("part"), F.concat(F.lit("part/"), "stratum")).otherwise(F.col("stratum")))
    hits = cut(hits)
    # One row for each stratum: an encoding (8, or 18 with parts) and a doubling of
    # length, 31 at most.
    judged = hits.join(F.broadcast(not_random(hits)), F.col("stratum") == F.col("f_stratum"), "left")
    rejected = F.coalesce(F.floor(-F.log2("p") * STEPS) >= F.col("f_step"), F.lit(False))
    spans = judged.filter((F.col("kind") < len(BASE)) | (F.col("p").isNotNull() & ~rejected))
    names = F.array(*[F.lit(k[0]) for k in BASE], F.lit(RANDOM))
    return (rows.select(F.col("row").alias("r"), "id", *["h"] * with_hash).join(spans, F.col("r") == F.col("row"), "left")
            .select(F.col("r").alias("row"), "id", *["h"] * with_hash, F.col("kind").alias("order"),
                    # A null index alone does not make element_at nullable to the optimizer.
                    F.when(F.col("kind").isNotNull(), F.element_at(names, F.col("kind") + 1)).alias("kind"),
                    "start", "stop"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_assign, n_access, n_hex, base_sha256,
    spans``; the spans of :func:`find_spans` as ``kind:start:stop``, by start and
    then kind, joined by commas (no spans: an empty string)."""
    found = find_spans(docs, id_col, text_col)
    span = F.struct("start", "order", F.concat_ws(":", "kind", "start", "stop").alias("say"))
    joined = lambda c: F.concat_ws(",", F.transform(F.array_sort(F.col(c)), lambda x: x["say"]))
    one = found.groupBy("row").agg(
        F.first("id").alias("id"),
        *[F.count(F.when(F.col("kind") == k[0], 1)).alias(f"n_{k[0]}") for k in BASE],
        F.collect_list(F.when(F.col("order") < len(BASE), span)).alias("base"),
        F.collect_list(F.when(F.col("order").isNotNull(), span)).alias("all"))
    return one.select(F.col("id").alias(id_col), *[f"n_{k[0]}" for k in BASE],
                      F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs``, all columns and rows, with every wide span of :func:`find_spans` in the
    text replaced by ``mark``; overlapping spans are replaced as one.  Texts without
    secrets, null ones too, stay as they are.  Spans come back by id and text hash;
    texts are shuffled only where there are more than ``SENT_SPANS`` spans."""
    found = (find_spans(docs, id_col, text_col, with_hash=True, wide=True).filter(F.col("kind").isNotNull())
             .groupBy("row", "id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
             .groupBy(F.col("id").alias("f_id"), F.col("h").alias("f_h")).agg(F.first("spans").alias("spans")))
    found = cut(found)
    if (found.agg(F.sum(F.size("spans"))).first()[0] or 0) <= SENT_SPANS:
        found = F.broadcast(found)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"), F.xxhash64(whole_text(text_col)).alias("h"))
    # Folds the sorted spans: what is written so far, and up to where.
    clean = F.expr(f"""aggregate(spans, named_struct('at', 0, 'out', ''),
        (s, x) -> if(x.start < s.at, named_struct('at', greatest(s.at, cast(x.stop as int)), 'out', s.out),
          named_struct('at', cast(x.stop as int),
                       'out', concat(s.out, substring(text, s.at + 1, cast(x.start as int) - s.at), '{mark}'))),
        s -> concat(s.out, substring(text, s.at + 1)))""")
    out = rows.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h")), "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(clean)
    return out.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_SQL_KEYS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_PATTERNS = {
    "assign": rf"""(?:{_SQL_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", RANDOM: "[A-Za-z0-9+/_-]+={0,2}"}


def _sql_hits(k: int, kind: str, group: int, least: int) -> str:
    p = _SQL_PATTERNS[kind]
    return (f"SELECT doc_id, {k} AS o, '{kind}' AS kind, unnest(regexp_extract_all(text, '(?s).*?{p}')) AS upto, "
            f"unnest(regexp_extract_all(text, '{p}')) AS hit, unnest(regexp_extract_all(text, '{p}', {group})) AS judged, "
            f"{least} AS least, unnest(range(len(regexp_extract_all(text, '{p}')))) AS nth FROM w")


_SQL_HITS = " UNION ALL ".join([*(_sql_hits(k, *[b[0], b[2], b[3]]) for k, b in enumerate(BASE)),
                                _sql_hits(len(BASE), RANDOM, 0, 20)])
_SQL_ENCODINGS = (
    ("hex", "[0-9a-f]+", "[0-9]", "[a-f]"), ("hex_upper", "[0-9A-F]+", "[0-9]", "[A-F]"),
    ("base32", "[A-Z2-7]+", "[2-7]", "[A-Z]"), ("lower36", "[0-9a-z]+", "[0-9]", "[a-z]"),
    ("upper36", "[0-9A-Z]+", "[0-9]", "[A-Z]"), ("base62", "[A-Za-z0-9]+", "[0-9]", "[a-z]", "[A-Z]"),
    ("base64", "[A-Za-z0-9+/]+", "[0-9]", "[a-z]", "[A-Z]"), ("base64url", "[A-Za-z0-9_-]+", "[0-9]", "[a-z]", "[A-Z]"))
_SQL_FORM = "CASE " + " ".join(
    f"WHEN regexp_full_match(body, '{form}') AND " + " AND ".join(f"regexp_matches(body, '{x}')" for x in needs) + f" THEN '{enc}'"
    for enc, form, *needs in _SQL_ENCODINGS) + " END"
_SQL_ALPHABET = "CASE enc " + " ".join(f"WHEN '{e}' THEN '{a}'" for e, a, _ in ENCODINGS) + " END"


def _sql_p(z: str) -> str:
    a = f"least(abs({z}), 20)"
    return f"2 / (1 + exp(1.5976 * {a} + 0.070566 * pow({a}, 3)))"


OP6_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS ({_SQL_HITS}),
spans AS (
  SELECT doc_id, o, kind, hit, judged, least, stop - length(hit) AS start, stop FROM (
    SELECT *, sum(length(upto)) OVER (PARTITION BY doc_id, o ORDER BY nth) AS stop FROM h)),
base AS (SELECT * FROM spans WHERE o < {len(BASE)} AND length(judged) >= least),
more AS (
  SELECT doc_id, o, kind, hit, start, stop, regexp_replace(hit, '=+$', '') AS body FROM spans AS s
  WHERE o = {len(BASE)} AND length(regexp_replace(hit, '=+$', '')) >= least AND NOT EXISTS (
    SELECT 1 FROM base AS b WHERE b.doc_id = s.doc_id AND b.start < s.stop AND b.stop > s.start)),
t1 AS (SELECT DISTINCT hit, body, {_SQL_FORM} AS enc, length(body)::DOUBLE AS n FROM more),
t2 AS (SELECT *, {_SQL_ALPHABET} AS alpha, string_split(body, '') AS c FROM t1 WHERE enc IS NOT NULL),
t3 AS (
  SELECT *, length(alpha)::DOUBLE AS a, [instr(alpha, x) - 1.0::DOUBLE FOR x IN c] AS v FROM t2
  WHERE n * log2(length(alpha)) >= {LEAST_BITS}),
t4 AS (
  SELECT *, list_sum([pow(n - length(replace(body, x, '')), 2) FOR x IN list_distinct(c)]) AS sq, list_sum(v) AS s1,
    list_sum([x * x FOR x IN v]) AS s2, list_sum([v[i] * v[i + 1] FOR i IN range(1, len(v))]) AS lag,
    list_sum([CASE WHEN 2 * x >= a THEN 1.0 ELSE 0.0 END FOR x IN v])::DOUBLE AS hi,
    1 + list_sum([CASE WHEN (2 * v[i] >= a) <> (2 * v[i + 1] >= a) THEN 1.0 ELSE 0.0 END FOR i IN range(1, len(v))])::DOUBLE AS runs
  FROM t3),
t5 AS (
  SELECT *, ((a / n) * sq - n - (a - 1)) / sqrt(2 * (a - 1) * (n - 1) / n) AS z1, 2 * hi * (n - hi) AS both_,
    s1 / n AS mean FROM t4),
t6 AS (
  SELECT *, CASE WHEN both_ * (both_ - n) > 0 THEN (runs - 1 - both_ / n) / sqrt(both_ * (both_ - n) / (n * n * (n - 1)))
      ELSE 30 END AS z2,
    CASE WHEN s2 - n * mean * mean > 0 THEN ((lag - mean * (2 * s1 - v[1] - v[-1]) + (n - 1) * mean * mean)
      / (s2 - n * mean * mean) + 1 / n) * sqrt(n) ELSE 30 END AS z3 FROM t5),
t7 AS (
  SELECT hit, enc || '/' || floor(log2(n))::INTEGER AS stratum,
    least(1, 3 * least({_sql_p("z1")}, {_sql_p("z2")}, {_sql_p("z3")})) AS p FROM t6),
t8 AS (SELECT *, floor(-log2(p) * {STEPS})::INTEGER AS step FROM t7),
bars AS (SELECT stratum, step, count(*) AS n FROM t8 GROUP BY stratum, step),
cuts AS (
  SELECT stratum, min(step) AS cut FROM (
    SELECT *, sum(n) OVER (PARTITION BY stratum ORDER BY step DESC) AS upto, sum(n) OVER (PARTITION BY stratum) AS m FROM bars)
  WHERE pow(2.0, -step / {float(STEPS)}) <= {FALSE_RATE} * upto / m GROUP BY stratum),
random AS (
  SELECT m.doc_id, m.o, m.kind, m.start, m.stop FROM more AS m JOIN t8 ON t8.hit = m.hit
  LEFT JOIN cuts AS c ON c.stratum = t8.stratum WHERE c.cut IS NULL OR t8.step < c.cut),
found AS (
  SELECT doc_id, o, kind, start, stop FROM base UNION ALL SELECT * FROM random),
said AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (WHERE o < {len(BASE)}) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
  FROM found GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM w LEFT JOIN said AS s ON s.doc_id = w.doc_id
"""
