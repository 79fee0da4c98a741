"""Line-protocol text <-> long points, as Spark Column expressions.

A long point row is::

    measurement STRING, tags MAP<STRING,STRING>, field STRING,
    value_double DOUBLE, value_long BIGINT, value_bool BOOLEAN, value_string STRING,
    time_ns BIGINT, series_key STRING

``series_key`` is the canonical, escaped line prefix ``measurement[,k=v...]`` with
the tags sorted by key; it is the key of every grouping and join (Spark cannot
join, sort or window-partition on a MAP).

Encoding has two modes:

* ``compat`` -- the reference's record rendering: ``m[,k=v...] f=v ts``, no
  escaping, no quoting, no type suffix, a null value printed as ``null``,
  numbers printed the way the JVM prints them.  Tags are sorted by key.
* ``safe`` -- text that decodes back to the same points: names escaped, strings
  quoted, ``i`` suffix on integers, null values left out.

Decoding is regex work on the JVM (possessive quantifiers, so a 400 KB line does
not overflow the stack) followed by one ``explode`` of the field set.  Lines that
do not decode are not dropped silently: :func:`bad_lines` returns them with a
reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from chronoline.functions.nanos import checked_multiply

POINT_COLUMNS = [
    "measurement", "tags", "field",
    "value_double", "value_long", "value_bool", "value_string",
    "time_ns", "series_key",
]
VALUE_COLUMNS = ["value_double", "value_long", "value_bool", "value_string"]

# Line-protocol grammar (measurement, tag/field key, field value).
_NAME = r"(?:[^,= \\]++|\\.)++"
_MEAS = r"(?:[^, \\]++|\\.)++"
_FVAL = r"(?:\"(?:[^\"\\]++|\\.)*+\"|[^,\" ]++)"
LINE_RE = (r"(?s)^(" + _MEAS + r")((?:," + _NAME + "=" + _NAME + r")*+) ("
           + _NAME + "=" + _FVAL + r"(?:," + _NAME + "=" + _FVAL + r")*+)(?: (-?\d+))?\z")
# Strict field value: quoted string, integer, unsigned, boolean, float (longest
# spellings first: the repeated field group is atomic).
_FVAL_STRICT = (r"(?:\"(?:[^\"\\]++|\\.)*+\"|[+-]?\d++i|\d++u"
                r"|true|True|TRUE|t|T|false|False|FALSE|f|F"
                r"|[+-]?(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+)")
LINE_RE_STRICT = (r"(?s)^(" + _MEAS + r")((?:," + _NAME + "=" + _NAME + r")*+) ("
                  + _NAME + "=" + _FVAL_STRICT + r"(?:," + _NAME + "=" + _FVAL_STRICT
                  + r")*+)(?: (-?\d+))?\z")
_TAG_PAIR_RE = r"(?s),(" + _NAME + ")=(" + _NAME + ")"
_FIELD_PAIR_RE = r"(?s)(?:^|,)(" + _NAME + ")=(" + _FVAL + ")"
_LONG_RE = r"^[+-]?\d+i$"
_ULONG_RE = r"^\d+u$"
_FLOAT_RE = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"

# Characters escaped with a backslash, per element.
#   measurement: comma, space, backslash
#   tag key, tag value, field key: comma, equals sign, space, backslash
#   string field value: double quote, backslash
_ESC_MEAS = r"([, \\])"
_ESC_NAME = r"([,= \\])"
_ESC_STR = r"([\"\\])"
_UNESC_NAME = r"(?s)\\([,= \\])"
_UNESC_STR = r"(?s)\\([\"\\])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- escaping


def _any_of(c: Column, chars: str) -> Column:
    cond = F.lit(False)
    for ch in chars:
        cond = cond | c.contains(ch)
    return cond


def _escape(c, chars: str, pattern: str) -> Column:
    # Plain substring tests first (codegen, no regex); the regex only runs on
    # the rare text that holds a character to escape.
    c = _col(c)
    return F.when(_any_of(c, chars), F.regexp_replace(c, pattern, r"\\$1")).otherwise(c)


def escape_measurement(c) -> Column:
    return _escape(c, ", \\", _ESC_MEAS)


def escape_name(c) -> Column:
    """Escape a tag key, tag value or field key."""
    return _escape(c, ",= \\", _ESC_NAME)


def escape_string_value(c) -> Column:
    return _escape(c, '"\\', _ESC_STR)


def unescape_name(c) -> Column:
    return F.regexp_replace(_col(c), _UNESC_NAME, "$1")


def unescape_string_value(c) -> Column:
    return F.regexp_replace(_col(c), _UNESC_STR, "$1")


# --------------------------------------------------------------------------- series keys


def series_key_from_columns(measurement, tags: dict) -> Column:
    """Canonical series key from a measurement and ``{tag name: Column}``.

    The tag names are known on the driver, so they are sorted here and the key is
    one flat ``concat_ws`` (codegen, no higher-order function).  Null tag values
    are left out, as a line cannot carry an empty tag.
    """
    m = F.lit(measurement) if isinstance(measurement, str) else measurement
    parts = [escape_measurement(m)]
    for name in sorted(tags):
        v = _col(tags[name]).cast("string")
        parts.append(F.when(v.isNotNull(),
                            F.concat(F.lit("," + _escape_name_text(name) + "="), escape_name(v))))
    return F.concat_ws("", *parts)


def _escape_name_text(name: str) -> str:
    out = []
    for ch in name:
        if ch in ", =\\":
            out.append("\\")
        out.append(ch)
    return "".join(out)


def series_key_from_map(measurement, tags) -> Column:
    """Canonical series key from a measurement column and a tags MAP column."""
    entries = F.array_sort(F.map_entries(_col(tags)))
    tag_text = F.array_join(
        F.transform(entries, lambda e: F.concat(F.lit(","), escape_name(e["key"]), F.lit("="),
                                                 escape_name(e["value"]))), "")
    return F.concat(escape_measurement(measurement), F.coalesce(tag_text, F.lit("")))


# --------------------------------------------------------------------------- encode


def _value_text_compat() -> Column:
    b = F.when(F.col("value_bool"), F.lit("true")).when(~F.col("value_bool"), F.lit("false"))
    return F.coalesce(F.col("value_double").cast("string"), F.col("value_long").cast("string"),
                      b, F.col("value_string"), F.lit("null"))


def _value_text_safe() -> Column:
    d = F.col("value_double")
    finite = d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    return (F.when(finite, d.cast("string"))
            .when(F.col("value_long").isNotNull(),
                  F.concat(F.col("value_long").cast("string"), F.lit("i")))
            .when(F.col("value_bool"), F.lit("true"))
            .when(~F.col("value_bool"), F.lit("false"))
            .when(F.col("value_string").isNotNull(),
                  F.concat(F.lit('"'), escape_string_value("value_string"), F.lit('"'))))


def line_column(mode: str = "safe") -> Column:
    """The line text of one long point row (one field per line).

    ``safe`` gives null for a point whose value is null (or NaN/infinite), as such
    a point has no line; ``compat`` always gives a line.
    """
    if mode == "compat":
        return F.concat(series_key_from_map_compat(), F.lit(" "),
                        F.col("field"), F.lit("="), _value_text_compat(), F.lit(" "),
                        F.col("time_ns").cast("string"))
    if mode == "safe":
        return F.concat(F.col("series_key"), F.lit(" "), escape_name("field"), F.lit("="),
                        _value_text_safe(), F.lit(" "), F.col("time_ns").cast("string"))
    raise ValueError(f"unknown encode mode {mode!r}; use 'safe' or 'compat'")


def encode_lines(points: DataFrame, mode: str = "safe", keep: list[str] | None = None) -> DataFrame:
    """Long points -> ``value STRING`` line rows (plus ``keep`` columns).

    A narrow projection: no shuffle, runs where the points are.
    """
    keep = list(keep or [])
    if mode == "safe":
        # A point has a line iff it has a value (and a key and a time); testing the
        # inputs keeps the line from being built twice by a pushed-down filter.
        d = F.col("value_double")
        has_value = ((d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))))
                     | F.col("value_long").isNotNull() | F.col("value_bool").isNotNull()
                     | F.col("value_string").isNotNull())
        points = points.where(has_value & F.col("series_key").isNotNull()
                              & F.col("field").isNotNull() & F.col("time_ns").isNotNull())
    return points.select(line_column(mode).alias("value"), *keep)


def bad_points(points: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Points that have no safe line, with a reason: ``no key``, ``no time``, ``not a
    finite number`` or ``no value``; what :func:`encode_lines` leaves out."""
    d = F.col("value_double")
    other = (F.col("value_long").isNotNull() | F.col("value_bool").isNotNull()
             | F.col("value_string").isNotNull())
    finite = ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    reason = (F.when(F.col("series_key").isNull() | F.col("field").isNull(), F.lit("no key"))
              .when(F.col("time_ns").isNull(), F.lit("no time"))
              .when(d.isNotNull() & ~finite & ~other, F.lit("not a finite number"))
              .when(d.isNull() & ~other, F.lit("no value")))
    return points.select(*POINT_COLUMNS, *(keep or []), reason.alias("reason")).where(F.col("reason").isNotNull())


def encode_wide_lines(points: DataFrame, mode: str = "safe", order: list | None = None) -> DataFrame:
    """Long points -> one line per point (series, time) carrying all its fields.

    Two aggregations: first one value per (series, time, field) -- the latest by
    ``order`` (write-order columns) or, without it, the largest text -- with
    partial aggregation, so a key written many times collapses map-side; then
    the fields of each point are gathered, a list bounded by the number of
    distinct field names, never by how often a key was written.
    """
    if mode == "safe":
        pair = F.concat(escape_name("field"), F.lit("="), _value_text_safe())
    else:
        pair = F.concat(F.col("field"), F.lit("="), _value_text_compat())
    prefix = F.col("series_key") if mode == "safe" else series_key_from_map_compat()
    cols = [prefix.alias("_prefix"), "time_ns", "field", pair.alias("_pair")]
    ordering = None
    if order:
        ordering = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                              for i, c in enumerate(order)])
        cols.append(ordering.alias("_ord"))
    base = points.select(*cols).where(F.col("_pair").isNotNull())
    one = F.max_by("_pair", "_ord") if ordering is not None else F.max("_pair")
    per_field = base.groupBy("_prefix", "time_ns", "field").agg(one.alias("_pair"))
    grouped = (per_field.groupBy("_prefix", "time_ns")
               .agg(F.array_join(F.array_sort(F.collect_list("_pair")), ",").alias("_fields")))
    return grouped.select(F.concat_ws(" ", "_prefix", "_fields", F.col("time_ns").cast("string"))
                          .alias("value"))


def series_key_from_map_compat() -> Column:
    """``measurement[,k=v...]`` unescaped, tags sorted by key.  A canonical series
    key without a backslash has nothing escaped, so it is already that text; the
    lambda over the tags map only runs for keys that hold escapes."""
    entries = F.array_sort(F.map_entries(F.col("tags")))
    tag_text = F.array_join(
        F.transform(entries, lambda e: F.concat(F.lit(","), e["key"], F.lit("="), e["value"])), "")
    rebuilt = F.concat(F.col("measurement"), F.coalesce(tag_text, F.lit("")))
    if_plain = F.col("series_key").isNotNull() & ~F.col("series_key").contains("\\")
    return F.when(if_plain, F.col("series_key")).otherwise(rebuilt)


# --------------------------------------------------------------------------- decode


def _text_of(df: DataFrame, column: str) -> Column:
    """The line text column; exactly ``column`` (case-sensitive), String or Binary."""
    names = [f.name for f in df.schema.fields]
    # Fixed texts, as callers match on them.
    if column not in names:
        raise ValueError(f"Required attribute '{column}' not found")
    dtype = df.schema[column].dataType
    if isinstance(dtype, BinaryType):
        return F.col(column).cast("string")
    if isinstance(dtype, StringType):
        return F.col(column)
    raise ValueError(f"{column} attribute unsupported type {dtype.simpleString()}. "
                     f"{column} must be a(n) string or binary")


# Boolean spellings of line protocol.
_TRUE_WORDS = ["t", "T", "true", "True", "TRUE"]
_FALSE_WORDS = ["f", "F", "false", "False", "FALSE"]
# Sentinel that joins the four parts of a matched line into one string; a line
# that already holds it takes the exact (slower) per-group path instead.
_SEP = "\uffff"


def _value_kind(v: Column, compat: bool) -> Column:
    """Type code of a raw field value: ``s`` quoted string, ``l`` integer, ``t``/``f``
    boolean, ``d`` float, ``x`` anything else (a string in compat mode).

    In strict mode the line regex has already checked the value's grammar, so
    the first and last characters decide without any regex."""
    first = F.substring(v, 1, 1)
    last = F.substring(v, -1, 1)
    if not compat:
        return (F.when(first == '"', F.lit("s"))
                .when(last.isin("i", "u"), F.lit("l"))
                .when(v.isin(*_TRUE_WORDS), F.lit("t"))
                .when(v.isin(*_FALSE_WORDS), F.lit("f"))
                .otherwise(F.lit("d")))
    int_text = F.substring(v, F.lit(1), F.length(v) - 1)
    int_ok = ((last == "i") & v.rlike(_LONG_RE)) | ((last == "u") & v.rlike(_ULONG_RE))
    return (F.when((first == '"') & (last == '"') & (F.length(v) >= 2), F.lit("s"))
            .when(int_ok & int_text.try_cast("bigint").isNotNull(), F.lit("l"))
            .when(v.isin(*_TRUE_WORDS), F.lit("t"))
            .when(v.isin(*_FALSE_WORDS), F.lit("f"))
            .when(v.rlike(_FLOAT_RE), F.lit("d"))
            .otherwise(F.lit("x")))


def _without_line_end(line: Column) -> Column:
    """The line without one trailing CR LF, LF or CR."""
    cut = F.when(line.endswith("\r\n"), 2).when(line.endswith("\n") | line.endswith("\r"), 1).otherwise(0)
    return F.when(cut == 0, line).otherwise(F.substring(line, F.lit(1), F.length(line) - cut))


def _unescaped(arr: str, has_bs: Column) -> Column:
    """Unescape every name of an array column, skipped for lines without a backslash."""
    return F.when(has_bs, F.transform(arr, unescape_name)).otherwise(F.col(arr))


def parse_lines(df: DataFrame, column: str = "value", default_time_ns=None,
                compat: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Split each line into its parts and a ``_reason`` (null for a good line).

    Output columns: ``_line, _m, _tk, _tv, _fk, _fv, _key, _time, _reason`` plus
    ``keep``.  Narrow: no shuffle.  Per line, one full-line regex pass (its four
    groups joined by a sentinel and split) that also checks every value's type,
    then short passes over the tag and field sets.  Higher-order functions only
    run for the rare lines that need them (backslash escapes, unsorted tags,
    19-digit integers).  ``default_time_ns`` (int or Column) is the time of lines
    without one; by default the query's ``current_timestamp()``, which Spark
    fixes once per query (per micro-batch in a stream).
    """
    keep = list(keep or [])
    line = _text_of(df, column)
    if default_time_ns is None:
        default_time = checked_multiply(F.unix_micros(F.current_timestamp()), 1000)
    elif isinstance(default_time_ns, Column):
        default_time = default_time_ns.cast("bigint")
    else:
        default_time = F.lit(int(default_time_ns)).cast("bigint")
    line_re = LINE_RE if compat else LINE_RE_STRICT
    base = df.select(_without_line_end(line).alias("_line"), *keep)
    joined = F.regexp_replace("_line", line_re, f"$1{_SEP}$2{_SEP}$3{_SEP}$4")
    s1 = base.select("_line", *keep,
                     F.when(F.col("_line").contains(_SEP), F.lit(None).cast("array<string>"))
                     .otherwise(F.split(joined, _SEP)).alias("_parts"))
    slow = F.col("_parts").isNull()

    def group(i: int) -> Column:
        return F.when(slow, F.regexp_extract("_line", line_re, i)).otherwise(
            F.coalesce(F.get(F.col("_parts"), i - 1), F.lit("")))

    s2 = s1.select(
        "_line", *keep,
        F.when(slow, F.col("_line").rlike(line_re)).otherwise(F.size("_parts") == 4).alias("_ok"),
        group(1).alias("_mr"), group(2).alias("_tags"), group(3).alias("_fields"),
        group(4).alias("_t"),
        F.col("_line").contains("\\").alias("_bs"))
    s3 = s2.select(
        "_line", *keep, "_ok", "_mr", "_tags", "_fields", "_t", "_bs",
        F.regexp_extract_all("_tags", F.lit(_TAG_PAIR_RE), 1).alias("_tkr"),
        F.regexp_extract_all("_tags", F.lit(_TAG_PAIR_RE), 2).alias("_tvr"),
        F.regexp_extract_all("_fields", F.lit(_FIELD_PAIR_RE), 1).alias("_fkr"),
        F.regexp_extract_all("_fields", F.lit(_FIELD_PAIR_RE), 2).alias("_fv"))
    # The line's own text is the canonical series key when its tags are sorted
    # and nothing is escaped (the common case); otherwise it is rebuilt.
    fast_key = F.when(~F.col("_bs") & (F.col("_tkr") == F.sort_array("_tkr")),
                      F.concat("_mr", "_tags"))
    s4 = s3.select(
        "_line", *keep, "_ok", "_t", "_fv", "_fields",
        F.when(F.col("_bs"), unescape_name("_mr")).otherwise(F.col("_mr")).alias("_m"),
        _unescaped("_tkr", F.col("_bs")).alias("_tk"),
        _unescaped("_tvr", F.col("_bs")).alias("_tv"),
        _unescaped("_fkr", F.col("_bs")).alias("_fk"),
        fast_key.alias("_key"))
    time_val = F.when(F.col("_t") == "", default_time).otherwise(F.col("_t").try_cast("bigint"))
    if compat:
        not_ok = F.lit("syntax")
        big_int_bad = F.lit(False)
    else:
        not_ok = F.when(F.col("_line").rlike(LINE_RE), F.lit("bad value")).otherwise(F.lit("syntax"))
        # A number too large for a double would come back as infinity, which has no line.
        infinite = F.col("_fields").rlike(r"[eE]\+?\d{3}|\d{300}") & F.exists(
            "_fv", lambda v: ~v.startswith('"') & (F.abs(v.try_cast("double")) == F.lit(float("inf"))))
        big_int_bad = infinite | F.col("_fields").rlike(r"\d{19}") & F.exists(
            "_fv", lambda v: F.substring(v, -1, 1).isin("i", "u")
            & F.substring(v, F.lit(1), F.length(v) - 1).try_cast("bigint").isNull())
    reason = (F.when(F.col("_line").isNull(), F.lit("null"))
              .when(F.trim(F.col("_line")) == "", F.lit("empty"))
              .when(F.col("_line").startswith("#"), F.lit("comment"))
              .when(~F.col("_ok"), not_ok)
              .when(F.size(F.array_distinct("_tk")) < F.size("_tk"), F.lit("duplicate tag key"))
              .when(F.size(F.array_distinct("_fk")) < F.size("_fk"), F.lit("duplicate field key"))
              .when(big_int_bad, F.lit("bad value"))
              .when((F.col("_t") != "") & F.col("_t").try_cast("bigint").isNull(),
                    F.lit("time out of range")))
    return s4.select("_line", *keep, "_m", "_tk", "_tv", "_fk", "_fv", "_key",
                     time_val.alias("_time"), reason.alias("_reason"))


def points_from_parsed(parsed: DataFrame, keep: list[str] | None = None,
                       compat: bool = False) -> DataFrame:
    """Good rows of :func:`parse_lines` -> long points (one row per field).

    Every point column is an output of the ``explode`` (line-level values are
    repeated into the exploded struct), so a later filter on them -- a time
    range, a measurement -- stays above the generator instead of being pushed
    below it and re-running the whole parse.  Bad lines are dropped by
    exploding a null array, for the same reason."""
    keep = list(keep or [])
    slow_key = F.concat(
        escape_measurement("_m"),
        F.array_join(F.transform(
            F.sort_array(F.arrays_zip(F.col("_tk").alias("k"), F.col("_tv").alias("v"))),
            lambda e: F.concat(F.lit(","), escape_name(e["k"]), F.lit("="),
                               escape_name(e["v"]))), ""))
    n = F.size("_fk")
    zipped = F.arrays_zip(
        F.col("_fk").alias("field"), F.col("_fv").alias("raw"),
        F.array_repeat(F.col("_m"), n).alias("measurement"),
        F.array_repeat(F.map_from_arrays("_tk", "_tv"), n).alias("tags"),
        F.array_repeat(F.coalesce(F.col("_key"), slow_key), n).alias("series_key"),
        F.array_repeat(F.col("_time"), n).alias("time_ns"))
    exploded = parsed.select(
        *keep, F.explode(F.when(F.col("_reason").isNull(), zipped)).alias("_f"))
    typed = exploded.select(
        F.col("_f.measurement").alias("measurement"), F.col("_f.tags").alias("tags"),
        F.col("_f.field").alias("field"), F.col("_f.raw").alias("_raw"),
        F.col("_f.time_ns").alias("time_ns"), F.col("_f.series_key").alias("series_key"), *keep)
    typed = typed.select("*", _value_kind(F.col("_raw"), compat).alias("_kind"))
    return typed.select(
        "measurement", "tags", "field", *_typed_values_from(F.col("_raw"), F.col("_kind")),
        "time_ns", "series_key", *keep)


def _typed_values_from(raw: Column, kind: Column) -> list[Column]:
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    v_double = F.when(kind == "d", raw.try_cast("double"))
    v_long = F.when(kind == "l", F.substring(raw, F.lit(1), F.length(raw) - 1).try_cast("bigint"))
    v_bool = F.when(kind == "t", F.lit(True)).when(kind == "f", F.lit(False))
    v_str = F.when(kind == "s", F.when(raw.contains("\\"), unescape_string_value(inner))
                   .otherwise(inner)).when(kind == "x", raw)
    return [v_double.alias("value_double"), v_long.alias("value_long"),
            v_bool.alias("value_bool"), v_str.alias("value_string")]


def decode_lines(df: DataFrame, column: str = "value", default_time_ns=None,
                 compat: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Line rows -> long points; lines that do not decode are left out (see
    :func:`bad_lines`).  Narrow plan: regex projections and one explode."""
    parsed = parse_lines(df, column, default_time_ns, compat, keep)
    return points_from_parsed(parsed, keep, compat)


def bad_lines(df: DataFrame, column: str = "value", compat: bool = False,
              keep: list[str] | None = None) -> DataFrame:
    """Lines that do not decode, with a reason: null, empty, comment, syntax,
    duplicate tag key, duplicate field key, bad value, time out of range."""
    keep = list(keep or [])
    parsed = parse_lines(df, column, F.lit(0), compat, keep)
    rec = F.struct(F.col("_line").alias("value"), F.col("_reason").alias("reason"),
                   *[F.col(k) for k in keep])
    return (parsed.select(F.explode(F.when(F.col("_reason").isNotNull(), F.array(rec))).alias("_b"))
            .select("_b.*"))
