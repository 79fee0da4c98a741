"""Operators on long point DataFrames.

Every operator here is a declarative DataFrame plan: filters that Catalyst pushes
into the Parquet scan, and hash aggregations with map-side partial aggregation
(``min``, ``max``, ``count``, ``max_by``), so a hot series is combined inside each
task before the shuffle instead of landing whole on one reducer.  Nothing is
collected, and no window sorts a whole partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, TimestampNTZType,
                               TimestampType)

from chronoline.functions.codec import POINT_COLUMNS, VALUE_COLUMNS, series_key_from_columns
from chronoline.functions.nanos import ns_of

_INTEGRAL = (LongType, IntegerType, ShortType, ByteType)
_FRACTIONAL = (DoubleType, FloatType, DecimalType)


def _slot_of(dtype) -> str:
    if isinstance(dtype, BooleanType):
        return "value_bool"
    if isinstance(dtype, _INTEGRAL):
        return "value_long"
    if isinstance(dtype, _FRACTIONAL):
        return "value_double"
    if isinstance(dtype, StringType):
        return "value_string"
    raise TypeError(f"field type {dtype.simpleString()} is not a point value type")


def _typed(slot: str, value: Column) -> list[Column]:
    casts = {"value_double": "double", "value_long": "bigint",
             "value_bool": "boolean", "value_string": "string"}
    return [(value.cast(casts[s]) if s == slot else F.lit(None).cast(casts[s])).alias(s)
            for s in VALUE_COLUMNS]


def _source_time_bounds(time: str, dtype, start: int | None, stop: int | None) -> Column | None:
    """An exact predicate on the raw time column for ``[start, stop)`` in ns, so
    the range reaches the Parquet scan as a pushed filter (a filter on the
    derived ``time_ns`` cannot).  Microsecond columns: ``t*1000 >= start`` iff
    ``t >= ceil(start/1000)`` and ``t*1000 < stop`` iff ``t < ceil(stop/1000)``."""
    import datetime as _dt

    def lit(us: int) -> Column:
        wall = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)
        text = wall.strftime("%Y-%m-%d %H:%M:%S.%f")
        if isinstance(dtype, TimestampNTZType):
            return F.expr(f"TIMESTAMP_NTZ'{text}'")
        return F.expr(f"TIMESTAMP'{text}+00:00'")

    if not isinstance(dtype, (TimestampNTZType, TimestampType)):
        if isinstance(dtype, _INTEGRAL):
            cond = F.lit(True)
            if start is not None:
                cond = cond & (F.col(time) >= F.lit(int(start)))
            if stop is not None:
                cond = cond & (F.col(time) < F.lit(int(stop)))
            return cond
        return None
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(time) >= lit(-(-int(start) // 1000)))
    if stop is not None:
        cond = cond & (F.col(time) < lit(-(-int(stop) // 1000)))
    return cond


def to_points(df: DataFrame, measurement: str, tags: list[str], fields: list[str],
              time: str, keep: list[str] | None = None, start: int | None = None,
              stop: int | None = None) -> DataFrame:
    """A table -> long points: one row per (row, non-null field).

    ``tags`` are column names (values become strings, nulls are left out),
    ``fields`` column names whose Spark type picks the value slot, ``time`` a
    TIMESTAMP / TIMESTAMP_NTZ / DATE column or BIGINT nanoseconds.  Narrow plan:
    projection plus one ``explode`` when there is more than one field.
    ``start``/``stop`` keep ``[start, stop)`` ns only, filtered on the raw time
    column so that the bounds are pushed into the scan.
    """
    keep = list(keep or [])
    schema = {f.name: f.dataType for f in df.schema.fields}
    for c in [*tags, *fields, time, *keep]:
        if c not in schema:
            raise ValueError(f"column {c!r} not found in {sorted(schema)}")
    if not fields:
        raise ValueError("a point needs at least one field")
    if start is not None or stop is not None:
        pushed = _source_time_bounds(time, schema[time], start, stop)
        if pushed is not None:
            df = df.where(pushed)
    tag_cols = {t: F.col(t).cast("string") for t in tags}
    empty = F.create_map().cast("map<string,string>")
    # One small map per tag, concatenated: null tags drop out without a lambda.
    tags_map = (F.map_concat(*[F.when(tag_cols[t].isNotNull(), F.create_map(F.lit(t), tag_cols[t]))
                               .otherwise(empty) for t in sorted(tags)])
                if tags else empty)
    base = [F.lit(measurement).alias("measurement"), tags_map.alias("tags"),
            series_key_from_columns(measurement, tag_cols).alias("series_key"),
            ns_of(time, schema[time]).alias("time_ns"), *[F.col(k) for k in keep]]
    names = ["measurement", "tags", "series_key", "time_ns", *keep]
    if len(fields) == 1:
        f = fields[0]
        out = df.select(*base, F.lit(f).alias("field"), *_typed(_slot_of(schema[f]), F.col(f)))
        out = out.where(F.col(_slot_of(schema[f])).isNotNull())
    else:
        # Key, tags and time are projected once per row *before* the explode (a
        # generator's sibling expressions would otherwise run once per field).
        recs = F.array(*[F.struct(F.lit(f).alias("field"), *_typed(_slot_of(schema[f]), F.col(f)))
                         for f in fields])
        pre = df.select(*base, recs.alias("_recs"))
        out = (pre.select(*names, F.explode("_recs").alias("_r"))
               .select(*names, "_r.field", *[f"_r.{s}" for s in VALUE_COLUMNS])
               .where(F.col("value_double").isNotNull() | F.col("value_long").isNotNull()
                      | F.col("value_bool").isNotNull() | F.col("value_string").isNotNull()))
    out = out.select(*POINT_COLUMNS, *keep)
    if start is not None or stop is not None:
        out = in_range(out, None, start, stop)
    return out


# --------------------------------------------------------------------------- P1-P3


def in_range(points: DataFrame, measurement: str | None = None, start: int | None = None,
             stop: int | None = None) -> DataFrame:
    """Measurement equality and half-open ``[start, stop)`` time filter.

    ``start`` None is an open lower end (the reference's "from the beginning"),
    ``stop`` None an open upper end.  Plain predicates: on a store they reach the
    Parquet scan as partition filters (``measurement``, ``day``) and pushed
    filters (``time_ns``).
    """
    cond = F.lit(True)
    if measurement is not None:
        cond = cond & (F.col("measurement") == measurement)
    if start is not None:
        cond = cond & (F.col("time_ns") >= F.lit(int(start)).cast("bigint"))
    if stop is not None:
        cond = cond & (F.col("time_ns") < F.lit(int(stop)).cast("bigint"))
    return points.where(cond)


# --------------------------------------------------------------------------- A1-A3, G1


def first_last_time(points: DataFrame) -> DataFrame:
    """One row: ``first_ns`` = min time, ``last_ns`` = max time, ``n_records``.

    The true global extremes (the reference keeps the last result table only).
    Partial aggregation in every task, one tiny final stage.
    """
    return points.agg(F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"),
                      F.count(F.lit(1)).alias("n_records"))


def range_count(points: DataFrame, start: int | None = None, stop: int | None = None,
                by_series: bool = False) -> DataFrame:
    """Records (field values) and points (distinct series, time) in ``[start, stop)``.

    ``count(DISTINCT series_key, time_ns)`` is planned as two hash aggregations:
    duplicates are removed map-side before the shuffle.
    """
    sel = in_range(points, None, start, stop)
    aggs = [F.count(F.lit(1)).alias("n_records"),
            F.count_distinct("series_key", "time_ns").alias("n_points")]
    if by_series:
        return sel.groupBy("series_key").agg(*aggs)
    return sel.agg(*aggs)


def series_stats(points: DataFrame) -> DataFrame:
    """Per (series_key, field): records, first and last time (series listing)."""
    return points.groupBy("series_key", "field").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("time_ns").alias("first_ns"),
        F.max("time_ns").alias("last_ns"))


def series_cardinality(points: DataFrame) -> DataFrame:
    """Per measurement: distinct series and fields."""
    return points.groupBy("measurement").agg(
        F.count_distinct("series_key").alias("n_series"),
        F.count_distinct("field").alias("n_fields"))


# --------------------------------------------------------------------------- A4, U1


def _order_struct(order: list | None, reverse_time: bool = False) -> Column:
    t = F.bitwise_not(F.col("time_ns")) if reverse_time else F.col("time_ns")
    extra = [F.col(c) if isinstance(c, str) else c for c in (order or [])]
    return F.struct(t.alias("_t"), *[e.alias(f"_o{i}") for i, e in enumerate(extra)])


def first_last_records(points: DataFrame, order: list | None = None,
                       carry: list[str] | None = None) -> DataFrame:
    """Per (series_key, field): the first and the last record in time.

    One aggregation with ``max_by`` (partial aggregation map-side; no window,
    no sort of the input).  Among records at the same time the latest in write
    order wins -- ``order`` lists write-order columns, most significant first --
    matching upsert semantics.  ``bitwise_not(time_ns)`` reverses time for the
    first record without any overflow.  ``carry`` names the value columns to
    return (default: all four slots); with one column and no ``order`` both
    aggregation buffers are fixed-width, so Spark runs a hash aggregation.
    """
    carry = list(carry) if carry is not None else list(VALUE_COLUMNS)
    if len(carry) == 1 and not order:
        v = F.col(carry[0])
        agg = points.groupBy("series_key", "field").agg(
            F.min("time_ns").alias("first_ns"),
            F.max_by(v, F.bitwise_not(F.col("time_ns"))).alias(f"first_{carry[0]}"),
            F.max("time_ns").alias("last_ns"),
            F.max_by(v, F.col("time_ns")).alias(f"last_{carry[0]}"))
        return agg.select("series_key", "field", "first_ns", f"first_{carry[0]}", "last_ns",
                          f"last_{carry[0]}")
    payload = F.struct(*[F.col(s) for s in carry])
    first = F.max_by(payload, _order_struct(order, reverse_time=True))
    last = F.max_by(payload, _order_struct(order))
    agg = points.groupBy("series_key", "field").agg(
        F.min("time_ns").alias("first_ns"), first.alias("_first"),
        F.max("time_ns").alias("last_ns"), last.alias("_last"))
    return agg.select(
        "series_key", "field", "first_ns",
        *[F.col(f"_first.{s}").alias(f"first_{s}") for s in carry],
        "last_ns",
        *[F.col(f"_last.{s}").alias(f"last_{s}") for s in carry])


def upsert_latest(points: DataFrame, order: list, carry: list[str] | None = None) -> DataFrame:
    """Last write wins on (series_key, field, time_ns).

    ``order`` is the write order, most significant first (for the store:
    ``written_at, batch_id, seq``).  ``max_by`` in one aggregation keeps one row
    per key; its partial aggregation reduces a key written a million times
    inside each map task before the shuffle, so a hot key cannot sink one
    reducer.  ``carry`` names the columns taken from the winning row (default:
    measurement, tags and the four value slots); carrying fewer makes the
    shuffle narrower.
    """
    if not order:
        raise ValueError("upsert_latest needs the write-order columns")
    carry = list(carry) if carry is not None else ["measurement", "tags", *VALUE_COLUMNS]
    ordering = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                          for i, c in enumerate(order)])
    out = [c for c in POINT_COLUMNS if c in carry or c in ("series_key", "field", "time_ns")]
    keys = ("series_key", "field", "time_ns")
    if len(carry) == 1:
        # a bare column as the payload keeps the aggregation buffer narrower
        agg = points.groupBy(*keys).agg(F.max_by(F.col(carry[0]), ordering).alias(carry[0]))
        return agg.select(*out)
    payload = F.struct(*[F.col(c) for c in carry])
    agg = points.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_p"))
    return agg.select(*[F.col(f"_p.{c}").alias(c) if c in carry else F.col(c) for c in out])


def latest_rows(df: DataFrame, keys: list[str], values: list[str], order: list) -> DataFrame:
    """Last write wins on wide rows, before they become points: one row per ``keys``
    with the latest non-null of each of ``values`` by the write ``order``.

    The same points as :func:`upsert_latest` of the exploded rows, from one row per
    row instead of one per field.  Rows are first reduced to the latest for each
    pattern of nulls (one payload, partial aggregation map-side), of which a key has
    few; only these are compared field by field.
    """
    nulls = F.concat(*[F.col(v).isNull().cast("int").cast("string") for v in values])
    rank = [(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)]
    best = F.max(F.struct(F.struct(*rank).alias("_o"), F.struct(*values).alias("_v")))
    per = df.groupBy(*keys, nulls.alias("_n")).agg(best.alias("_w"))
    return per.groupBy(*keys).agg(*[
        F.max_by(F.col(f"_w._v.{v}"), F.when(F.col(f"_w._v.{v}").isNotNull(), F.col("_w._o"))).alias(v) for v in values])


# --------------------------------------------------------------------------- V1


def to_wide(points: DataFrame, fields: list[str] | dict | None = None,
            order: list | None = None) -> DataFrame:
    """Long -> wide: one row per (series_key, time_ns).

    ``fields`` given (list -> DOUBLE columns, dict -> {name: 'double'|'long'|
    'bool'|'string'}): one column per field, taken with ``max_by`` over the write
    ``order`` so that the upsert and the pivot are one hash aggregation (one
    shuffle, partial aggregation map-side).  Without ``order`` a duplicated key
    keeps the largest value.  ``fields`` None: a ``fields`` MAP<STRING, STRING>
    of text values (sorted entries), for unknown field sets.
    """
    if fields is None:
        # One value per (series, time, field) first (latest by ``order``, partial
        # aggregation map-side), so the per-point list is bounded by the number
        # of distinct field names, not by how often a key was written.
        text = F.coalesce(F.col("value_double").cast("string"), F.col("value_long").cast("string"),
                          F.col("value_bool").cast("string"), F.col("value_string"))
        if order:
            ordering = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                                  for i, c in enumerate(order)])
            one = F.max_by(text, ordering)
        else:
            one = F.max(text)
        per_field = points.groupBy("series_key", "time_ns", "field").agg(one.alias("_text"))
        return (per_field.groupBy("series_key", "time_ns")
                .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "_text"))))
                     .alias("fields")))
    kinds = fields if isinstance(fields, dict) else {f: "double" for f in fields}
    slot = {"double": (F.coalesce(F.col("value_double"), F.col("value_long").cast("double")), "double"),
            "long": (F.col("value_long"), "bigint"),
            "bool": (F.col("value_bool"), "boolean"),
            "string": (F.col("value_string"), "string")}
    ordering = (F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                           for i, c in enumerate(order)]) if order else None)
    aggs = []
    for name, kind in kinds.items():
        value, cast = slot[kind]
        mine = F.col("field") == name
        if ordering is not None:
            aggs.append(F.max_by(value, F.when(mine, ordering)).cast(cast).alias(name))
        else:
            aggs.append(F.max(F.when(mine, value)).cast(cast).alias(name))
    return points.groupBy("series_key", "time_ns").agg(*aggs)


def to_wide_variant(points: DataFrame, order: list | None = None) -> DataFrame:
    """Long -> wide for unknown fields with their types: ``series_key, time_ns, fields``,
    ``fields`` a VARIANT object of doubles, longs, booleans and strings (read with
    ``variant_get(fields, '$.name', 'double')``).

    As in :func:`to_wide`, one value for each (series, time, field) comes first: the latest
    by the write ``order``, else the largest (a double before a long, a boolean, a string),
    so the list of a point is bounded by the number of field names.  A point without a
    value is a JSON null."""
    value = F.struct(*VALUE_COLUMNS)
    one = F.max(value) if not order else F.max_by(value, F.struct(
        *[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)]))
    per_field = points.groupBy("series_key", "time_ns", "field").agg(one.alias("_v"))
    # A VARIANT does not sort: entries are ordered by field before the values are cast.
    entries = F.array_sort(F.collect_list(F.struct("field", "_v")))
    cast_entry = lambda e: F.struct(e["field"].alias("field"), F.coalesce(
        *[e["_v"][c].cast("variant") for c in VALUE_COLUMNS]).alias("value"))
    return per_field.groupBy("series_key", "time_ns").agg(
        F.to_variant_object(F.map_from_entries(F.transform(entries, cast_entry))).alias("fields"))
