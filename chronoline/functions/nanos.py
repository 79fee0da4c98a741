"""Nanosecond time as Spark Column expressions.

``time_ns BIGINT`` (nanoseconds since the Unix epoch, UTC) is the source of
truth everywhere in this package; Spark's TIMESTAMP only holds microseconds, so
timestamps are derived from it on demand and never the other way round inside
the store.  Every function here is a plain Column expression: it stays in the
JVM, inside whole-stage codegen, and never depends on the session time zone.

Integer rules: only BIGINT arithmetic (a DOUBLE cannot hold 1.7e18 exactly),
floor division via ``pmod`` so that instants before 1970 split correctly, and
overflow raises an error whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# Nanoseconds per unit.
NS_PER_UNIT = {
    "ns": 1,
    "us": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "min": 60_000_000_000,
    "h": 3_600_000_000_000,
    "d": 86_400_000_000_000,
}
# Accepted spellings of the units above.
UNIT_ALIASES = {
    "nanos": "ns", "nanoseconds": "ns", "nanosecond": "ns",
    "micros": "us", "microseconds": "us", "microsecond": "us",
    "millis": "ms", "milliseconds": "ms", "millisecond": "ms",
    "seconds": "s", "second": "s", "sec": "s",
    "minutes": "min", "minute": "min", "m": "min",
    "hours": "h", "hour": "h",
    "days": "d", "day": "d",
}

NS_PER_SECOND = NS_PER_UNIT["s"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("bigint")


def unit_factor(unit: str) -> int:
    """Nanoseconds in one ``unit`` (ns, us, ms, s, min, h, d and long names)."""
    key = unit.lower()
    key = UNIT_ALIASES.get(key, key)
    if key not in NS_PER_UNIT:
        raise ValueError(f"unknown time unit {unit!r}; use one of {sorted(NS_PER_UNIT)}")
    return NS_PER_UNIT[key]


def _overflow(what: str) -> Column:
    return F.raise_error(F.lit(f"BIGINT overflow in {what}"))


def checked_multiply(c, k, what: str = "nanosecond arithmetic") -> Column:
    """``c * k`` as BIGINT that raises on overflow (null stays null)."""
    c = _col(c)
    return F.when(c.isNull() | _lit(k).isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(F.try_multiply(c.cast("bigint"), _lit(k)), _overflow(what).cast("bigint"))
    )


def checked_add(a, b, what: str = "nanosecond arithmetic") -> Column:
    """``a + b`` as BIGINT that raises on overflow (null stays null)."""
    a, b = _col(a), _lit(b) if not isinstance(b, str) else F.col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(F.try_add(a.cast("bigint"), b.cast("bigint")), _overflow(what).cast("bigint"))
    )


def floor_div(c, k: int) -> Column:
    """Floor division of a BIGINT by a positive constant (right for negatives).

    ``c - pmod(c, k)`` is a multiple of ``k``, so integral ``div`` is exact.
    """
    c = _col(c).cast("bigint")
    kk = F.lit(k).cast("bigint")
    return F.call_function("div", c - F.pmod(c, kk), kk)


# --------------------------------------------------------------------------- conversions


def ns_from_timestamp(c) -> Column:
    """TIMESTAMP (instant) -> ns since epoch (microsecond precision)."""
    return checked_multiply(F.unix_micros(_col(c)), 1000, "ns_from_timestamp")


def ns_from_timestamp_ntz(c) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> ns since epoch: the time since the epoch
    as an interval, which Spark takes in no zone, in seconds and exact microseconds.
    Nothing is cast to TIMESTAMP, so the session zone and its missing and repeated
    hours play no part; and the column stands in it once, however often Spark copies
    the expression into filters and projections."""
    since = _col(c) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    us = since.cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)
    return checked_multiply(us.cast("bigint"), 1000, "ns_from_timestamp_ntz")


def ns_of(c, data_type: DataType) -> Column:
    """ns since epoch of a column whose Spark type is known (TIMESTAMP, TIMESTAMP_NTZ,
    DATE, or an integral number of ns)."""
    c = _col(c)
    if isinstance(data_type, TimestampNTZType):
        return ns_from_timestamp_ntz(c)
    if isinstance(data_type, TimestampType):
        return ns_from_timestamp(c)
    name = data_type.typeName()
    if name == "date":
        return checked_multiply(F.unix_date(c).cast("bigint"), NS_PER_UNIT["d"], "ns_of(date)")
    if name in ("long", "integer", "short", "byte"):
        return c.cast("bigint")
    raise TypeError(f"cannot take nanoseconds of a {data_type.simpleString()} column")


def ns_to_timestamp(c) -> Column:
    """ns -> TIMESTAMP, floored to the microsecond (right before 1970 too)."""
    return F.timestamp_micros(floor_div(c, 1000))


def ns_seconds(c) -> Column:
    """Epoch seconds of an ns instant (floor)."""
    return floor_div(c, NS_PER_SECOND)


def ns_nanos(c) -> Column:
    """Nano-of-second of an ns instant, always in [0, 1e9)."""
    return F.pmod(_col(c), F.lit(NS_PER_SECOND).cast("bigint"))


def ns_split(c) -> Column:
    """ns -> struct(seconds BIGINT, nanos BIGINT), e.g. 1679897616725154800 ->
    (1679897616, 725154800)."""
    return F.struct(ns_seconds(c).alias("seconds"), ns_nanos(c).alias("nanos"))


def ns_from_parts(seconds, nanos) -> Column:
    """Inverse of :func:`ns_split`."""
    return checked_add(checked_multiply(seconds, NS_PER_SECOND, "ns_from_parts"), _col(nanos))


def to_ns(c, unit: str) -> Column:
    """A count of ``unit`` -> ns, e.g. ``to_ns(ms, 'ms')`` is ``ms * 1_000_000``."""
    return checked_multiply(c, unit_factor(unit), f"to_ns({unit})")


def try_to_ns(c, unit: str) -> Column:
    """:func:`to_ns`, but null where BIGINT nanoseconds (1677 to 2262) cannot hold the
    count, for columns that are not times by their nature."""
    return F.try_multiply(_col(c).cast("bigint"), _lit(unit_factor(unit)))


def millis_to_ns(c) -> Column:
    return to_ns(c, "ms")


def seconds_to_ns(c) -> Column:
    return to_ns(c, "s")


def ns_add(c, delta, unit: str = "ms") -> Column:
    """Instant + ``delta`` ``unit``s (default milliseconds); delta may be a Column."""
    d = _col(delta) if isinstance(delta, (str, Column)) else F.lit(int(delta)).cast("bigint")
    return checked_add(c, checked_multiply(d, unit_factor(unit), "ns_add"), "ns_add")


# --------------------------------------------------------------------------- ISO-8601 text

# Accepted ISO-8601 instant shape (date, time, 0-9 fraction digits,
# 'Z' or a +hh:mm offset).
_ISO_RE = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?(Z|[+-]\d{2}:\d{2})$"


def ns_from_iso(c) -> Column:
    """ISO-8601 instant text with up to 9 fraction digits -> ns; junk -> null.

    A plain cast to TIMESTAMP would cut the fraction at microseconds; here the
    whole seconds are parsed with their offset (so the session zone does not
    matter) and the fraction is added as an integer.  One regex pass splits the
    text into (seconds, fraction, offset).
    """
    c = _col(c)
    sep = "\uffff"
    parts = F.split(F.regexp_replace(c, _ISO_RE, f"$1{sep}$2{sep}$3"), sep)
    ok = (F.size(parts) == 3) & ~c.contains(sep)
    base = F.get(parts, 0)
    frac = F.get(parts, 1)
    zone = F.get(parts, 2)
    ts = F.try_to_timestamp(F.concat(base, zone), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    nanos = F.when(frac == "", F.lit(0).cast("bigint")).otherwise(
        F.rpad(frac, 9, "0").cast("bigint"))
    return F.when(ok & ts.isNotNull(),
                  ns_from_parts(F.unix_seconds(ts), nanos)).otherwise(F.lit(None).cast("bigint"))


def ns_to_iso(c) -> Column:
    """ns -> ISO-8601 UTC text like ``2023-03-27T06:13:36.725154800Z``.

    The fraction is printed the way ``java.time.Instant`` prints it: none for a
    whole second, else 3, 6 or 9 digits, whichever is the shortest exact one.
    The text is made from the day number and the second of the day, in no zone.
    """
    nanos = ns_nanos(c)
    day = F.date_from_unix_date(floor_div(c, NS_PER_UNIT["d"]).cast("int"))
    of_day = F.pmod(ns_seconds(c), F.lit(86_400).cast("bigint"))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    head = F.concat(day.cast("string"), F.lit("T"), two(floor_div(of_day, 3600)), F.lit(":"),
                    two(F.pmod(floor_div(of_day, 60), F.lit(60).cast("bigint"))), F.lit(":"),
                    two(F.pmod(of_day, F.lit(60).cast("bigint"))))
    n9 = F.lpad(nanos.cast("string"), 9, "0")
    frac = (F.when(nanos == 0, F.lit(""))
            .when(F.pmod(nanos, F.lit(1_000_000)) == 0, F.concat(F.lit("."), F.substring(n9, 1, 3)))
            .when(F.pmod(nanos, F.lit(1_000)) == 0, F.concat(F.lit("."), F.substring(n9, 1, 6)))
            .otherwise(F.concat(F.lit("."), n9)))
    return F.when(_col(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(head, frac, F.lit("Z")))


# --------------------------------------------------------------------------- time zones


def zone_offset_ns(c, zone: str) -> Column:
    """Offset of ``zone`` from UTC at the instant ``c`` (ns), DST included."""
    ts = ns_to_timestamp(c)
    shifted = F.from_utc_timestamp(ts, zone)
    return checked_multiply(F.unix_micros(shifted) - F.unix_micros(ts), 1000, "zone_offset_ns")


def to_zone(c, zone: str) -> Column:
    """Wall-clock ns of instant ``c`` in ``zone``: the local date and time read as if
    it were UTC (epoch seconds plus the zone offset at that instant)."""
    return checked_add(c, zone_offset_ns(c, zone), "to_zone")
