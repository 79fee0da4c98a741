"""Nanosecond functions against Python integer arithmetic."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from chronoline.functions import nanos as N
from tests.fixtures import ISO_EXAMPLE, NS_EXAMPLE, NS_SPLIT_EXAMPLE

LONG_MAX = 2 ** 63 - 1
VALUES = [0, 1, -1, 999, -999, 1_000, -1_000, 999_999_999, -999_999_999, 1_000_000_000,
          -1_000_000_001, NS_EXAMPLE, -NS_EXAMPLE, 1704067207179575000, -86_400_000_000_001]


@pytest.fixture(scope="module")
def ns_df(spark):
    return spark.createDataFrame([(v,) for v in VALUES], "t BIGINT")


def _java_iso(t: int) -> str:
    secs, nanos = divmod(t, 1_000_000_000)
    head = (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=secs)).strftime("%Y-%m-%dT%H:%M:%S")
    if nanos == 0:
        frac = ""
    elif nanos % 1_000_000 == 0:
        frac = "." + f"{nanos:09d}"[:3]
    elif nanos % 1_000 == 0:
        frac = "." + f"{nanos:09d}"[:6]
    else:
        frac = "." + f"{nanos:09d}"
    return head + frac + "Z"


def test_split_and_floor(ns_df):
    rows = ns_df.select("t", N.ns_seconds("t").alias("s"), N.ns_nanos("t").alias("n"),
                        N.ns_from_parts(N.ns_seconds("t"), N.ns_nanos("t")).alias("back"),
                        F.unix_micros(N.ns_to_timestamp("t")).alias("us")).collect()
    for r in rows:
        assert (r.s, r.n) == divmod(r.t, 1_000_000_000)
        assert r.back == r.t
        assert r.us == r.t // 1000


def test_doc_examples(spark):
    r = spark.createDataFrame([(ISO_EXAMPLE, NS_EXAMPLE)], "iso STRING, t BIGINT").select(
        N.ns_from_iso("iso").alias("parsed"), N.ns_to_iso("t").alias("iso2"),
        N.ns_split("t").alias("parts")).first()
    assert r.parsed == NS_EXAMPLE
    assert r.iso2 == ISO_EXAMPLE
    assert (r.parts.seconds, r.parts.nanos) == NS_SPLIT_EXAMPLE


def test_iso_round_trip(ns_df):
    rows = ns_df.select("t", N.ns_to_iso("t").alias("iso")).select(
        "t", "iso", N.ns_from_iso("iso").alias("back")).collect()
    for r in rows:
        assert r.iso == _java_iso(r.t)
        assert r.back == r.t


@pytest.mark.parametrize("text,expected", [
    ("1970-01-01T00:00:00Z", 0),
    ("1970-01-01T00:00:00.5Z", 500_000_000),
    ("1970-01-01T00:00:00.000000001Z", 1),
    ("1969-12-31T23:59:59.999999999Z", -1),
    ("2023-03-27T14:13:36.7251548+08:00", NS_EXAMPLE),
    ("2023-03-27T06:13:36Z", 1679897616_000_000_000),
    ("not a time", None),
    ("2023-13-27T06:13:36Z", None),
    ("2023-03-27T06:13:36.1234567890Z", None),
    (None, None),
])
def test_iso_parse_cases(spark, text, expected):
    r = spark.createDataFrame([(text,)], "s STRING").select(N.ns_from_iso("s").alias("v")).first()
    assert r.v == expected


def test_units_and_add(ns_df):
    rows = ns_df.select(
        "t", N.ns_add("t", 1500).alias("ms"), N.ns_add("t", -3, "h").alias("h"),
        N.ns_add("t", 7, "ns").alias("ns"), N.ns_add("t", 2, "days").alias("d"),
        N.millis_to_ns(F.lit(5)).alias("m5"), N.seconds_to_ns(F.lit(-2)).alias("s2")).collect()
    for r in rows:
        assert r.ms == r.t + 1_500_000_000
        assert r.h == r.t - 3 * 3_600_000_000_000
        assert r.ns == r.t + 7
        assert r.d == r.t + 2 * 86_400_000_000_000
        assert r.m5 == 5_000_000 and r.s2 == -2_000_000_000


def test_unknown_unit():
    with pytest.raises(ValueError):
        N.unit_factor("fortnight")


def test_overflow_raises(spark):
    df = spark.createDataFrame([(LONG_MAX - 5,)], "t BIGINT")
    with pytest.raises(Exception, match="overflow"):
        df.select(N.ns_add("t", 1, "ms")).collect()
    with pytest.raises(Exception, match="overflow"):
        df.select(N.to_ns("t", "s")).collect()
    assert df.select(N.ns_add("t", 5, "ns").alias("v")).first().v == LONG_MAX


def test_ids_too_large_for_hours_keep_their_rows(spark, tmp_path):
    from chronoline.plans.catalog import ns_units
    last = LONG_MAX // 3_600_000_000_000
    rows = [(i, dt.datetime(2024, 1, 8), 1, "view", 1.0, "{}") for i in (0, last, last + 1, -last, -last - 1, LONG_MAX)]
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                          "props STRING").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.id_hours_ns for r in ns_units(spark, str(tmp_path)).collect()}
    assert got == {i: i * 3_600_000_000_000 if abs(i) <= last else None for i, *_ in rows}


def test_timestamp_ntz_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts").select(
            N.ns_from_timestamp_ntz("ts").alias("v")).first()
        assert r.v == 1704067207179575000
        r = spark.createDataFrame([(NS_EXAMPLE,)], "t BIGINT").select(
            N.ns_to_iso("t").alias("iso")).first()
        assert r.iso == ISO_EXAMPLE
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "America/New_York", "Europe/Paris", "UTC"])
def test_to_zone(spark, zone):
    # DST edges in both hemispheres' spring/autumn, and pre-1970.
    instants = [dt.datetime(2024, 3, 10, 6, 59, 59, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 3, 10, 7, 0, 0, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 10, 27, 0, 59, 59, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 10, 27, 1, 0, 0, tzinfo=dt.timezone.utc),
                dt.datetime(1965, 7, 1, 12, 0, 0, tzinfo=dt.timezone.utc)]
    ns = [int(i.timestamp()) * 1_000_000_000 + 123 for i in instants]
    rows = spark.createDataFrame([(v,) for v in ns], "t BIGINT").select(
        "t", N.to_zone("t", zone).alias("z")).collect()
    for r in rows:
        inst = dt.datetime.fromtimestamp(r.t // 1_000_000_000, tz=ZoneInfo(zone))
        off = int(inst.utcoffset().total_seconds())
        assert r.z == r.t + off * 1_000_000_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Paris"])
def test_session_zone_plays_no_part(spark, zone):
    """Wall clocks in hours that the zone skips or repeats, and in others."""
    walls = ["2024-03-10 02:30:00", "2024-03-31 02:30:00.000001", "2024-11-03 01:30:00", "2024-10-27 02:30:00",
             "1969-12-31 23:59:59.999999", "2024-01-08 00:00:00"]
    import datetime as dt
    want = [round((dt.datetime.fromisoformat(w) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) * 1000
            for w in walls]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, w) for i, w in enumerate(walls)], "i int, w string").select(
            "i", F.col("w").cast("timestamp_ntz").alias("w"))
        rows = df.select("i", N.ns_from_timestamp_ntz("w").alias("ns")).select(
            "i", "ns", N.ns_to_iso("ns").alias("iso"), N.ns_from_iso(N.ns_to_iso("ns")).alias("back")).orderBy("i").collect()
        assert [r.ns for r in rows] == want
        assert [r.iso[:19].replace("T", " ") for r in rows] == [w[:19] for w in walls]
        assert [r.back for r in rows] == want
        from chronoline.operators.points import to_points
        pts = to_points(df, "m", [], ["i"], "w", start=want[0], stop=want[0] + 1)
        assert [r.time_ns for r in pts.collect()] == [want[0]]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
