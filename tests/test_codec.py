"""Line-protocol encode/decode."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoline.functions import codec
from chronoline.operators.points import to_points
from tests.fixtures import SENSOR_FIELDS, SINK_LINES, SOURCE_LINES, WRITE_EXAMPLE


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value STRING")


def _decode(spark, lines, **kw):
    return codec.decode_lines(_lines(spark, lines), **kw).collect()


def test_source_example_lines_without_time(spark):
    rows = _decode(spark, SOURCE_LINES, default_time_ns=42)
    assert len(rows) == 8 * 8
    assert {r.field for r in rows} == set(SENSOR_FIELDS)
    assert all(r.time_ns == 42 and r.series_key == "sensor,sid=1" for r in rows)
    assert all(r.value_double is not None and r.value_long is None for r in rows)
    assert sorted(r.value_double for r in rows if r.field == "temperature")[:4] == [-1.0] * 4
    assert all(r.tags == {"sid": "1"} and r.measurement == "sensor" for r in rows)


def test_sink_example_lines_with_time(spark):
    rows = _decode(spark, SINK_LINES)
    times = sorted({r.time_ns for r in rows})
    assert times == [1723456926000000000 + i * 1_000_000_000 for i in range(5)]
    assert len(rows) == 40
    neg = {(r.time_ns, r.value_double) for r in rows if r.field == "pm25_aqi"}
    assert (1723456927000000000, -1.0) in neg and (1723456929000000000, -4.0) in neg


def test_write_example(spark):
    rows = _decode(spark, [WRITE_EXAMPLE], default_time_ns=7)
    assert {(r.field, r.value_double) for r in rows} >= {("pm25_aqi", 101.0), ("humidity", 210.0)}


def test_types_and_escapes(spark):
    lines = [
        r'my\ meas,ta\=g=v\,1\ x f\ 1="a \"q\" \\ b, c=d",i=-12i,u=7u,b1=t,b2=FALSE,fl=2.5e3 99',
        "m f=1",
        "m,t=x f=true,g=.5,h=-1. 5",
    ]
    rows = {(r.series_key, r.field): r for r in _decode(spark, lines)}
    r = rows[(r"my\ meas,ta\=g=v\,1\ x", "f 1")]
    assert r.measurement == "my meas" and r.tags == {"ta=g": "v,1 x"}
    assert r.value_string == 'a "q" \\ b, c=d' and r.time_ns == 99
    key = r"my\ meas,ta\=g=v\,1\ x"
    assert rows[(key, "i")].value_long == -12
    assert rows[(key, "u")].value_long == 7
    assert rows[(key, "b1")].value_bool is True and rows[(key, "b2")].value_bool is False
    assert rows[(key, "fl")].value_double == 2500.0
    assert rows[("m", "f")].value_double == 1.0 and rows[("m", "f")].tags == {}
    assert rows[("m,t=x", "g")].value_double == 0.5 and rows[("m,t=x", "h")].value_double == -1.0
    assert rows[("m,t=x", "f")].value_bool is True


@pytest.mark.parametrize("line,reason", [
    (None, "null"),
    ("", "empty"),
    ("   ", "empty"),
    ("# a comment", "comment"),
    ("nofields", "syntax"),
    ("m,t= f=1 2", "syntax"),
    ("bad line here now", "syntax"),
    ("m f=1 2 3", "syntax"),
    ("m f=abc 1", "bad value"),
    ("m f=1x", "bad value"),
    ("m f=99999999999999999999i", "bad value"),
    ("m,a=1,a=2 f=1", "duplicate tag key"),
    ("m f=1,f=2", "duplicate field key"),
    ("m f=1 99999999999999999999", "time out of range"),
])
def test_bad_line_reasons(spark, line, reason):
    rows = codec.bad_lines(_lines(spark, [line])).collect()
    assert [(r.value, r.reason) for r in rows] == [(line, reason)]
    assert _decode(spark, [line]) == []


def test_compat_keeps_unknown_values_as_strings(spark):
    rows = codec.decode_lines(_lines(spark, ["m f=abc,g=1i 5"]), compat=True).collect()
    got = {r.field: (r.value_string, r.value_long) for r in rows}
    assert got == {"f": ("abc", None), "g": (None, 1)}


def test_long_line_no_stack_overflow(spark):
    big = "m,t=x " + ",".join(f"f{i}={i}.5" for i in range(40_000)) + " 1"
    assert len(big) > 400_000
    quoted = 'm s="' + ("a\\\"b " * 80_000) + '" 2'
    df = _lines(spark, [big, quoted])
    assert codec.bad_lines(df).count() == 0
    assert codec.decode_lines(df).count() == 40_001


def test_binary_value_column(spark):
    df = spark.createDataFrame([(bytearray(SINK_LINES[0], "utf-8"),)], "value BINARY")
    assert codec.decode_lines(df).count() == 8


def test_value_column_checks(spark):
    with pytest.raises(ValueError, match="Required attribute 'value' not found"):
        codec.decode_lines(spark.createDataFrame([("x",)], "VALUE STRING"))
    with pytest.raises(ValueError, match="unsupported type int"):
        codec.decode_lines(spark.createDataFrame([(1,)], "value INT"))


def test_compat_encoding_matches_record_rendering(spark):
    df = spark.createDataFrame([("cpu", "h1", "eu", 1.5, None, 10), ("cpu", "h2", None, None, 3, 20)],
                               "m STRING, host STRING, region STRING, u DOUBLE, n BIGINT, t BIGINT")
    pts = to_points(df, "cpu", ["region", "host"], ["u", "n"], "t")
    got = sorted(r.value for r in codec.encode_lines(pts, "compat").collect())
    assert got == ["cpu,host=h1,region=eu u=1.5 10", "cpu,host=h2 n=3 20"]


# --------------------------------------------------------------------------- round trip

_name = st.text(alphabet=st.sampled_from(list("ab ,=\\\"xyz_1")), min_size=1, max_size=6)
_value = st.one_of(
    st.tuples(st.just("d"), st.floats(allow_nan=False, allow_infinity=False, width=64)),
    st.tuples(st.just("l"), st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1)),
    st.tuples(st.just("b"), st.booleans()),
    st.tuples(st.just("s"), st.text(alphabet=st.sampled_from(list('ab "\\,= \né')), max_size=8)),
)
_point = st.tuples(_name, st.dictionaries(_name, _name, max_size=3), _name, _value,
                   st.integers(min_value=-(2 ** 62), max_value=2 ** 62))


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(_point, min_size=1, max_size=40))
def test_round_trip_safe(spark, pts):
    rows = []
    for m, tags, field, (kind, v), t in pts:
        rows.append((m, tags, field, v if kind == "d" else None, v if kind == "l" else None,
                     v if kind == "b" else None, v if kind == "s" else None, t))
    schema = ("measurement STRING, tags MAP<STRING,STRING>, field STRING, value_double DOUBLE, "
              "value_long BIGINT, value_bool BOOLEAN, value_string STRING, time_ns BIGINT")
    df = spark.createDataFrame(rows, schema)
    df = df.withColumn("series_key", codec.series_key_from_map(F.col("measurement"), F.col("tags")))
    back = codec.decode_lines(codec.encode_lines(df, "safe"))
    cols = ["series_key", "measurement", "field", "value_double", "value_long", "value_bool",
            "value_string", "time_ns"]
    a = sorted(tuple(r) for r in df.select(*cols).collect())
    b = sorted(tuple(r) for r in back.select(*cols).collect())
    assert a == b
    assert sorted(str(sorted(r.tags.items())) for r in df.collect()) == \
        sorted(str(sorted(r.tags.items())) for r in back.collect())


def test_wide_lines_bounded_by_fields(spark):
    from chronoline.operators.points import to_wide
    rows = [("h", 1.0, 5, i) for i in range(50)] + [("h", 2.0, 6, 0)]
    df = spark.createDataFrame(rows, "host STRING, u DOUBLE, n BIGINT, seq BIGINT")
    pts = to_points(df.withColumn("t", F.lit(100).cast("bigint")), "m", ["host"], ["u", "n"], "t",
                    keep=["seq"])
    got = [r.value for r in codec.encode_wide_lines(pts, "safe", order=["seq"]).collect()]
    assert got == ["m,host=h n=5i,u=1.0 100"]
    w = to_wide(pts, None, order=["seq"]).collect()
    assert len(w) == 1 and w[0].fields == {"n": "5", "u": "1.0"}
    w2 = to_wide(pts, {"u": "double", "n": "long"}, order=["seq"]).collect()
    assert (w2[0].u, w2[0].n) == (1.0, 5)


def test_line_ends_and_infinity(spark):
    """One trailing line end is no part of a line; numbers beyond a double are bad."""
    lines = ["m f=1\r", "m f=1\n", "m f=1 5\r\n", "m f=1 5", "m f=1 5\n\n", "m f=1e400 5", 'm f="1e400" 5', "m f=-1e308 5"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = [(r.value_double, r.value_string, r.time_ns) for r in codec.decode_lines(df, default_time_ns=7).collect()]
    assert sorted(good, key=str) == sorted([(1.0, None, 7), (1.0, None, 7), (1.0, None, 5), (1.0, None, 5),
                                            (None, "1e400", 5), (-1e308, None, 5)], key=str)
    bad = {r.value: r.reason for r in codec.bad_lines(df).collect()}
    assert bad == {"m f=1 5\n": "syntax", "m f=1e400 5": "bad value"}


def test_points_without_a_line_have_a_reason(spark):
    from chronoline.functions.codec import bad_points, encode_lines
    rows = [(1, 1.0, 5, "m"), (2, float("nan"), 5, "m"), (3, float("-inf"), 5, "m"), (4, None, 5, "m"),
            (5, 1.0, None, "m"), (6, 1.0, 5, None)]
    pts = spark.createDataFrame(rows, "i int, value_double double, time_ns bigint, series_key string").selectExpr(
        "'m' AS measurement", "map('a', 'b') AS tags", "'f' AS field", "value_double", "CAST(NULL AS bigint) AS value_long",
        "CAST(NULL AS boolean) AS value_bool", "CAST(NULL AS string) AS value_string", "time_ns", "series_key", "i")
    assert {r.i: r.reason for r in bad_points(pts, keep=["i"]).collect()} == {
        2: "not a finite number", 3: "not a finite number", 4: "no value", 5: "no time", 6: "no key"}
    assert encode_lines(pts, "safe").count() == 1
