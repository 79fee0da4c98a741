"""Structured Streaming: the cursor source and the idempotent sink."""

import pytest
from pyspark.sql import functions as F

from chronoline.functions import codec
from chronoline.operators.points import to_points
from chronoline.plans import catalog as C
from chronoline.session import scratch_path
from chronoline.sources import store
from chronoline.streaming import sink
from chronoline.streaming.source import read_stream
from tests.conftest import SF001
from tests.fixtures import SINK_LINES, SOURCE_LINES

S = 1_000_000_000


def _write_text(spark, lines):
    d = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(d)
    return d


def _store_times(spark, times, bucket="b", host="a"):
    root = scratch_path(spark, "store")
    df = spark.createDataFrame([(host, float(i), t) for i, t in enumerate(times)],
                               "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, bucket)
    return root


def _drain(spark, df, name):
    q = (df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return spark.table(name), q


def test_drain_equals_batch_scan(spark):
    ev = C.events_points(spark, SF001)
    root = scratch_path(spark, "store")
    store.write_points(ev, root, "b", batch_size=300)
    out, q = _drain(spark, read_stream(spark, root, "b", "events", output="lines"), "drain1")
    exp = codec.encode_lines(ev, "compat")
    assert out.count() == exp.count()
    assert out.exceptAll(exp).count() == 0 and exp.exceptAll(out).count() == 0
    pts, _ = _drain(spark, read_stream(spark, root, "b", "events", output="points",
                                       numSlices=3), "drain2")
    assert pts.count() == ev.count()


def test_compat_cursor_moves_one_delta_per_trigger(spark):
    lo = 1_700_000_000 * S
    times = [lo + k * S // 2 for k in range(10)]      # 0 .. 4.5 s
    root = _store_times(spark, times)
    df = read_stream(spark, root, "b", "cpu", output="points", **{"delta-time": 1000,
                                                                   "compat": "true"})
    q = df.writeStream.format("memory").queryName("compat1").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert rows == [2, 2, 2, 2, 2]          # [lo + k s, lo + (k+1) s), k = 0..4
    assert sorted(r.time_ns for r in spark.table("compat1").collect()) == times


def test_compat_holds_the_tail_when_span_is_a_multiple(spark):
    lo = 1_700_000_000 * S
    times = [lo, lo + S, lo + 2 * S]                  # max - min = 2 deltas
    root = _store_times(spark, times)
    df = read_stream(spark, root, "b", "cpu", output="points",
                     **{"delta-time": 1000, "compat": "true"})
    q = df.writeStream.format("memory").queryName("compat2").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.time_ns for r in spark.table("compat2").collect()) == times[:2]


def test_restart_midway_reads_each_row_once(spark):
    lo = 1_700_000_000 * S
    times = [lo + k * 700_000_000 for k in range(20)]   # 0 .. 13.3 s
    root = _store_times(spark, times)
    ck = scratch_path(spark, "ck")
    out = scratch_path(spark, "out")
    for _ in range(8):                                  # one capped step per run
        df = read_stream(spark, root, "b", "cpu", output="points", maxDeltaPerTrigger=3000)
        q = (df.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
    got = sorted(r.time_ns for r in spark.read.parquet(out).collect())
    assert got == times


def test_new_rows_after_the_cursor_are_read_later(spark):
    lo = 1_700_000_000 * S
    root = _store_times(spark, [lo, lo + S])
    ck, out = scratch_path(spark, "ck"), scratch_path(spark, "out")

    def run():
        df = read_stream(spark, root, "b", "cpu", output="points")
        q = (df.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    # a late row (older than the cursor) and a new one
    df = spark.createDataFrame([("a", 9.0, lo + S // 2), ("a", 8.0, lo + 5 * S)],
                               "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    run()
    got = sorted(r.time_ns for r in spark.read.parquet(out).collect())
    assert got == [lo, lo + S, lo + 5 * S]


def test_missing_options_fail_before_start(spark):
    with pytest.raises(ValueError, match="measurement"):
        read_stream(spark, "/x", "b", "")
    with pytest.raises(ValueError, match="delta-time"):
        read_stream(spark, "/x", "b", "m", **{"delta-time": 0})


# --------------------------------------------------------------------------- sink


def _sink(spark, lines, **kw):
    d = _write_text(spark, lines)
    root, ck = scratch_path(spark, "store"), scratch_path(spark, "ck")
    src = spark.readStream.schema("value STRING").text(d)
    q = sink.write_stream(src, root, "b", ck, trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return root


def test_sink_example_lines(spark):
    root = _sink(spark, SINK_LINES)
    pts = store.read_points(spark, root, "b", "sensor")
    assert pts.count() == 40
    assert sorted({r.time_ns for r in pts.collect()}) == [
        1723456926000000000 + i * S for i in range(5)]


def test_sink_lines_without_time_take_the_batch_time(spark):
    root = _sink(spark, SOURCE_LINES)
    pts = store.read_points(spark, root, "b", "sensor", dedupe=False)
    rows = pts.collect()
    assert len(rows) == 64
    assert len({r.time_ns for r in rows}) == 1
    stored = store.read_store(spark, root, "b").select(
        (F.unix_micros("written_at") * 1000).alias("w"), "time_ns").distinct().collect()
    assert all(r.w == r.time_ns for r in stored)


def test_sink_rejects_and_good_lines(spark):
    root = _sink(spark, SINK_LINES + ["garbage", "m f=1x 3"])
    assert store.read_points(spark, root, "b").count() == 40
    rej = spark.read.parquet(store.rejects_root(root, "b")).collect()
    assert sorted((r.value, r.reason) for r in rej) == [("garbage", "syntax"),
                                                       ("m f=1x 3", "bad value")]


def test_same_batch_twice_leaves_the_same_store(spark):
    root = scratch_path(spark, "store")
    fn = sink.PointSinkBatch(sink.SinkOptions(root, "b"), writer="adhoc")
    batch = spark.createDataFrame([(x,) for x in SINK_LINES], "value STRING").withColumn(
        "_written_at", F.current_timestamp())
    # a crash after the data write, before the commit: nothing visible
    pts = codec.points_from_parsed(codec.parse_lines(batch, keep=["_written_at"]),
                                   keep=["_written_at"])
    fn._write(pts, "adhoc", 0)
    assert store.read_points(spark, root, "b").count() == 0
    fn(batch, 0)
    fn(batch, 0)                    # replay: skipped by its commit record
    assert store.read_points(spark, root, "b", dedupe=False).count() == 40


def test_sink_checks(spark):
    src = spark.readStream.schema("value STRING").text(_write_text(spark, SINK_LINES))
    root, ck = scratch_path(spark, "store"), scratch_path(spark, "ck")
    with pytest.raises(ValueError, match="does not support complete output mode"):
        sink.write_stream(src, root, "b", ck, output_mode="complete")
    with pytest.raises(ValueError, match="Required attribute 'value' not found"):
        sink.write_stream(src.select(F.col("value").alias("VALUE")), root, "b", ck)
    with pytest.raises(ValueError, match="unsupported type int"):
        sink.write_stream(src.select(F.length("value").alias("value")), root, "b", ck)
    with pytest.raises(ValueError, match="numPartitions"):
        sink.write_stream(src, root, "b", ck, num_partitions=0)
    with pytest.raises(ValueError, match="batchSize"):
        sink.write_stream(src, root, "b", ck, batch_size=0)


def test_sink_value_not_first_and_binary(spark):
    d = _write_text(spark, SINK_LINES)
    root, ck = scratch_path(spark, "store"), scratch_path(spark, "ck")
    src = (spark.readStream.schema("value STRING").text(d)
           .select(F.lit(1).alias("other"), F.col("value").cast("binary").alias("value")))
    q = sink.write_stream(src, root, "b", ck, trigger={"availableNow": True}, num_partitions=1)
    q.awaitTermination()
    assert store.read_points(spark, root, "b").count() == 40


def test_arrival_order_reads_every_row(spark):
    lo = 1_700_000_000 * S
    root = _store_times(spark, [lo, lo + S])
    ck, out = scratch_path(spark, "ck"), scratch_path(spark, "out")

    def run():
        df = read_stream(spark, root, "b", "cpu", output="points", order="arrival")
        q = (df.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None

    run()
    late = spark.createDataFrame([("a", 9.0, lo - S)], "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(late, "cpu", ["host"], ["v"], "t"), root, "b")
    run()
    assert sorted(r.time_ns for r in spark.read.parquet(out).collect()) == [lo - S, lo, lo + S]


def test_time_zone_option_adds_local_time(spark):
    lo = 1_700_000_000 * S
    root = _store_times(spark, [lo])
    df = read_stream(spark, root, "b", "cpu", output="points", time_zone="Asia/Shanghai")
    out, _ = _drain(spark, df, "tz1")
    r = out.first()
    assert r.local_ns - r.time_ns == 8 * 3600 * S
    lines = read_stream(spark, root, "b", "cpu", **{"time-zone": "Asia/Shanghai"})
    got = _drain(spark, lines, "tz2")[0].first()
    assert got.value.endswith(f" {lo}") and got.local_ns == r.local_ns


def test_sink_takes_points(spark):
    ev = C.events_points(spark, SF001)
    d = scratch_path(spark, "pts")
    ev.write.parquet(d)
    root, ck = scratch_path(spark, "store"), scratch_path(spark, "ck")
    src = spark.readStream.schema(ev.schema).parquet(d)
    q = sink.write_stream(src, root, "b", ck, trigger={"availableNow": True}, input_kind="points")
    q.awaitTermination()
    assert q.exception() is None
    cols = ["series_key", "field", "value_double", "time_ns"]
    got = store.read_points(spark, root, "b").select(*cols)
    assert got.exceptAll(ev.select(*cols)).count() == 0 and got.count() == ev.count()


def test_lateness_holds_back_the_newest(spark):
    lo = 1_700_000_000 * S
    times = [lo, lo + S, lo + 2 * S, lo + 3 * S]
    root = _store_times(spark, times)
    df = read_stream(spark, root, "b", "cpu", output="points", lateness=1500)
    out, _ = _drain(spark, df, "late1")
    # end = max + 1 - 1.5 s: the records at lo + 2 s and lo + 3 s wait
    assert sorted(r.time_ns for r in out.collect()) == times[:2]


def test_capped_steps_jump_over_gaps(spark):
    lo = 1_700_000_000 * S
    day = 86_400 * S
    times = [lo, lo + S, lo + 3 * day, lo + 3 * day + S]     # a three-day empty gap
    root = _store_times(spark, times)
    df = read_stream(spark, root, "b", "cpu", output="points", maxDeltaPerTrigger=5000)
    q = df.writeStream.format("memory").queryName("gap1").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2]           # two steps, not ~50,000 empty ones
    assert sorted(r.time_ns for r in spark.table("gap1").collect()) == times


def test_count_balanced_slices_read_everything(spark):
    lo = 1_700_000_000 * S
    times = [lo + k for k in range(50)] + [lo + 10 * S + k * S for k in range(5)]
    root = _store_times(spark, times)
    df = read_stream(spark, root, "b", "cpu", output="points", balance="count", numSlices=4)
    out, _ = _drain(spark, df, "bal1")
    assert sorted(r.time_ns for r in out.collect()) == times


def test_two_sources_in_one_query(spark):
    lo = 1_700_000_000 * S
    root = scratch_path(spark, "store")
    for m, host, times in (("cpu", "a", [lo, lo + S]), ("mem", "b", [lo + 2 * S])):
        df = spark.createDataFrame([(host, 1.0, t) for t in times], "host STRING, v DOUBLE, t BIGINT")
        store.write_points(to_points(df, m, ["host"], ["v"], "t"), root, "b")
    both = (read_stream(spark, root, "b", "cpu", output="points")
            .unionByName(read_stream(spark, root, "b", "mem", output="points")))
    out, _ = _drain(spark, both, "two1")
    assert sorted((r.measurement, r.time_ns) for r in out.collect()) == [
        ("cpu", lo), ("cpu", lo + S), ("mem", lo + 2 * S)]


class _CrashBeforeCommit(sink.PointSinkBatch):
    crashed = False

    def _commit(self, spark, writer, batch_id):
        if not _CrashBeforeCommit.crashed:
            _CrashBeforeCommit.crashed = True
            raise RuntimeError("simulated crash after the data write")
        super()._commit(spark, writer, batch_id)


def test_crash_mid_batch_then_restart(spark):
    d = _write_text(spark, SINK_LINES)
    root, ck = scratch_path(spark, "store"), scratch_path(spark, "ck")
    opts = sink.SinkOptions(root, "b")

    def start(fn):
        src = spark.readStream.schema("value STRING").text(d)
        staged = src.select("value", F.current_timestamp().alias("_written_at"))
        q = (staged.writeStream.foreachBatch(fn).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
        return q

    q = start(_CrashBeforeCommit(opts))
    assert q.exception() is not None
    assert store.read_points(spark, root, "b").count() == 0     # written, not committed
    q = start(sink.PointSinkBatch(opts))                        # same checkpoint: replay
    assert q.exception() is None
    assert store.read_points(spark, root, "b", dedupe=False).count() == 40


def test_hot_instant_is_split_by_key(spark):
    from chronoline.streaming.source import CursorStreamReader, plan_partitions
    lo = 1_700_000_000 * S
    n = 6_000
    root = scratch_path(spark, "store")
    # every row at one instant (as lines without a time get their batch's time),
    # and every key written twice: the later write must win
    for v in (1.0, 2.0):
        df = spark.range(n).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("host"),
                                   F.lit(v).alias("v"), F.lit(lo).alias("t"))
        store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    opts = {"path": root, "bucket": "b", "measurement": "cpu", "maxRowsPerSlice": "1000",
            "numSlices": "2"}
    reader = CursorStreamReader(opts)
    parts = plan_partitions(reader._batches(), lo, lo + 1, reader.opts, reader.data_root)
    assert len(parts) == 12 and {p.n_buckets for p in parts} == {12}
    out, _ = _drain(spark, read_stream(spark, root, "b", "cpu", output="points",
                                       maxRowsPerSlice=1000), "hot1")
    rows = out.collect()
    assert len(rows) == n and {r.value_double for r in rows} == {2.0}
    assert len({r.series_key for r in rows}) == n


def test_drain_of_overlapping_batches(spark):
    lo = 1_700_000_000 * S
    root = scratch_path(spark, "store")
    for v in (1.0, 2.0, 3.0):
        df = spark.createDataFrame([("a", v, lo), ("b", v, lo + int(v) * S)],
                                   "host STRING, v DOUBLE, t BIGINT")
        store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    late = spark.createDataFrame([("a", 7.0, lo)], "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(late, "cpu", ["host"], ["v"], "t"), root, "b")
    out, _ = _drain(spark, read_stream(spark, root, "b", "cpu", output="points"), "cmp1")
    got = sorted((r.series_key, r.time_ns, r.value_double) for r in out.collect())
    exp = sorted((r.series_key, r.time_ns, r.value_double)
                 for r in store.read_points(spark, root, "b").collect())
    assert got == exp and ("cpu,host=a", lo, 7.0) in got


def test_no_dedupe_read_of_several_batches(spark):
    lo = 1_700_000_000 * S
    root = scratch_path(spark, "store")
    for v in (1.0, 2.0, 3.0):
        df = spark.createDataFrame([("a", v, lo + int(v) * S)], "host STRING, v DOUBLE, t BIGINT")
        store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    df = spark.createDataFrame([("a", 4.0, lo + 4 * S)], "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    out, _ = _drain(spark, read_stream(spark, root, "b", "cpu", output="points", dedupe="false",
                                       numSlices=1), "nodd1")
    assert sorted(r.value_double for r in out.collect()) == [1.0, 2.0, 3.0, 4.0]


def test_measurement_with_path_special_characters(spark):
    lo = 1_700_000_000 * S
    root = scratch_path(spark, "store")
    m = 'cpu:load/1 a=b%"#[x]'
    df = spark.createDataFrame([("a", 1.0, lo), ("b", 2.0, lo + S)], "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(df, m, ["host"], ["v"], "t"), root, "b")
    out, _ = _drain(spark, read_stream(spark, root, "b", m, output="points"), "special1")
    assert sorted((r.measurement, r.value_double) for r in out.collect()) == [(m, 1.0), (m, 2.0)]
    assert store.read_points(spark, root, "b", m).count() == 2


def test_missing_files_are_an_error(spark):
    """A slice planned from a commit whose files are gone raises; it is not empty."""
    from chronoline.streaming.source import CursorStreamReader, plan_partitions, read_slice
    lo = 1_700_000_000 * S
    root = _store_times(spark, [lo, lo + S])
    reader = CursorStreamReader({"path": root, "bucket": "b", "measurement": "cpu"})
    parts = plan_partitions(reader._batches(), lo, lo + 2 * S, reader.opts, reader.data_root)
    assert sum(rb.num_rows for p in parts for rb in read_slice(p)) == 2
    store.delete_path(spark, store.data_root(root, "b"))
    with pytest.raises(FileNotFoundError):
        [rb for p in parts for rb in read_slice(p)]


def test_absent_store_is_an_error(spark):
    from chronoline.streaming.source import CursorStreamReader
    reader = CursorStreamReader({"path": scratch_path(spark, "nowhere"), "bucket": "b", "measurement": "m"})
    with pytest.raises(FileNotFoundError):
        reader.initialOffset()


def test_capped_drain(spark):
    """One availableNow run is one capped step; drain() runs until nothing is left."""
    from chronoline.streaming.source import drain
    lo = 1_700_000_000 * S
    times = [lo + k * 700_000_000 for k in range(20)]
    root, ck, out = _store_times(spark, times), scratch_path(spark, "ck"), scratch_path(spark, "out")

    def start():
        return (read_stream(spark, root, "b", "cpu", output="points", maxDeltaPerTrigger=3000)
                .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())
    assert drain(start) > 2
    assert sorted(r.time_ns for r in spark.read.parquet(out).collect()) == times


def test_late_rows_are_counted_across_restarts(spark):
    """Rows committed below the cursor, while the query runs or is stopped."""
    from chronoline.streaming.source import CursorStreamReader
    hour = 3_600 * S
    root = _store_times(spark, [10 * hour, 11 * hour])
    opts = {"path": root, "bucket": "b", "measurement": "cpu"}

    def write(times):
        df = spark.createDataFrame([("z", 1.0, t) for t in times], "host STRING, v DOUBLE, t BIGINT")
        store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b")
    reader = CursorStreamReader(opts)
    first = reader.initialOffset()
    one = reader.latestOffset()
    assert (one["ns"], one["late"], one["late_maybe"]) == (11 * hour + 1, 0, 0)
    reader.partitions(first, one)
    write([2 * hour, 3 * hour, 12 * hour])          # two late, one new
    two = reader.latestOffset()
    assert (two["ns"], two["late"], two["late_maybe"]) == (12 * hour + 1, 2, 0)
    write([4 * hour, 12 * hour - 5, 12 * hour + 9])
    again = CursorStreamReader(opts)                # a restart: Spark replays the last offsets
    again.partitions(one, two)
    three = again.latestOffset()
    assert (three["ns"], three["late"], three["late_maybe"]) == (12 * hour + 10, 4, 0)
