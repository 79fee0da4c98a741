"""The Parquet point store: write, committed-only read, upsert."""

import pytest
from pyspark.sql import functions as F

from chronoline.functions.codec import POINT_COLUMNS
from chronoline.operators.points import first_last_records, to_points
from chronoline.plans import catalog as C
from chronoline.sources import store
from tests.conftest import SF001

CMP = ["series_key", "field", "value_double", "value_long", "value_bool", "value_string", "time_ns"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*CMP).collect())


def _pts(spark, rows):
    df = spark.createDataFrame(rows, "host STRING, v DOUBLE, t BIGINT")
    return to_points(df, "cpu", ["host"], ["v"], "t")


def test_round_trip_and_commit(spark, tmp_store):
    ev = C.events_points(spark, SF001)
    info = store.write_points(ev, tmp_store, "b", batch_size=100)
    assert store.is_committed(spark, tmp_store, "b", info["writer"], 0)
    c = store.commits(spark, tmp_store, "b").collect()
    assert sum(r.n_records for r in c) == ev.count()
    assert len({(r.writer, r.batch_id) for r in c}) == 1
    hours = ev.select(F.floor(F.col("time_ns") / store.NS_PER_HOUR)).distinct().count()
    assert len(c) == hours
    assert _rows(store.read_points(spark, tmp_store, "b", "events")) == _rows(ev)
    assert _rows(store.read_points(spark, tmp_store, "b", "events", dedupe=False)) == _rows(ev)
    lines = store.read_lines(spark, tmp_store, "b", "events")
    assert lines.count() == ev.count()


def test_range_read_prunes(spark, tmp_store):
    ev = C.events_points(spark, SF001)
    store.write_points(ev, tmp_store, "b")
    got = store.read_points(spark, tmp_store, "b", "events", C.RANGE_START_NS, C.RANGE_STOP_NS)
    exp = ev.where((F.col("time_ns") >= C.RANGE_START_NS) & (F.col("time_ns") < C.RANGE_STOP_NS))
    assert _rows(got) == _rows(exp)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan
    assert "GreaterThanOrEqual(time_ns" in plan and "LessThan(time_ns" in plan


def test_last_write_wins(spark, tmp_store):
    store.write_points(_pts(spark, [("a", 1.0, 10), ("b", 2.0, 10)]), tmp_store, "b")
    store.write_points(_pts(spark, [("a", 5.0, 10), ("a", 6.0, 20)]), tmp_store, "b")
    got = {(r.series_key, r.time_ns): r.value_double
           for r in store.read_points(spark, tmp_store, "b").collect()}
    assert got == {("cpu,host=a", 10): 5.0, ("cpu,host=b", 10): 2.0, ("cpu,host=a", 20): 6.0}
    assert store.read_points(spark, tmp_store, "b", dedupe=False).count() == 4
    # first/last record: a tie on time resolves to the latest write
    raw = store.read_store(spark, tmp_store, "b")
    fl = {r.series_key: (r.first_value_double, r.last_value_double)
          for r in first_last_records(raw, order=store.write_order()).collect()}
    assert fl["cpu,host=a"] == (5.0, 6.0)


def test_uncommitted_batch_is_invisible(spark, tmp_store):
    store.write_points(_pts(spark, [("a", 1.0, 10)]), tmp_store, "b")
    stamped = (_pts(spark, [("z", 9.0, 10)]).withColumn("written_at", F.current_timestamp())
               .withColumn("seq", F.monotonically_increasing_id()))
    store.write_batch(stamped, tmp_store, "b", "crashed", 3)
    store.delete_path(spark, store.batch_dir(store.commits_root(tmp_store, "b"), "crashed", 3))
    assert [r.series_key for r in store.read_points(spark, tmp_store, "b").collect()] == ["cpu,host=a"]


def test_option_errors(spark, tmp_store):
    pts = _pts(spark, [("a", 1.0, 10)])
    with pytest.raises(ValueError, match="numPartitions"):
        store.write_points(pts, tmp_store, "b", num_partitions=0)
    with pytest.raises(ValueError, match="batchSize"):
        store.write_points(pts, tmp_store, "b", batch_size=0)
    with pytest.raises(ValueError, match="bucket"):
        store.write_points(pts, tmp_store, "")
    with pytest.raises(ValueError, match="missing columns"):
        store.write_points(pts.drop("series_key"), tmp_store, "b")


def test_num_partitions_coalesces(spark, tmp_store):
    pts = C.events_points(spark, SF001).repartition(6)
    store.write_points(pts, tmp_store, "b", num_partitions=2, cluster_by_time=False)
    assert store.read_points(spark, tmp_store, "b").count() == pts.count()


def test_empty_store_reads_empty(spark, tmp_store):
    assert store.read_points(spark, tmp_store, "nothing").count() == 0
    assert set(POINT_COLUMNS) <= set(store.read_points(spark, tmp_store, "nothing").columns)


def test_auto_dedupe_skips_the_shuffle_only_when_safe(spark, tmp_store):
    store.write_points(_pts(spark, [("a", 1.0, 10), ("b", 1.0, 20)]), tmp_store, "b")
    plain = store.read_points(spark, tmp_store, "b")
    assert not store.may_hold_duplicates(spark, tmp_store, "b")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    # a later batch in a different hour: still no shuffle
    hour = store.NS_PER_HOUR
    store.write_points(_pts(spark, [("a", 2.0, 5 * hour)]), tmp_store, "b")
    assert not store.may_hold_duplicates(spark, tmp_store, "b")
    # a second batch in the same hour: the upsert runs and the later write wins
    store.write_points(_pts(spark, [("a", 3.0, 10)]), tmp_store, "b")
    assert store.may_hold_duplicates(spark, tmp_store, "b")
    got = {(r.series_key, r.time_ns): r.value_double
           for r in store.read_points(spark, tmp_store, "b").collect()}
    assert got[("cpu,host=a", 10)] == 3.0 and len(got) == 3
    # duplicates inside one batch are seen too
    store.write_points(_pts(spark, [("z", 1.0, 7 * hour), ("z", 2.0, 7 * hour)]), tmp_store, "c")
    assert store.may_hold_duplicates(spark, tmp_store, "c")
    assert store.read_points(spark, tmp_store, "c").count() == 1


def test_auto_dedupe_upserts_dirty_hours_alone(spark, tmp_store):
    """An hour with two batches is upserted, the others are scanned as they are."""
    hour = store.NS_PER_HOUR
    store.write_points(_pts(spark, [("a", 1.0, 10), ("a", 2.0, hour), ("a", 3.0, 5 * hour)]), tmp_store, "b")
    store.write_points(_pts(spark, [("a", 9.0, hour)]), tmp_store, "b")
    hours = {r.hour: r.repeats for r in store.hours_with_repeats(spark, tmp_store, "b").collect()}
    assert hours == {0: False, 1: True, 5: False}
    got = store.read_points(spark, tmp_store, "b")
    assert sorted((r.time_ns, r.value_double) for r in got.collect()) == [(10, 1.0), (hour, 9.0), (5 * hour, 3.0)]
    clean = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in clean and "LeftSemi" in clean


def test_commit_without_proof(spark, tmp_store):
    """One aggregation of hours; readers then take it that keys repeat."""
    hour = store.NS_PER_HOUR
    pts = _pts(spark, [("a", 1.0, 10), ("a", 2.0, 10), ("b", 2.0, hour), ("b", 3.0, hour + 1)])
    store.write_points(pts, tmp_store, "b", prove_keys=False)
    rows = {r.hour: (r.min_ns, r.max_ns, r.n_records, r.max_at_instant, r.n_keys)
            for r in store.commits(spark, tmp_store, "b").collect()}
    assert rows == {0: (10, 10, 2, 2, None), 1: (hour, hour + 1, 2, 1, None)}
    assert store.may_hold_duplicates(spark, tmp_store, "b")
    assert store.read_points(spark, tmp_store, "b").count() == 3


def test_time_knots_follow_the_rows(spark, tmp_store):
    """A burst inside an hour, and an instant that many rows share, show in the knots;
    the plan then cuts the burst by time and the instant by keys."""
    from chronoline.sources.options import SourceOptions
    from chronoline.streaming.source import _store_roots, list_commits, plan_partitions, qualified
    hour, second = store.NS_PER_HOUR, 1_000_000_000
    burst = [(f"h{i % 50}", 1.0, 30 * 60 * second + i * 1000) for i in range(5000)]
    even = [(f"h{i % 50}", 1.0, i * hour // 500) for i in range(500)]
    crowd = [(f"h{i}", 1.0, hour + 7) for i in range(3000)] + [("h0", 1.0, hour + 9 * second)]
    for prove in (True, False):
        bucket = f"b{prove}"
        store.write_points(_pts(spark, burst + even + crowd), tmp_store, bucket, prove_keys=prove)
        path = qualified(spark, tmp_store)
        rows = list_commits(path, bucket, "cpu")
        assert {len(r.knots) for r in rows} == {65}
        for r in rows:
            assert (r.knots[0], r.knots[-1]) == (r.min_ns, r.max_ns) and list(r.knots) == sorted(r.knots)
        opts = SourceOptions.parse({"path": path, "bucket": bucket, "measurement": "cpu", "maxRowsPerSlice": "1000"})
        parts = plan_partitions(rows, 0, 2 * hour, opts, _store_roots(path, bucket)[0])
        times = [t for _, _, t in burst + even + crowd]
        held = [sum(p.start_ns <= t < p.stop_ns for t in times) / p.n_buckets for p in parts]
        # Off by a knot of each end at most: 5500 / 64 rows.
        assert max(held) <= 1000 + 2 * 5500 / 64 + 2
        assert any(p.n_buckets >= 3 and p.start_ns <= hour + 7 < p.stop_ns for p in parts)
        assert round(sum(held), 6) == len(times)


def test_burst_of_many_rows_keeps_to_the_budget():
    """200 million rows in one second of an hour, by 1024 knots: no slice over budget
    but by its share of two knots."""
    import numpy as np
    from chronoline.sources.options import SourceOptions
    from chronoline.streaming.source import BatchRange, plan_partitions
    second, n, quiet = 1_000_000_000, 200_000_000, 1000
    def rows_before(t):   # the truth: quiet rows all over the hour, a burst in second 1800
        return quiet * t / (3600 * second) + (n - quiet) * np.clip((t - 1800 * second) / second, 0, 1)
    grid = np.concatenate([[0], np.linspace(1800 * second, 1801 * second, 100_001), [3600 * second - 1]])
    knots = np.interp(np.arange(1025) / 1024 * rows_before(grid[-1]), rows_before(grid), grid).astype(np.int64)
    b = [BatchRange("w", 0, 0, 3600 * second - 1, n, 1, 0, tuple(knots.tolist()))]
    opts = SourceOptions.parse({"path": "/x", "bucket": "b", "measurement": "m", "maxRowsPerSlice": "2000000"})
    parts = plan_partitions(b, 0, 3600 * second, opts, "/d")
    held = [float(rows_before(p.stop_ns) - rows_before(p.start_ns)) / p.n_buckets for p in parts]
    assert max(held) <= 2_000_000 + 2 * n / 1024
    assert len(parts) < 250


def test_series_estimate(spark, tmp_store):
    """Whole hours from sketches, cut hours and records without a sketch by a scan."""
    hour = store.NS_PER_HOUR
    a = [(f"a{i}", 1.0, i % 7) for i in range(2000)]
    b = [(f"b{i}", 1.0, hour + i) for i in range(1000)]
    store.write_points(_pts(spark, a + b), tmp_store, "b")
    store.write_points(_pts(spark, a[:500]), tmp_store, "b", prove_keys=False)

    def estimate(bucket="b", **kw):
        rows = store.series_estimate(spark, tmp_store, bucket, "cpu", **kw).collect()
        return (rows[0].n_series, rows[0].least, rows[0].most) if rows else None

    for true, kw in ((3000, {}), (2000, {"stop": hour}), (1000, {"start": hour}), (2300, {"stop": hour + 300}),
                     (700, {"start": hour + 300})):
        n, least, most = estimate(**kw)
        assert least <= true <= most and abs(n - true) <= store.SERIES_ERROR * true, kw
    assert estimate(start=5 * hour) is None
    # All in range: commit records alone.
    plan = store.series_estimate(spark, tmp_store, "b", "cpu")._jdf.queryExecution().optimizedPlan().toString()
    assert "value_double" not in plan and plan.count("Relation [") == 1
    # The writer of the format leaves no sketch.
    from chronoline.streaming.source import qualified, register
    register(spark)
    (_pts(spark, a).write.format("linepoints").mode("append").option("path", qualified(spark, tmp_store))
     .option("bucket", "f").save())
    n, least, most = estimate("f")
    assert least <= 2000 <= most


def _scanned(df) -> int:
    """Rows that the file scans of a collected DataFrame put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, n = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Scan parquet"):
            n += leaf.metrics().apply("numOutputRows").value()
    return n


def test_one_series_skips_files_by_bloom_filter(spark, tmp_store):
    """Two days of keys whose ranges overlap, too many for a dictionary: the file that
    lacks the series is not read."""
    day, n = store.NS_PER_DAY, 60_000
    rows = spark.range(2 * n).select(
        F.lit("cpu").alias("measurement"),
        F.create_map(F.lit("host"), F.concat(F.lit("a-rather-long-host-name-"), F.lpad(F.col("id").cast("string"), 9, "0"))).alias("tags"),
        F.lit("v").alias("field"), F.col("id").cast("double").alias("value_double"), F.lit(None).cast("bigint").alias("value_long"),
        F.lit(None).cast("boolean").alias("value_bool"), F.lit(None).cast("string").alias("value_string"),
        (F.col("id") % 2 * day + F.col("id")).alias("time_ns"))
    rows = rows.withColumn("series_key", F.concat(F.lit("cpu,host="), F.col("tags")["host"]))
    store.write_points(rows, tmp_store, "b", num_partitions=1)
    key = f"cpu,host=a-rather-long-host-name-{n:09d}"
    one = store.read_points(spark, tmp_store, "b", "cpu", series=key)
    assert [(r.value_double, r.time_ns) for r in one.collect()] == [(float(n), n)]
    assert 0 < _scanned(one) <= n
    assert "series_key" in one._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert _scanned(store.read_points(spark, tmp_store, "b", "cpu", series=[])) == 0
    two = store.read_points(spark, tmp_store, "b", "cpu", series=[key, f"cpu,host=a-rather-long-host-name-{n + 1:09d}", "no"])
    assert two.count() == 2
    assert _scanned(store.read_points(spark, tmp_store, "b", "cpu", series="cpu,host=a-rather-long-host-name-000000001x")) == 0


def test_wide_variant_keeps_types_and_the_latest(spark):
    from chronoline.operators.points import to_wide_variant
    rows = spark.createDataFrame(
        [("k", 1, "d", 1.5, None, None, None, 1), ("k", 1, "n", None, 9007199254740993, None, None, 1),
         ("k", 1, "t", None, None, True, None, 1), ("k", 1, "s", None, None, None, 'x"y', 1),
         ("k", 1, "s", None, None, None, "a", 2), ("k", 1, "d", None, 7, None, None, 2), ("k", 2, "e", None, None, None, None, 1)],
        "series_key string, time_ns long, field string, value_double double, value_long long, value_bool boolean, value_string string, w long")
    as_json = lambda df: {r.time_ns: r.j for r in df.select("time_ns", F.to_json("fields").alias("j")).collect()}
    assert as_json(to_wide_variant(rows, ["w"])) == {1: '{"d":7,"n":9007199254740993,"s":"a","t":true}', 2: '{"e":null}'}
    assert as_json(to_wide_variant(rows)) == {1: '{"d":1.5,"n":9007199254740993,"s":"x\\"y","t":true}', 2: '{"e":null}'}
    assert as_json(to_wide_variant(rows.limit(0))) == {}


def test_time_knots_of_large_and_tiny_hours(spark, monkeypatch):
    monkeypatch.setattr(store, "KNOT_ROWS", 10)
    rows = spark.range(5003).select(F.when(F.col("id") < 5000, 1).otherwise(2).alias("g"), F.col("id").alias("t"))
    got = {r.g: r.k for r in rows.groupBy("g").agg(F.kll_sketch_agg_bigint("t", store.KLL_K).alias("s"), F.count("*").alias("n"))
           .select("g", store.time_knots("s", "n").alias("k")).collect()}
    assert len(got[1]) == 501 and (got[1][0], got[1][-1]) == (0, 4999) and got[1] == sorted(got[1])
    assert max(b - a for a, b in zip(got[1], got[1][1:])) <= 30
    assert (got[2][0], got[2][-1], len(got[2])) == (5000, 5002, 4)


@pytest.mark.parametrize("constant", [True, False])
def test_files_are_sorted_by_time(spark, tmp_store, constant):
    """Also where all rows have one measurement, as a constant or as a column that may be null."""
    import glob

    import pyarrow.parquet as pq
    df = spark.range(0, 3000, 1, 2).selectExpr("cast(id % 7 as string) AS host", "double(id) AS v", "id * 7919 % 3001 AS t")
    points = to_points(df, "cpu", ["host"], ["v"], "t")
    if not constant:
        points = points.withColumn("measurement", F.when(F.col("time_ns") % 5 > 0, "cpu"))
    store.write_points(points, tmp_store, "b", num_partitions=1)
    files = glob.glob(tmp_store.removeprefix("file:") + "/b/data/**/*.parquet", recursive=True)
    times = [pq.ParquetFile(f).read(columns=["time_ns"])["time_ns"].to_pylist() for f in files]
    assert sum(map(len, times)) == 3000 and all(t == sorted(t) for t in times)
    assert sorted((f.split("measurement=")[1].split("/")[0], len(t)) for f, t in zip(files, times)) == (
        [("cpu", 3000)] if constant else [("__HIVE_DEFAULT_PARTITION__", 601), ("cpu", 2399)])
