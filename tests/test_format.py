"""The ``linepoints`` format: batch and stream writers, batch reader with pushed filters."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import datasource as D

from chronoline.functions.codec import POINT_COLUMNS
from chronoline.operators.points import to_points
from chronoline.sources import store
from chronoline.sources.format_reader import PointsReader, _bounds, _measurements
from chronoline.sources.format_writer import PointsStreamWriter, commit_batch
from chronoline.streaming.source import POINT_DDL, LinePointsDataSource, qualified, read_slice, register
from pyspark.sql.types import StructType

DAY = 86_400_000_000_000


@pytest.fixture(autouse=True)
def registered(spark):
    register(spark)


def points(spark, n=300, measurement="mem free=%", shift=0):
    raw = spark.range(n).select((F.col("id") * (DAY // 50) + shift).alias("t"), (F.col("id") % 7).cast("string").alias("host"),
                                F.col("id").cast("double").alias("used"))
    return to_points(raw.withColumn("t", F.timestamp_micros(F.expr("t div 1000"))), measurement, ["host"], ["used"], "t")


def rows(df):
    cols = ["measurement", "series_key", "field", "value_double", "time_ns"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def load(spark, root, bucket="b", **options):
    r = spark.read.format("linepoints").option("path", root).option("bucket", bucket)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


@pytest.fixture
def root(spark, tmp_store):
    return qualified(spark, tmp_store)


def save(df, root, **options):
    df.write.format("linepoints").mode("append").options(path=root, bucket="b", **options).save()


def test_batch_write_reads_back_both_ways(spark, root):
    p, q = points(spark), points(spark, 40, "cpu")
    save(p.unionByName(q), root)
    want = rows(p.unionByName(q))
    assert rows(load(spark, root)) == want
    assert rows(store.read_points(spark, root, "b")) == want
    assert rows(load(spark, root, measurement="cpu")) == rows(q)
    tags = {tuple(sorted(r["tags"].items())) for r in load(spark, root).collect()}
    assert len(tags) == 7
    assert not os.listdir(root.removeprefix("file:") + "/b/_staging")


def test_last_write_wins_over_batches(spark, root):
    save(points(spark), root)
    newer = points(spark, 10).withColumn("value_double", F.lit(-1.0))
    save(newer, root)
    got = load(spark, root)
    assert got.count() == 300 and got.where("value_double = -1").count() == 10
    # A condition on values is applied after the last write is chosen.
    assert got.where("value_double < 10 and value_double >= 0").count() == 0
    assert load(spark, root, dedupe="false").count() == 310
    assert rows(got) == rows(store.read_points(spark, root, "b"))


def test_pushed_filters_reach_partitions(root, spark):
    p = points(spark)
    save(p.unionByName(points(spark, 300, "cpu")), root)
    r = PointsReader({"path": root, "bucket": "b", "numSlices": "3"}, StructType.fromDDL(POINT_DDL))
    key, residue = "cpu,host=3", D.GreaterThan(("value_double",), 5.0)
    left = list(r.pushFilters([
        D.EqualTo(("measurement",), "cpu"), D.GreaterThanOrEqual(("time_ns",), DAY), D.LessThan(("time_ns",), 3 * DAY),
        D.EqualTo(("series_key",), key), residue, D.IsNotNull(("time_ns",)), D.EqualTo(("tags", "host"), "3")]))
    assert left == [residue, D.EqualTo(("tags", "host"), "3")]
    parts = r.partitions()
    assert {x.measurement for x in parts} == {"cpu"} and len(parts) == 3
    assert min(x.start_ns for x in parts) >= DAY and max(x.stop_ns for x in parts) <= 3 * DAY
    assert {d for x in parts for _, _, days in x.batches for d in days} == {1, 2}
    got = [t for x in parts for rb in r.read(x) for t in rb.column("time_ns").to_pylist()]
    want = spark.range(300).where(f"id % 7 = 3 and id >= 50 and id < 150").count()
    assert len(got) == want
    plan = load(spark, root).where("measurement = 'cpu' and value_double > 5 and tags['host'] = '3'")
    assert plan.count() == spark.range(300).where("id % 7 = 3 and id > 5").count()


@pytest.mark.parametrize("condition", [
    "time_ns = 1728000000000", "time_ns in (0, 1728000000000)", "not time_ns > 1728000000000",
    "series_key like '%host=3'", "series_key like 'cpu%'", "series_key like '%ost=%'", "measurement in ('cpu', 'x')",
    "measurement <> 'cpu'", "field = 'used' and time_ns <= 86400000000000", "measurement = 'cpu' and measurement = 'x'",
    "time_ns > 9223372036854775806", "time_ns < -9223372036854775807", "measurement is null", "series_key = ''", "1 = 0"])
def test_pushed_filters_equal_spark(spark, root, condition):
    p = points(spark).unionByName(points(spark, 60, "cpu"))
    save(p, root)
    assert rows(load(spark, root).where(condition)) == rows(p.where(condition))


def test_bounds():
    f = [D.GreaterThan(("time_ns",), 4), D.LessThanOrEqual(("time_ns",), 9), D.Not(D.EqualTo(("time_ns",), 5)),
         D.In(("measurement",), ("a", "b")), D.EqualTo(("measurement",), "b")]
    assert _bounds(f) == (5, 10) and _measurements(f) == {"b"}


def test_columns_of_a_given_schema(spark, root):
    save(points(spark), root)
    df = spark.read.format("linepoints").schema("value_double double, time_ns long").options(path=root, bucket="b").load()
    assert df.columns == ["value_double", "time_ns"] and df.agg(F.sum("value_double")).first()[0] == sum(range(300))
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("linepoints").schema("x int").options(path=root, bucket="b").load().collect()


@pytest.mark.parametrize("change,match", [
    (lambda d: d.drop("tags"), "missing columns"),
    (lambda d: d.select(F.lit("m f=1").alias("value")), "decode_lines"),
    (lambda d: d.withColumn("value_long", F.lit("x")), "value_long"),
    (lambda d: d.withColumn("measurement", F.lit(None).cast("string")), "without measurement")])
def test_input_checks(spark, root, change, match):
    with pytest.raises(Exception, match=match):
        save(change(points(spark)), root)
    assert not os.path.exists(root.removeprefix("file:") + "/b/_commits")


def test_append_only(spark, root):
    with pytest.raises(Exception, match="appended only"):
        points(spark).write.format("linepoints").mode("overwrite").options(path=root, bucket="b").save()
    save(points(spark), root, writer="w")
    with pytest.raises(Exception, match="has written"):
        save(points(spark), root, writer="w")
    with pytest.raises(Exception, match="no scheme"):
        save(points(spark), "/no/scheme")


def staged(root, spark, df, checkpoint):
    w = PointsStreamWriter({"path": root, "bucket": "b", "checkpointLocation": checkpoint}, df.schema, False)
    return w, [w.write(iter(df.toArrow().to_batches()))]


def test_killed_between_write_and_commit(spark, root, tmp_path):
    """Staged files never show; the batch that runs again is the only one."""
    (tmp_path / "metadata").write_text('{"id": "q-1"}')
    p = points(spark)
    w, lost = staged(root, spark, p, str(tmp_path))
    assert lost[0].files
    save(points(spark, 5, "cpu"), root)
    assert load(spark, root).count() == 5                     # killed: nothing of the batch shows
    w, messages = staged(root, spark, p, str(tmp_path))       # run again after the restart
    w.commit(messages, 0)
    assert load(spark, root).count() == 305
    again, more = staged(root, spark, p, str(tmp_path))       # Spark did not hear of the commit
    again.commit(more, 0)
    assert load(spark, root, dedupe="false").count() == 305
    half, parts = staged(root, spark, points(spark, 20, "disk"), str(tmp_path))
    w.commit(parts, 1)
    done = root.removeprefix("file:") + "/b/_commits/writer=q-1/batch_id=1/_SUCCESS"
    os.remove(done)                                            # killed before the last step of a commit
    half, parts = staged(root, spark, points(spark, 20, "disk"), str(tmp_path))
    half.commit(parts, 1)
    assert load(spark, root, dedupe="false").count() == 325
    w.abort([], 2)
    assert not os.listdir(root.removeprefix("file:") + "/b/_staging")


def test_stream_write_restart_and_replay(spark, root, tmp_path):
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")

    def run():
        q = (spark.readStream.schema(points(spark).schema).option("maxFilesPerTrigger", 1).parquet(src)
             .withColumn("written_at", F.current_timestamp()).writeStream.format("linepoints")
             .options(path=root, bucket="b", checkpointLocation=ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None

    points(spark).coalesce(2).write.mode("append").parquet(src)
    run()
    points(spark, 30, "cpu").coalesce(1).write.mode("append").parquet(src)
    run()
    want = rows(points(spark).unionByName(points(spark, 30, "cpu")))
    assert rows(load(spark, root, dedupe="false")) == want
    commits = sorted(int(x) for x in os.listdir(f"{ck}/commits") if x.isdigit())
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):    # Spark runs the last batch again
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    run()
    assert rows(load(spark, root, dedupe="false")) == want


def test_stream_writer_checks(spark, root):
    schema = points(spark).schema
    with pytest.raises(ValueError, match="checkpointLocation"):
        PointsStreamWriter({"path": root, "bucket": "b"}, schema, False)
    with pytest.raises(ValueError, match="append"):
        PointsStreamWriter({"path": root, "bucket": "b", "writer": "w"}, schema, True)
    with pytest.raises(ValueError, match="bucket"):
        LinePointsDataSource({"path": root}).streamWriter(schema, False)
    assert commit_batch([None], root + "/b", "r", "w", 0) and not commit_batch([None], root + "/b", "r", "w", 0)
