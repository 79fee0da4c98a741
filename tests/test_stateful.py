"""Stateful stream operators: upsert over batches, sessions, and what frees their state."""

import json

import pytest
from pyspark.sql import functions as F

from chronoline.operators.points import to_points
from chronoline.session import scratch_path
from chronoline.sources import store
from chronoline.streaming.stateful import sessions, upsert_stream, write_upserts

S = 1_000_000_000
LO = 1_700_000_000 * S


def versions(spark, rows):
    """``rows``: (host, value, ns, version)."""
    df = spark.createDataFrame(rows, "host STRING, v DOUBLE, t BIGINT, version BIGINT")
    return to_points(df, "cpu", ["host"], ["v"], "t", keep=["version"])


class Feed:
    """Batches of points, one file each, streamed one a trigger."""

    def __init__(self, spark):
        self.spark, self.path = spark, scratch_path(spark, "feed")

    def add(self, rows):
        versions(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = versions(self.spark, [("a", 1.0, LO, 1)]).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def finish(q):
    q.awaitTermination()
    assert q.exception() is None
    return [json.loads(p.json) for p in q.recentProgress]


def test_upsert_keeps_the_latest_version_whatever_the_order(spark):
    feed, root, ck = Feed(spark), scratch_path(spark, "store"), scratch_path(spark, "ck")
    run = lambda: finish(write_upserts(upsert_stream(feed.stream(), ["version"], "1 hour"), root, "b", ck,
                                       trigger={"availableNow": True}))
    read = lambda: {(r["series_key"], r["time_ns"]): r["value_double"] for r in store.read_points(spark, root, "b").collect()}
    feed.add([("a", 2.0, LO, 2), ("b", 1.0, LO, 1)])
    run()
    feed.add([("a", 1.0, LO, 1), ("b", 3.0, LO, 3), ("b", 2.0, LO, 2)])     # an older version comes later
    run()
    assert read() == {("cpu,host=a", LO): 2.0, ("cpu,host=b", LO): 3.0}
    feed.add([("a", 2.0, LO, 2)])                                           # a replay
    feed.add([("a", 9.0, LO + 7200 * S, 1)])                                # the watermark moves past the first keys
    run()
    feed.add([("b", 8.0, LO, 8), ("a", 10.0, LO + 7200 * S, 2)])
    said = run()
    assert read() == {("cpu,host=a", LO): 2.0, ("cpu,host=b", LO): 3.0, ("cpu,host=a", LO + 7200 * S): 10.0}
    ops = [p["stateOperators"][0] for p in said if p["stateOperators"]]
    assert sum(o["numRowsDroppedByWatermark"] for o in ops) == 1 and ops[-1]["numRowsTotal"] == 1


def test_sessions_of_a_stream_over_restarts(spark):
    feed, out, ck = Feed(spark), scratch_path(spark, "out"), scratch_path(spark, "ck")

    def run():
        return finish(sessions(feed.stream(), "10 seconds", "5 seconds").writeStream.outputMode("append").format("parquet")
                      .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())

    feed.add([("a", 1.0, LO, 0), ("a", 1.0, LO + 9 * S, 0), ("b", 1.0, LO, 0)])
    run()
    feed.add([("a", 1.0, LO + 12 * S, 0), ("b", 1.0, LO + 11 * S, 0)])          # a goes on, b begins again
    run()
    feed.add([("c", 1.0, LO + 100 * S, 0)])                                     # closes all of them
    run()
    feed.add([("a", 1.0, LO + 13 * S, 0)])                                      # too late
    said = run()
    got = sorted((r["series_key"][-1], r["first_ns"], r["last_ns"], r["n_records"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", LO, LO + 12 * S, 3), ("b", LO, LO, 1), ("b", LO + 11 * S, LO + 11 * S, 1)]
    assert sum(o["numRowsDroppedByWatermark"] for p in said for o in p["stateOperators"]) == 1


@pytest.mark.parametrize("gap_ns", [999_999_000, 1_000_000_000, 1_000_001_000])
def test_batch_sessions_and_the_gap_itself(spark, gap_ns):
    pts = versions(spark, [("a", 1.0, LO, 0), ("a", 1.0, LO + gap_ns, 0)])
    assert sessions(pts, "1 second").count() == (1 if gap_ns <= 1_000_000_000 else 2)
    assert sessions(pts.where(F.lit(False)), "1 second").count() == 0
