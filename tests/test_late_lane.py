"""The late lane: every committed record is delivered once, whenever it is committed."""

import json
import os
import random

from chronoline.operators.points import to_points
from chronoline.session import scratch_path
from chronoline.sources import store
from chronoline.streaming.source import CursorStreamReader, drain, read_stream

S = 1_000_000_000
LO = 1_700_000_000 * S


def write(spark, root, times, writer=None):
    df = spark.createDataFrame([("a", float(t), t) for t in times], "host STRING, v DOUBLE, t BIGINT")
    store.write_points(to_points(df, "cpu", ["host"], ["v"], "t"), root, "b", writer=writer)


def start(spark, root, out, ck, **options):
    return (read_stream(spark, root, "b", "cpu", output="points", late="read", **options).select("time_ns")
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
            .trigger(availableNow=True).start())


def test_every_record_once_over_restarts(spark):
    rng = random.Random(11)
    root, out, ck = scratch_path(spark, "store"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    left = [LO + k * S for k in rng.sample(range(20_000), 200)]
    want = []
    for n in (60, 1, 80, 59):
        write(spark, root, left[:n])
        want, left = want + left[:n], left[n:]
        drain(lambda: start(spark, root, out, ck))
        assert sorted(r[0] for r in spark.read.parquet(out).collect()) == sorted(want)
    drain(lambda: start(spark, root, out, ck))                   # nothing new
    assert spark.read.parquet(out).count() == 200


def test_late_lane_with_capped_steps_and_lateness(spark):
    root, out, ck = scratch_path(spark, "store"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    step = {"maxDeltaPerTrigger": 7_200_000, "lateness": 1000}
    write(spark, root, [LO + k * 3600 * S for k in range(0, 10, 2)])
    start(spark, root, out, ck, **step).awaitTermination()       # one step: the cursor is inside
    write(spark, root, [LO + k * 3600 * S for k in range(1, 10, 2)] + [LO - 5 * S])
    drain(lambda: start(spark, root, out, ck, **step))
    write(spark, root, [LO + 9 * 3600 * S + 2 * S])              # moves the held back newest
    drain(lambda: start(spark, root, out, ck, **step))
    want = sorted([LO + k * 3600 * S for k in range(10)] + [LO - 5 * S])
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == want


def test_a_replayed_batch_reads_the_same_records(spark):
    """What was committed after a batch's offsets were fixed is not in the batch."""
    root, out, ck = scratch_path(spark, "store"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    write(spark, root, [LO, LO + 4 * S])
    start(spark, root, out, ck).awaitTermination()
    folder = f"{ck}/commits".removeprefix("file:")
    last = max(int(x) for x in os.listdir(folder) if x.isdigit())
    for f in (f"{folder}/{last}", f"{folder}/.{last}.crc"):      # the batch is run again ...
        if os.path.exists(f):
            os.remove(f)
    write(spark, root, [LO + S])                                 # ... after this was committed
    drain(lambda: start(spark, root, out, ck))
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == [LO, LO + S, LO + 4 * S]


def test_offsets_are_a_vector_only_when_asked(spark):
    root = scratch_path(spark, "store")
    write(spark, root, [LO], writer="w1")
    path = root.removeprefix("file:")
    o = {"path": path, "bucket": "b", "measurement": "cpu"}
    assert "marks" not in CursorStreamReader(o).latestOffset()
    r = CursorStreamReader({**o, "late": "read"})
    first, end = r.initialOffset(), r.latestOffset()
    assert first["marks"] == {} and end["marks"] == {"w1": 0} and json.dumps(end) == json.dumps(r.latestOffset())
    write(spark, root, [LO - 3600 * S], writer="w0")
    after = r.latestOffset()
    assert after["ns"] == end["ns"] and after["marks"] == {"w0": 0, "w1": 0}
    parts = r.partitions(end, after)
    assert [b for p in parts for b in p.batches] == [("w0", 0, [19675])] and all(p.stop_ns <= LO for p in parts)
    assert sum(len(p.batches) for p in r.partitions(first, end)) == 1
