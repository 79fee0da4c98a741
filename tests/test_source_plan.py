"""Driver-side planning of the stream reader, without Spark."""

import random

import pyarrow as pa
import pyarrow.dataset

from chronoline.sources.options import SourceOptions
from chronoline.sources.paths import escape_partition_value
from chronoline.streaming.source import (BatchRange, TimeSlicePartition, arrow_uri, balanced_cuts, key_buckets,
                                         plan_partitions)


def _opts(**kw):
    base = {"path": "/x", "bucket": "b", "measurement": "m", "numSlices": "4"}
    base.update({k: str(v) for k, v in kw.items()})
    return SourceOptions.parse(base)


def test_plan_covers_range_once_and_prunes_batches():
    batches = [BatchRange("w", 0, 0, 99, 100, 1), BatchRange("w", 1, 200, 299, 100, 1)]
    parts = plan_partitions(batches, 0, 300, _opts(), "/x/b/data")
    spans = sorted((p.start_ns, p.stop_ns) for p in parts)
    assert spans[0][0] == 0 and spans[-1][1] == 300
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for p in parts:   # each slice reads only the batches overlapping it
        for _, bid, _ in p.batches:
            lo, hi = (0, 99) if bid == 0 else (200, 299)
            assert hi >= p.start_ns and lo < p.stop_ns


def test_empty_and_backwards_ranges_plan_nothing():
    b = [BatchRange("w", 0, 0, 99, 100, 1)]
    assert plan_partitions(b, 50, 50, _opts(), "/d") == []
    assert plan_partitions(b, 60, 50, _opts(), "/d") == []
    assert plan_partitions(b, 500, 600, _opts(), "/d") == []


def test_more_slices_when_rows_exceed_budget():
    b = [BatchRange("w", 0, 0, 999, 10_000, 10)]
    parts = plan_partitions(b, 0, 1000, _opts(maxRowsPerSlice=1000), "/d")
    assert len(parts) == 10


def test_balanced_cuts_follow_the_rows():
    b = [BatchRange("w", 0, 0, 99, 100, 1), BatchRange("w", 1, 1000, 1009, 900, 1)]
    cuts = balanced_cuts(b, 0, 1010, 4)
    assert cuts == sorted(cuts) and all(c >= 1000 for c in cuts)


def test_key_buckets_deterministic_and_spread():
    keys = [f"m,host=h{i}" for i in range(4000)]
    a = key_buckets(pa.array(keys), 4)
    b = key_buckets(pa.chunked_array([keys[:1000], keys[1000:]]), 4)
    assert list(a) == list(b)
    counts = [int((a == j).sum()) for j in range(4)]
    assert min(counts) > 800


def test_escape_partition_value():
    assert escape_partition_value("events") == "events"
    assert escape_partition_value('a:b/c=d%"#') == "a%3Ab%2Fc%3Dd%25%22%23"
    assert escape_partition_value("x\x02y") == "x%02y"


def test_hot_hour_is_cut_by_time():
    """720 hours, one of them with 200 million rows: no slice above the budget, with
    either balance, with or without dedupe."""
    hour = 3_600_000_000_000
    b = [BatchRange("w", 0, h * hour, (h + 1) * hour - 1, 200_000_000 if h == 300 else 10_000, 1, h // 24)
         for h in range(720)]
    for balance in ("time", "count"):
        for dedupe in ("true", "false"):
            parts = plan_partitions(b, 0, 720 * hour, _opts(balance=balance, dedupe=dedupe), "/d")
            spans = sorted((p.start_ns, p.stop_ns) for p in parts)
            assert spans[0][0] == 0 and spans[-1][1] == 720 * hour
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
            hot = [min(q, 301 * hour) - max(p, 300 * hour) for p, q in spans if p < 301 * hour and q > 300 * hour]
            assert max(hot) / hour * 200_000_000 <= 2_000_001
            assert len(parts) < 210
            assert all(days == sorted({d for _, _, ds in [p.batches[0]] for d in ds}) for p in parts
                       for _, _, days in p.batches)


def test_planning_many_commits_is_fast():
    import time
    hour = 3_600_000_000_000
    b = [BatchRange(f"w{i}", 0, i * hour // 50, i * hour // 50 + hour, 1000, 1, i // 1200) for i in range(40_000)]
    t = time.time()
    cuts = balanced_cuts(b, 0, 801 * hour, 64)
    assert len(cuts) == 63 and cuts == sorted(cuts) and time.time() - t < 1


def test_arrow_names_of_cluster_paths():
    import pytest
    assert arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b"
    assert arrow_uri("wasbs://c@acc.blob.core.windows.net/x") == "abfss://c@acc.blob.core.windows.net/x"
    assert arrow_uri("hdfs://nn:8020/x") == "hdfs://nn:8020/x"
    assert arrow_uri("gs://b/x") == "gs://b/x"
    assert arrow_uri("dbfs:/x/y") == "file:///dbfs/x/y"
    assert arrow_uri("file:/x") == "file:/x"
    for bare in ("/x/y", "x/y"):
        with pytest.raises(ValueError):
            arrow_uri(bare)


def test_a_slice_is_read_in_steps(tmp_path, monkeypatch):
    """Long slices are held a step at a time; files overlap, repeat keys, and one is not sorted."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from chronoline.streaming import source

    monkeypatch.setattr(source, "CHUNK_ROWS", 50, raising=False)
    monkeypatch.setattr(source, "STEP_ROWS", 200, raising=False)
    rng, want, n = random.Random(3), {}, 3000

    def write(batch, times):
        folder = tmp_path / f"data/writer=w/batch_id={batch}/measurement=m/day=1970-01-01"
        folder.mkdir(parents=True)
        rows = [(t, f"m,h={i % 3}", batch * 10_000.0 + i) for i, t in enumerate(times)]
        for t, k, v in rows:
            if 100 <= t < 2900:
                want[t, k] = v
        cols = list(zip(*rows))
        pq.write_table(pa.table({
            "tags": pa.array([[("h", "x")]] * len(rows), pa.map_(pa.string(), pa.string())), "field": ["v"] * len(rows),
            "value_double": cols[2], "value_long": pa.array([None] * len(rows), pa.int64()),
            "value_bool": pa.array([None] * len(rows), pa.bool_()), "value_string": pa.array([None] * len(rows), pa.string()),
            "time_ns": pa.array(cols[0], pa.int64()), "series_key": cols[1],
            "written_at": pa.array([batch] * len(rows), pa.timestamp("us", "UTC")), "seq": list(range(len(rows)))}),
            folder / "part-0.parquet", row_group_size=700)

    write(0, sorted(rng.randrange(n) for _ in range(n)))
    write(1, sorted(rng.randrange(n) for _ in range(n)))
    p = TimeSlicePartition(0, 100, 2900, "m", f"file:{tmp_path}/data", [("w", 0, [0]), ("w", 1, [0])])
    whole = list(source.read_slice(p))
    assert max(rb.num_rows for rb in whole) <= 400               # before: one table of the whole slice
    write(2, [rng.randrange(n) for _ in range(n)])               # not sorted
    for more, buckets in ((None, 1), (None, 3), ("m,h=1", 1)):
        flt = None if more is None else pa.dataset.field("series_key") == more
        p = [TimeSlicePartition(0, 100, 2900, "m", f"file:{tmp_path}/data", [("w", b, [0]) for b in range(3)], True, j, buckets)
             for j in range(buckets)]
        rows = [r for x in p for rb in source.read_slice(x, flt) for r in rb.to_pylist()]
        got = {(r["time_ns"], r["series_key"]): r["value_double"] for r in rows}
        assert len(rows) == len(got) and got == {k: v for k, v in want.items() if more in (None, k[1])}
    p = TimeSlicePartition(0, 100, 2900, "m", f"file:{tmp_path}/data", [("w", 0, [0]), ("w", 1, [0])], False)
    assert sum(rb.num_rows for rb in source.read_slice(p, None, ["value_double"])) > sum(rb.num_rows for rb in whole)
