"""Time slicing and the cursor arithmetic."""

import pytest
from pyspark.sql import functions as F

from chronoline.operators import slices as S


@pytest.mark.parametrize("start,stop,n,expected", [
    (0, 100, 1, [(0, 0, 100)]),
    (0, 100, 4, [(0, 0, 25), (1, 25, 50), (2, 50, 75), (3, 75, 100)]),
    (0, 10, 3, [(0, 0, 3), (1, 3, 6), (2, 6, 10)]),           # remainder to the last
    (5, 5, 3, [(0, 5, 5), (1, 5, 5), (2, 5, 5)]),             # start == stop
    (0, 2, 4, [(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 2)]),  # range < n: all in the last
    (-10, 10, 2, [(0, -10, 0), (1, 0, 10)]),
])
def test_plan_slices(start, stop, n, expected):
    assert S.plan_slices(start, stop, n) == expected


def test_plan_slices_errors():
    with pytest.raises(ValueError, match="greater than zero"):
        S.plan_slices(0, 10, 0)
    with pytest.raises(ValueError, match="start time cannot be greater"):
        S.plan_slices(10, 0, 2)


@pytest.mark.parametrize("lo,hi,n", [(0, 99, 4), (7, 7, 3), (100, 101, 8), (-50, 1234567, 5)])
def test_time_slices_frame_matches_plan(spark, lo, hi, n):
    b = spark.createDataFrame([(lo, hi)], "lo_ns BIGINT, hi_ns BIGINT")
    got = sorted(tuple(r) for r in S.time_slices(b, n).collect())
    assert got == S.plan_slices(lo, hi + 1, n)


def test_time_slices_start_after_stop_raises(spark):
    b = spark.createDataFrame([(10, 0)], "lo_ns BIGINT, hi_ns BIGINT")
    with pytest.raises(Exception, match="start time cannot be greater"):
        S.time_slices(b, 2, stop_inclusive=False).collect()


def test_slice_of_matches_plan(spark):
    lo, hi, n = 3, 1000, 7
    plan = S.plan_slices(lo, hi, n)
    df = spark.range(lo, hi).select(F.col("id").alias("t"))
    rows = df.select("t", S.slice_of("t", lo, hi, n).alias("s")).collect()
    for r in rows:
        i, a, b = plan[r.s]
        assert a <= r.t < b


def _points(spark, times):
    return spark.createDataFrame([(t,) for t in times], "time_ns BIGINT")


def test_incremental_batches_and_tail(spark):
    times = [0, 5, 10, 19, 20, 40]        # hi - lo = 40, a multiple of delta = 10
    pts = _points(spark, times)
    got = {r.batch: (r.batch_start_ns, r.batch_end_ns, r.n_records)
           for r in S.incremental_batches(pts, 10).collect()}
    assert got == {0: (0, 10, 2), 1: (10, 20, 2), 2: (20, 30, 1), 4: (40, 50, 1)}
    # the cursor stops at lo + ceil(40/10)*10 = 40: the record at 40 is held back
    assert [r.time_ns for r in S.tail_held(pts, 10).collect()] == [40]
    assert S.tail_held(pts, 15).count() == 0            # 40 is not a multiple of 15
    assert S.tail_held(_points(spark, [7, 7]), 3).count() == 2   # a single instant


def test_late_rows(spark):
    # arrival batch, time: batch 1 brings a record older than batch 0's max
    df = spark.createDataFrame([(0, 10), (0, 30), (1, 25), (1, 40), (2, 41), (2, 35)],
                               "arrival INT, time_ns BIGINT")
    got = {r.arrival: (r.n_rows, r.cursor_ns, r.n_late)
           for r in S.late_counts(df, "arrival").collect()}
    assert got == {0: (2, None, 0), 1: (2, 31, 1), 2: (2, 41, 1)}
    got = {r.arrival: r.n_late for r in S.late_counts(df, "arrival", lateness_ns=10).collect()}
    assert got == {0: 0, 1: 0, 2: 0}
    assert sorted(r.time_ns for r in S.late_rows(df, "arrival").collect()) == [25, 35]


def test_balanced_bounds_cover_and_balance(spark):
    # skewed time: most records in a narrow band
    times = list(range(0, 1000, 100)) + list(range(5000, 5990))
    pts = _points(spark, times)
    b = sorted(tuple(r) for r in S.balanced_bounds(pts, 4).collect())
    assert b[0][1] == 0 and b[-1][2] == max(times) + 1
    assert all(b[i][2] == b[i + 1][1] for i in range(len(b) - 1))
    counts = [sum(1 for t in times if lo <= t < hi) for _, lo, hi in b]
    assert sum(counts) == len(times)
    assert max(counts) <= len(times) / 4 * 1.3
