"""Time slices and the incremental event-time cursor, in batch form.

The stream reader (``chronoline.streaming.source``) reads each micro-batch
``[start, end)`` as ``n`` equal-width time slices, one Spark partition each.
This module gives the same arithmetic as DataFrame operators so that it can be
checked against SQL and used on stored points:

* :func:`plan_slices` -- the slice bounds of one range (driver-side, O(n)).
* :func:`time_slices` -- the same as a DataFrame, derived from the data's bounds.
* :func:`slice_of` / :func:`slice_counts` -- which slice each record lands in.
* :func:`incremental_batches` / :func:`tail_held` -- what a cursor that moves a
  fixed delta per trigger reads in each batch, and what it leaves behind.
* :func:`late_rows` -- records older than the cursor when they arrive.
* :func:`balanced_bounds` -- count-balanced slice bounds for skewed time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoline.functions.nanos import floor_div

LONG_MIN = -(2 ** 63)

# Fixed texts, as callers match on them.
NO_SLICES = "The time slice number must be greater than zero!"
BACKWARDS = "The start time cannot be greater than the end time!"


def plan_slices(start: int, stop: int, n: int) -> list[tuple[int, int, int]]:
    """``[(slice_id, start_ns, stop_ns)]`` of ``[start, stop)`` in ``n`` slices.

    Equal width ``(stop - start) // n``, the last slice takes the remainder,
    bounds contiguous.  ``n < 1`` or ``start > stop`` is an error.  A range
    narrower than ``n`` gives zero-width slices and puts all of it in the last.
    """
    if n < 1:
        raise ValueError(NO_SLICES)
    if start > stop:
        raise ValueError(BACKWARDS)
    if n == 1:
        return [(0, start, stop)]
    width = (stop - start) // n
    out = []
    for i in range(n):
        lo = start + i * width
        hi = stop if i == n - 1 else lo + width
        out.append((i, lo, hi))
    return out


def _check_n(n: int) -> None:
    if n < 1:
        raise ValueError(NO_SLICES)


def data_bounds(points: DataFrame) -> DataFrame:
    """One row ``lo_ns, hi_ns`` = min and max ``time_ns`` (partial aggregation)."""
    return points.agg(F.min("time_ns").alias("lo_ns"), F.max("time_ns").alias("hi_ns"))


def time_slices(bounds: DataFrame, n: int, start_col: str = "lo_ns",
                stop_col: str = "hi_ns", stop_inclusive: bool = True) -> DataFrame:
    """Slices of a one-row ``bounds`` DataFrame as rows ``slice_id, start_ns, stop_ns``.

    The range is ``[start, stop + 1)`` when ``stop_inclusive`` (a max time), so the
    last record falls inside.  The slice rows come from ``sequence`` + ``explode``
    on the bounds row: no join and nothing collected.
    """
    _check_n(n)
    lo = F.col(start_col)
    hi = F.col(stop_col) + F.lit(1) if stop_inclusive else F.col(stop_col)
    width = F.call_function("div", hi - lo, F.lit(n).cast("bigint"))
    rows = bounds.select(lo.alias("_lo"), hi.alias("_hi"), width.alias("_w"),
                         F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slice_id"))
    start = F.col("_lo") + F.col("slice_id").cast("bigint") * F.col("_w")
    stop = F.when(F.col("slice_id") == n - 1, F.col("_hi")).otherwise(start + F.col("_w"))
    checked = F.when(F.col("_lo") > F.col("_hi"),
                     F.raise_error(F.lit(BACKWARDS))
                     ).otherwise(start)
    return rows.select(F.col("slice_id").cast("int").alias("slice_id"),
                       checked.cast("bigint").alias("start_ns"), stop.cast("bigint").alias("stop_ns"))


def slice_of(t, start, stop, n: int) -> Column:
    """Slice index of time ``t`` in ``[start, stop)`` cut in ``n`` slices:
    ``least((t - start) div width, n - 1)``; a zero width puts everything in the
    last slice, as the slice plan does."""
    _check_n(n)
    t = F.col(t) if isinstance(t, str) else t
    a = start if isinstance(start, Column) else F.lit(int(start)).cast("bigint")
    b = stop if isinstance(stop, Column) else F.lit(int(stop)).cast("bigint")
    width = F.call_function("div", b - a, F.lit(n).cast("bigint"))
    idx = F.when(width == 0, F.lit(n - 1).cast("bigint")).otherwise(
        F.least(F.call_function("div", t - a, width), F.lit(n - 1).cast("bigint")))
    return idx.cast("int")


def slice_counts(points: DataFrame, start: int, stop: int, n: int) -> DataFrame:
    """Records per slice of ``[start, stop)``: ``slice_id, n_records, first_ns, last_ns``.

    Records outside the range are not counted.  One hash aggregation on a
    handful of keys: every task pre-aggregates, the shuffle carries ``n`` rows
    per task.
    """
    sel = points.where((F.col("time_ns") >= F.lit(start)) & (F.col("time_ns") < F.lit(stop)))
    return (sel.select(slice_of("time_ns", start, stop, n).alias("slice_id"), "time_ns")
            .groupBy("slice_id")
            .agg(F.count(F.lit(1)).alias("n_records"), F.min("time_ns").alias("first_ns"),
                 F.max("time_ns").alias("last_ns")))


def balanced_bounds(points: DataFrame, n: int, accuracy: int = 10000) -> DataFrame:
    """Count-balanced slices for skewed time: ``slice_id, start_ns, stop_ns``.

    Cut points are ``percentile_approx`` quantiles of ``time_ns`` (a mergeable
    sketch, aggregated map-side; size set by ``accuracy``, not by the data).
    The first slice starts at the minimum, the last ends after the maximum;
    repeated cut points (a time holding more than 1/n of the records) give
    zero-width slices that a reader skips.
    """
    _check_n(n)
    if n == 1:
        qs = F.array().cast("array<bigint>")
    else:
        qs = F.percentile_approx("time_ns", [i / n for i in range(1, n)], accuracy)
    b = points.agg(F.min("time_ns").alias("_lo"), F.max("time_ns").alias("_hi"), qs.alias("_q"))
    edges = b.select(F.concat(F.array(F.col("_lo")), F.col("_q").cast("array<bigint>"),
                              F.array(F.col("_hi") + F.lit(1))).alias("_e"))
    return edges.select(F.posexplode(F.slice(F.col("_e"), 1, n)).alias("slice_id", "start_ns"),
                        "_e").select(
        F.col("slice_id").cast("int").alias("slice_id"), "start_ns",
        F.element_at("_e", F.col("slice_id") + 2).alias("stop_ns"))


# --------------------------------------------------------------------------- cursor


def incremental_batches(points: DataFrame, delta_ns: int, lo: int | None = None) -> DataFrame:
    """What a cursor starting at ``lo`` (default: the minimum time) and moving
    ``delta_ns`` per batch reads: batch ``k`` covers ``[lo + k*delta, lo + (k+1)*delta)``.

    Rows ``batch, batch_start_ns, batch_end_ns, n_records, first_ns, last_ns``.
    ``lo`` None takes the minimum with a tiny aggregate first (one long to the
    driver), then one hash aggregation keyed by batch index.
    """
    if delta_ns < 1:
        raise ValueError("delta must be at least 1 ns")
    if lo is None:
        lo = points.agg(F.min("time_ns")).first()[0]
        if lo is None:
            lo = 0
    idx = floor_div(F.col("time_ns") - F.lit(int(lo)).cast("bigint"), int(delta_ns))
    agg = (points.where(F.col("time_ns") >= F.lit(int(lo)))
           .select(idx.alias("batch"), "time_ns")
           .groupBy("batch")
           .agg(F.count(F.lit(1)).alias("n_records"), F.min("time_ns").alias("first_ns"),
                F.max("time_ns").alias("last_ns")))
    start = F.lit(int(lo)).cast("bigint") + F.col("batch") * F.lit(int(delta_ns)).cast("bigint")
    return agg.select("batch", start.alias("batch_start_ns"),
                      (start + F.lit(int(delta_ns))).alias("batch_end_ns"),
                      "n_records", "first_ns", "last_ns")


def tail_held(points: DataFrame, delta_ns: int) -> DataFrame:
    """Records the reference's cursor rule never reads while no newer record
    arrives: those at or after ``lo + ceil((hi - lo) / delta) * delta``.

    The cursor only moves while the maximum time is strictly above it and the
    range end is exclusive, so when ``hi - lo`` is a multiple of ``delta`` (a
    single instant included) the records at ``hi`` stay behind.  Bounds come
    from one tiny aggregate (two longs to the driver), then a pushed-down filter.
    """
    if delta_ns < 1:
        raise ValueError("delta must be at least 1 ns")
    row = points.agg(F.min("time_ns"), F.max("time_ns")).first()
    lo, hi = row[0], row[1]
    if lo is None:
        return points.limit(0)
    return points.where(F.col("time_ns") >= F.lit(cursor_end(lo, hi, delta_ns)))


def cursor_end(lo: int, hi: int, delta_ns: int) -> int:
    """Where the reference's cursor stops for data in ``[lo, hi]``."""
    return lo + -(-(hi - lo) // delta_ns) * delta_ns


def arrival_cursors(points: DataFrame, arrival: str, lateness_ns: int = 0) -> DataFrame:
    """Per arrival batch: ``cursor_ns`` the stream reader holds when the batch
    arrives -- the highest time of all earlier batches + 1 - lateness (never
    lower than an earlier cursor); null for the first batch.

    One row per batch (pre-aggregated), then a running max over those few rows.
    """
    per_batch = points.groupBy(arrival).agg(F.max("time_ns").alias("_max"),
                                            F.count(F.lit(1)).alias("n_rows"))
    # One row per micro-batch: a small table; the unpartitioned window is fine here.
    w = Window.orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return per_batch.select(
        arrival, "n_rows",
        (F.max("_max").over(w) + F.lit(1) - F.lit(int(lateness_ns))).alias("cursor_ns"))


def late_rows(points: DataFrame, arrival: str, lateness_ns: int = 0) -> DataFrame:
    """Records whose time is below the cursor of their arrival batch (never read
    by an event-time cursor).  Joins the per-batch cursor table back on the batch
    key; AQE sees its real size at run time and broadcasts it when it is small."""
    cur = arrival_cursors(points, arrival, lateness_ns).select(arrival, "cursor_ns")
    return (points.join(cur, arrival)
            .where(F.col("cursor_ns").isNotNull() & (F.col("time_ns") < F.col("cursor_ns"))))


def late_counts(points: DataFrame, arrival: str, lateness_ns: int = 0) -> DataFrame:
    """Per arrival batch: ``n_rows``, ``cursor_ns``, ``n_late``.

    The per-batch cursor table (one row per batch) joins back on the batch key,
    then one hash aggregation counts; AQE broadcasts the cursor table when its
    measured size is small and keeps a shuffle join when it is not.
    """
    cur = arrival_cursors(points, arrival, lateness_ns).select(arrival, "cursor_ns")
    late = F.when(F.col("cursor_ns").isNotNull() & (F.col("time_ns") < F.col("cursor_ns")), 1)
    return (points.join(cur, arrival)
            .groupBy(arrival, "cursor_ns")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.coalesce(F.sum(late), F.lit(0)).cast("bigint").alias("n_late"))
            .select(arrival, "n_rows", "cursor_ns", "n_late"))
