"""Stateful operators on streams of points, with Spark's own state store: the upsert
and event-time sessions.  Event time is ``time_ns``; a watermark frees the state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoline.functions.codec import POINT_COLUMNS
from chronoline.functions.nanos import ns_to_timestamp
from chronoline.sources.options import SinkOptions
from chronoline.streaming.sink import _WRITTEN_AT, PointSinkBatch

_EVENT = "_event"
KEY = ["series_key", "field", "time_ns"]


def _timed(points: DataFrame, delay: str) -> DataFrame:
    return points.withColumn(_EVENT, ns_to_timestamp("time_ns")).withWatermark(_EVENT, delay)


def upsert_stream(points: DataFrame, order: list[str], delay: str) -> DataFrame:
    """The latest point of each key (series, field, time) by the ``order`` columns, over
    all micro-batches: for output mode ``update``, which emits a key again whenever its
    latest version may have changed.

    The store alone lets the batch that came last win; here a correction that arrives
    before the point it corrects stays.  Versions are compared by one partial
    aggregation a batch and the state of their keys, one row a key; a key's state goes
    when the watermark (``delay`` behind the newest ``time_ns``) passes its time, and
    versions that arrive after that are dropped and counted by Spark
    (``numRowsDroppedByWatermark``).  A replayed batch changes nothing.  Versions equal
    in ``order`` may any of them be taken; nulls in ``order`` come first.
    """
    rest = [c for c in POINT_COLUMNS if c not in KEY]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("latest")
    out = _timed(points, delay).groupBy(*KEY, _EVENT).agg(latest)
    return out.select(*[F.col(c) if c in KEY else F.col(f"latest.{c}").alias(c) for c in POINT_COLUMNS])


def write_upserts(latest: DataFrame, path: str, bucket: str, checkpoint_location: str,
                  trigger: dict | None = None, query_name: str | None = None):
    """Starts a query that writes :func:`upsert_stream`'s rows to the store, one
    committed batch each; the store's last write is then the latest version."""
    sink = PointSinkBatch(SinkOptions.parse({"path": path, "bucket": bucket}), "points")
    w = (latest.select(*POINT_COLUMNS, F.current_timestamp().alias(_WRITTEN_AT)).writeStream
         .outputMode("update").option("checkpointLocation", checkpoint_location).foreachBatch(sink))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def sessions(points: DataFrame, gap: str, delay: str | None = None, by: list[str] | None = None) -> DataFrame:
    """``by`` (default ``series_key``), ``first_ns, last_ns, n_records``: runs of points
    of a series at most ``gap`` apart, of a batch or (with ``delay``, output mode
    ``append``) of a stream.

    A stream emits a session when the watermark, ``delay`` behind the newest
    ``time_ns``, passes its end; points later than that are dropped and counted by
    Spark.  State is one row for each open session.  Gaps are measured in microseconds.
    """
    by = by or ["series_key"]
    timed = _timed(points, delay) if delay else points.withColumn(_EVENT, ns_to_timestamp("time_ns"))
    return (timed.groupBy(F.session_window(_EVENT, gap).alias("_session"), *by)
            .agg(F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.count(F.lit(1)).alias("n_records"))
            .select(*by, "first_ns", "last_ns", "n_records"))
