"""Streaming sink: line-protocol text (or points) appended to the point store.

``write_stream(df, path=..., bucket=..., checkpoint_location=...)`` starts a
query whose micro-batches go through ``foreachBatch`` into
:func:`chronoline.sources.store.write_batch`:

1. Checks run on the driver before ``start()``: output mode ``append`` only, a
   column named exactly ``value`` of type STRING or BINARY, option values.
2. ``current_timestamp()`` is added to the streaming plan *before*
   ``foreachBatch``; Spark fixes it per batch in the offset log, so a replayed
   batch gets the same default time for lines without one and the same write
   order.
3. In each batch: if batch ``n`` of this query already has a commit record, it
   is skipped (the durable form of the reference's in-memory skip).  Otherwise
   the lines are parsed once (persisted), good points are written to the batch
   directory with ``overwrite`` and committed, and lines that do not decode are
   written to ``_rejects`` with their reason instead of being lost.

The writer id is the streaming query id: the same after a restart from the same
checkpoint, new with a new checkpoint, so batch ids of two runs never collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from chronoline.functions.codec import POINT_COLUMNS, parse_lines, points_from_parsed
from chronoline.functions.nanos import checked_multiply
from chronoline.sources import store
from chronoline.sources.line_files import join_records
from chronoline.sources.options import SinkOptions

_WRITTEN_AT = "_written_at"


def validate_lines_schema(df: DataFrame, column: str = "value") -> None:
    """The input must have a column named exactly ``value`` (case-sensitive) of
    type STRING or BINARY; other columns are allowed and ignored."""
    names = [f.name for f in df.schema.fields]
    # Fixed texts, as callers match on them.
    if column not in names:
        raise ValueError(f"Required attribute '{column}' not found")
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (StringType, BinaryType)):
        raise ValueError(f"{column} attribute unsupported type {dtype.simpleString()}. "
                         f"{column} must be a(n) string or binary")


class PointSinkBatch:
    """The ``foreachBatch`` function of :func:`write_stream`."""

    def __init__(self, opts: SinkOptions, input_kind: str = "lines", column: str = "value",
                 writer: str | None = None, line_breaks: bool = False):
        self.opts = opts
        self.writer = writer    # default: the id of the running query
        self.input_kind = input_kind
        self.column = column
        self.line_breaks = line_breaks

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = self.writer or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not writer:
            raise RuntimeError("no streaming query id: batch ids of two queries could collide")
        o = self.opts
        if store.is_committed(spark, o.path, o.bucket, writer, batch_id):
            return
        default_time = checked_multiply(F.unix_micros(F.col(_WRITTEN_AT)), 1000)
        if self.input_kind == "lines":
            if self.line_breaks:
                batch = join_records(batch, [_WRITTEN_AT])
            parsed = parse_lines(batch, self.column, default_time, o.compat, keep=[_WRITTEN_AT])
            parsed = parsed.persist()
            try:
                pts = points_from_parsed(parsed, keep=[_WRITTEN_AT], compat=o.compat)
                self._write(pts, writer, batch_id)
                rejects = parsed.where(F.col("_reason").isNotNull()).select(
                    F.col("_line").alias("value"), F.col("_reason").alias("reason"),
                    F.col(_WRITTEN_AT).alias("written_at"))
                rdir = store.batch_dir(store.rejects_root(o.path, o.bucket), writer, batch_id)
                if not rejects.isEmpty():       # parsed is persisted: a cheap probe
                    rejects.write.mode("overwrite").parquet(rdir)
                else:
                    store.delete_path(spark, rdir)   # a replay leaves no stale rejects
                self._commit(spark, writer, batch_id)
            finally:
                parsed.unpersist()
        else:
            self._write(batch, writer, batch_id)
            self._commit(spark, writer, batch_id)

    def _write(self, pts: DataFrame, writer: str, batch_id: int) -> None:
        o = self.opts
        stamped = (pts.select(*POINT_COLUMNS, F.col(_WRITTEN_AT).alias("written_at"))
                   .withColumn("seq", F.monotonically_increasing_id()))
        # numPartitions: coalesce (never a shuffle); otherwise rebalance on
        # (measurement, day) so a micro-batch writes a few files per day, not one
        # per input task and day.
        shaped = store.shape_for_write(stamped, o.num_partitions,
                                       cluster_by_time=o.rebalance and o.num_partitions is None)
        store.write_data(shaped, o.path, o.bucket, writer, batch_id, o.batch_size)

    def _commit(self, spark, writer: str, batch_id: int) -> None:
        # Micro-batches share hours, so a proof that one batch's keys are distinct
        # would spare readers nothing.
        store.write_commit(spark, self.opts.path, self.opts.bucket, writer, batch_id, prove_keys=False)


def write_stream(df: DataFrame, path: str, bucket: str, checkpoint_location: str | None = None,
                 output_mode: str = "append", batch_size: int | None = None,
                 num_partitions: int | None = None, compat: bool = False,
                 trigger: dict | None = None, query_name: str | None = None,
                 input_kind: str = "lines", column: str = "value", rebalance: bool = True,
                 line_breaks: bool = False):
    """Start a streaming query that appends ``df`` to the store; returns the
    ``StreamingQuery``.

    ``input_kind='lines'`` (default) takes a ``value`` STRING/BINARY column of
    line-protocol text; ``'points'`` takes long point rows.  ``rebalance``
    (default on) shapes each micro-batch's write into a few files per
    (measurement, day); ``num_partitions`` instead coalesces as the reference
    did.  ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}``).  ``line_breaks`` takes the lines of ``read_line_files(...,
    stream=True)`` and joins records whose quoted strings hold line breaks; a micro-batch
    holds whole files.
    """
    if str(output_mode).lower() != "append":
        # Fixed text, as callers match on it.
        raise ValueError(f"Data source does not support {output_mode} output mode")
    opts = SinkOptions.parse({"path": path, "bucket": bucket, "batchSize": batch_size,
                              "numPartitions": num_partitions, "compat": compat,
                              "rebalance": rebalance})
    if input_kind == "lines":
        validate_lines_schema(df, column)
        place = ["file", "block"] if line_breaks else []
        if line_breaks and (column != "value" or not {*place} <= {*df.columns}):
            raise ValueError("line_breaks needs the columns value, file and block")
        staged = df.select(F.col(column), *place, F.current_timestamp().alias(_WRITTEN_AT))
    elif input_kind == "points":
        missing = [c for c in POINT_COLUMNS if c not in df.columns]
        if missing:
            raise ValueError(f"not a point DataFrame, missing columns {missing}")
        staged = df.select(*POINT_COLUMNS, F.current_timestamp().alias(_WRITTEN_AT))
    else:
        raise ValueError("input_kind must be 'lines' or 'points'")
    w = staged.writeStream.outputMode("append").foreachBatch(PointSinkBatch(
        opts, input_kind, column, line_breaks=line_breaks))
    if checkpoint_location:
        w = w.option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
