"""Writers of the ``linepoints`` format: points appended to the store by
``df.write.format("linepoints")`` and ``df.writeStream.format("linepoints")``.

A task writes its Arrow batches as Parquet below ``_staging/<run>/<attempt>`` and
returns what it wrote: files, and per measurement and hour the times and the number of
rows.  Nobody reads there.  The driver's commit moves the files of the tasks that
succeeded into the batch's directory, then writes the commit record, so a failed,
killed or speculative attempt never shows, and a batch that is run again after a
crash leaves the same store: before the commit record its directory is replaced whole,
after it the second run is thrown away.

The writer id of a stream is the id of its query, read from the checkpoint, as in
:mod:`chronoline.streaming.sink`; batch ids of two queries never collide.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql.datasource import (DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from chronoline.sources.options import SinkOptions, _get
from chronoline.sources.paths import arrow_path, arrow_uri, escape_partition_value

NS_PER_DAY, NS_PER_HOUR = 86_400_000_000_000, 3_600_000_000_000
OPEN_FILES = 64            # measurement and day files that a task holds open
ROWS_PER_GROUP = 131_072


@dataclass
class Staged(WriterCommitMessage):
    """What one task wrote."""
    files: list = field(default_factory=list)    # (path, measurement, day)
    hours: dict = field(default_factory=dict)    # (measurement, day, hour) -> [min, max, rows, most at an instant]


def check_schema(schema) -> None:
    """The input must be long points; other columns are ignored, ``written_at``
    (TIMESTAMP) is taken as the write time if there."""
    from chronoline.sources.store import POINT_SCHEMA
    types = {f.name: f.dataType for f in schema.fields}
    missing = [f.name for f in POINT_SCHEMA.fields if f.name not in types]
    if missing:
        hint = "; decode lines first (chronoline.functions.codec.decode_lines)" if "value" in types else ""
        raise ValueError(f"not points, missing columns {missing}{hint}")
    wrong = [f.name for f in POINT_SCHEMA.fields if types[f.name].simpleString() != f.dataType.simpleString()]
    if "written_at" in types and types["written_at"].simpleString() != "timestamp":
        wrong.append("written_at")
    if wrong:
        raise ValueError(f"columns of another type than points have: {wrong}")


def _staged_batch(rb, seq: int, now, hours: dict):
    """One Arrow batch as it is stored, in time order; ``hours`` is brought up to date."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from chronoline.streaming.source import _point_arrow_schema
    schema = _point_arrow_schema()
    for c in ("measurement", "time_ns"):
        if rb.column(c).null_count:
            raise ValueError(f"a point without {c}")
    n = rb.num_rows
    cols = {f.name: rb.column(f.name).cast(f.type) for f in schema}
    stamp = pa.timestamp("us", tz="UTC")
    cols["written_at"] = (rb.column("written_at").cast(stamp) if "written_at" in rb.schema.names
                          else pa.array([now] * n, stamp))
    cols["seq"] = pa.array(np.arange(seq, seq + n, dtype=np.int64))
    ns = cols["time_ns"].to_numpy(zero_copy_only=False)
    cols["day"] = pa.array((ns // NS_PER_DAY).astype(np.int32)).cast(pa.date32())
    t = pa.table(cols).sort_by([("measurement", "ascending"), ("time_ns", "ascending")])
    at = (pa.table({"m": cols["measurement"], "h": pa.array(ns // NS_PER_HOUR), "t": cols["time_ns"]})
          .group_by(["m", "h", "t"]).aggregate([([], "count_all")])
          .group_by(["m", "h"]).aggregate([("t", "min"), ("t", "max"), ("count_all", "sum"), ("count_all", "max")]))
    for r in at.to_pylist():
        key = (r["m"], r["h"] * NS_PER_HOUR // NS_PER_DAY, r["h"])
        old = hours.get(key)
        new = [r["t_min"], r["t_max"], r["count_all_sum"], r["count_all_max"]]
        # One instant's rows may come in several batches: the sum bounds them.
        hours[key] = new if old is None else [min(old[0], new[0]), max(old[1], new[1]), old[2] + new[2], old[3] + new[3]]
    return t


def stage(batches: Iterator, root: str, run: str, partition: int) -> Staged:
    """Writes a task's batches; memory holds one Arrow batch and a row group of each
    open file."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    from chronoline.streaming.source import _point_arrow_schema
    fs, base = arrow_path(root)
    name = uuid.uuid4().hex
    folder = f"{base}/_staging/{run}/{name}"
    out, now = Staged(), dt.datetime.now(dt.timezone.utc)
    schema = pa.schema([*_point_arrow_schema(), ("written_at", pa.timestamp("us", tz="UTC")),
                        ("seq", pa.int64()), ("day", pa.date32())])

    def rows():
        seq = partition << 33
        for rb in batches:
            if rb.num_rows:
                t = _staged_batch(rb, seq, now, out.hours)
                seq += rb.num_rows
                yield from t.select(schema.names).cast(schema).to_batches()

    def note(f):
        parts = dict(p.split("=", 1) for p in f.path[len(folder):].strip("/").split("/")[:-1])
        out.files.append((f.path, unquote(parts["measurement"]), parts["day"]))

    fs.create_dir(folder, recursive=True)
    try:
        ds.write_dataset(rows(), folder, schema=schema, filesystem=fs, format="parquet",
                         partitioning=ds.partitioning(pa.schema([("measurement", pa.string()), ("day", pa.date32())]), flavor="hive"),
                         basename_template=f"part-{partition:05d}-{name}-{{i}}.parquet", file_visitor=note,
                         max_open_files=OPEN_FILES, max_rows_per_group=ROWS_PER_GROUP, max_partitions=1 << 20)
    except BaseException:
        fs.delete_dir(folder)
        raise
    return out


def _delete(fs, path: str) -> None:
    fs.delete_dir_contents(path, missing_dir_ok=True)
    import pyarrow.fs as pafs
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)


def commit_batch(messages: list, root: str, run: str, writer: str, batch_id: int) -> bool:
    """Makes the staged files batch ``batch_id`` of ``writer``; False where it is
    committed already.  Files are moved, not copied, where the file system can."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, base = arrow_path(root)
    data = f"{base}/data/writer={writer}/batch_id={int(batch_id)}"
    commit = f"{base}/_commits/writer={writer}/batch_id={int(batch_id)}"
    done = fs.get_file_info(f"{commit}/_SUCCESS").type != pafs.FileType.NotFound
    if not done:
        _delete(fs, commit)
        _delete(fs, data)
        made, hours = set(), {}
        for m in messages:
            for path, measurement, day in m.files if m else ():
                folder = f"{data}/measurement={escape_partition_value(measurement)}/day={day}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                fs.move(path, f"{folder}/{posixpath.basename(path)}")
            for key, (lo, hi, n, most) in (m.hours if m else {}).items():
                old = hours.setdefault(key, [lo, hi, 0, 0])
                hours[key] = [min(old[0], lo), max(old[1], hi), old[2] + n, old[3] + most]
        keys = sorted(hours)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys],
                   *[[hours[k][i] for k in keys] for i in range(4)], [None] * len(keys)]
        names = ["measurement", "day", "hour", "min_ns", "max_ns", "n_records", "max_at_instant", "n_keys"]
        types = [pa.string(), pa.int32(), *[pa.int64()] * 6]
        t = pa.table([pa.array(c, ty) for c, ty in zip(columns, types)], names=names)
        t = t.set_column(1, "day", t["day"].cast(pa.date32()))
        fs.create_dir(commit, recursive=True)
        # Complete under a name that readers skip, then in one step under its own.
        pq.write_table(t, f"{commit}/_part-0.parquet", filesystem=fs)
        fs.move(f"{commit}/_part-0.parquet", f"{commit}/part-0.parquet")
        fs.open_output_stream(f"{commit}/_SUCCESS").close()
    _delete(fs, f"{base}/_staging/{run}")
    return not done


def query_id(checkpoint: str, store_path: str) -> str:
    """The id of the streaming query that owns a checkpoint.  A location without a
    scheme is on the store's file system."""
    if ":" not in checkpoint.split("/", 1)[0]:
        scheme, _, rest = store_path.partition(":")
        host = rest[2:].split("/", 1)[0] if rest.startswith("//") else ""
        checkpoint = f"{scheme}://{host}{checkpoint}" if scheme != "file" else f"file:{checkpoint}"
    fs, path = arrow_path(checkpoint)
    with fs.open_input_stream(f"{path}/metadata") as f:
        return json.loads(f.read().decode())["id"]


class _Points:
    """What both writers share; made on the driver and sent to the tasks."""

    def __init__(self, options: dict, schema, run: str, writer: str | None):
        check_schema(schema)
        o = SinkOptions.parse(options)
        arrow_uri(o.path)     # a path of no scheme is an error
        self.path, self.root, self.run, self.writer = o.path, f"{o.path.rstrip('/')}/{o.bucket}", run, writer

    def write(self, iterator) -> Staged:
        from pyspark import TaskContext
        context = TaskContext.get()
        return stage(iterator, self.root, self.run, context.partitionId() if context else 0)

    def _drop(self) -> None:
        fs, base = arrow_path(self.root)
        _delete(fs, f"{base}/_staging/{self.run}")


class PointsWriter(_Points, DataSourceArrowWriter):
    """``df.write.format("linepoints").mode("append").save()``: one committed batch."""

    def __init__(self, options: dict, schema, overwrite: bool):
        if overwrite:
            raise ValueError("points are appended only; mode overwrite is not supported")
        run = uuid.uuid4().hex
        super().__init__(options, schema, run, _get(options, "writer") or f"batch-{run}")

    def commit(self, messages) -> None:
        if not commit_batch(messages, self.root, self.run, self.writer, 0):
            raise ValueError(f"writer {self.writer!r} has written to this store already")

    def abort(self, messages) -> None:
        self._drop()


class PointsStreamWriter(_Points, DataSourceStreamArrowWriter):
    """``df.writeStream.format("linepoints")``: each micro-batch is one committed batch."""

    def __init__(self, options: dict, schema, overwrite: bool):
        if overwrite:
            raise ValueError("points are appended only; use output mode append")
        SinkOptions.parse(options)
        self.checkpoint, writer = _get(options, "checkpointLocation"), _get(options, "writer")
        if not (self.checkpoint or writer):
            raise ValueError("Option 'checkpointLocation' or 'writer' is required")
        # The same after a restart, so that the next commit clears what a crash left.
        run = hashlib.sha256(f"{writer}\0{self.checkpoint}".encode()).hexdigest()[:32]
        super().__init__(options, schema, run, writer)

    def commit(self, messages, batchId: int) -> None:
        writer = self.writer or query_id(self.checkpoint, self.path)
        commit_batch(messages, self.root, self.run, writer, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._drop()
