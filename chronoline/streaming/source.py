"""Streaming source ``linepoints``: one measurement of the point store read as an
event-time cursor that moves forward in nanoseconds.

Offsets are ``{"ns": <cursor>, "late": <rows>, "late_maybe": <rows>, ...}``.  Each micro-batch ``[start, end)`` is cut into
``numSlices`` time slices, equally wide or (``balance=count``) of equal estimated
rows; a slice estimated above ``maxRowsPerSlice`` rows is cut further, so a crowded
hour is many slices whatever the balance.  A slice is one Spark partition; it reads
only the committed batches and days that overlap it, with the measurement, day and
time bounds pushed into the Parquet scan, and yields Arrow record batches (no
per-row Python).  Days that a commit names must be there: a missing one is an error,
never an empty slice.

Cursor rules (``end`` of the next batch):

* default -- ``end = max(cursor, max_time + 1 - lateness)``: everything stored up
  to now is read (the record at the maximum too), ``lateness`` holds back the
  newest ``lateness`` ms for writers still catching up.  ``maxDeltaPerTrigger``
  caps a batch at that much event time, jumping over empty gaps.
* ``compat=true`` -- the reference's rule: the first offset is the minimum time
  (nothing read), then the cursor moves exactly ``delta-time`` ms per trigger
  while the maximum time is above it.

Records that arrive with a time below the cursor are late.  With ``late=read`` they have
a lane of their own: the offset is then a vector, the cursor and for each writer the
last batch that the stream knows (``marks``).  A micro-batch reads ``[start, end)`` of
the batches that ``end`` knows, and of those that ``start`` did not know also what lies
below ``start``.  So every committed record is read once, whenever it comes, and the
same offsets always mean the same records.  The vector has one entry for each writer of
the measurement (a streaming query, or one ``write_points``).

With ``late=count`` (the default, and the reference's loss) no later batch reads them.
The stream says so: ``late`` in its offsets (``lastProgress`` of the
query, and the checkpoint) is the number of records so far in hours that lay wholly
below the cursor when they were committed, ``late_maybe`` the number in hours that
the cursor divided.  Use ``order=arrival`` in :func:`read_stream` when every record
must be read whatever its time.

Planning reads only the commit records (one small row per batch) on the driver;
``read`` runs on executors with no SparkSession.
"""

from __future__ import annotations

import math
import posixpath
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from chronoline.operators.slices import LONG_MIN, plan_slices
from chronoline.sources.options import SourceOptions
from chronoline.sources.paths import arrow_path, arrow_uri, escape_partition_value

NS_PER_DAY = 86_400_000_000_000
LONG_MAX = 2**63 - 1
CHUNK_ROWS = 16_384        # rows of a file that are decoded at once
STEP_ROWS = 65_536         # rows of a slice that are sorted at once, about

POINT_DDL = ("measurement STRING, tags MAP<STRING, STRING>, field STRING, value_double DOUBLE, "
             "value_long BIGINT, value_bool BOOLEAN, value_string STRING, time_ns BIGINT, "
             "series_key STRING")
_POINT_COLS = ["measurement", "tags", "field", "value_double", "value_long", "value_bool",
               "value_string", "time_ns", "series_key"]


# --------------------------------------------------------------------------- files (pyarrow)


def qualified(spark, path: str) -> str:
    """``path`` with scheme and authority, as Spark's own readers resolve it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _commit_schema():
    """The columns of commit records that plan a read; older records lack some."""
    import pyarrow as pa
    return pa.schema([("measurement", pa.string()), *((c, pa.int64()) for c in (
        "min_ns", "max_ns", "n_records", "max_at_instant")), ("time_knots", pa.list_(pa.int64()))])


def _store_roots(path: str, bucket: str) -> tuple[str, str]:
    root = f"{path.rstrip('/')}/{bucket}"
    return f"{root}/data", f"{root}/_commits"


@dataclass(frozen=True)
class BatchRange:
    writer: str
    batch_id: int
    min_ns: int
    max_ns: int
    n_records: int
    max_at_instant: int = 0
    day: int = 0               # days since 1970 of the rows' directory
    knots: tuple = ()          # times that cut the rows into equal parts, ends included


def list_commits(path: str, bucket: str, measurement: str,
                 cache: dict | None = None) -> list[BatchRange]:
    """Committed hours (``_SUCCESS`` present) of the batches holding ``measurement``.

    Commit records never change once written, so with a ``cache`` (file path ->
    rows) only files not seen before are read.  Each trigger then costs one listing
    plus the new commits, not a read of every commit ever made.  A bucket that does
    not exist is an error; one without commits is empty."""
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    _, croot = _store_roots(path, bucket)
    fs, root = arrow_path(croot)
    if fs.get_file_info(posixpath.dirname(root)).type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no point store at {path}, bucket {bucket}")
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    done = {posixpath.dirname(i.path) for i in infos if i.base_name == "_SUCCESS"}
    files = [i.path for i in infos
             if i.type == pafs.FileType.File and posixpath.dirname(i.path) in done
             and not i.base_name.startswith(("_", "."))]
    cache = {} if cache is None else cache
    for f in files:
        if f in cache:
            continue
        parts = dict(seg.split("=", 1) for seg in f[len(root):].strip("/").split("/")[:-1]
                     if "=" in seg)
        t = ds.dataset([f], schema=_commit_schema(), filesystem=fs, format="parquet").to_table(
            filter=ds.field("measurement") == measurement)
        cols = (t[c].to_pylist() for c in ("min_ns", "max_ns", "n_records", "max_at_instant", "time_knots"))
        cache[f] = [BatchRange(parts["writer"], int(parts["batch_id"]), lo, hi, n, most or n, lo // NS_PER_DAY,
                               tuple(knots or ())) for lo, hi, n, most, knots in zip(*cols)]
    return [br for rows in cache.values() for br in rows]


# --------------------------------------------------------------------------- partitions


@dataclass
class TimeSlicePartition(InputPartition):
    slice_id: int
    start_ns: int
    stop_ns: int
    measurement: str
    data_root: str
    batches: list = field(default_factory=list)   # [(writer, batch_id, days)]
    dedupe: bool = True
    key_bucket: int = 0                            # this task's share of the keys ...
    n_buckets: int = 1                             # ... when one instant is too big


def _row_curve(batches: list[BatchRange], a: int, b: int):
    """Times from ``a`` to ``b``, and the estimated rows before each: a commit row's
    records lie evenly between neighbouring knots, without knots between its first and
    last time.  One sort of all their edges."""
    import numpy as np
    plain = [r for r in batches if len(r.knots) < 2]
    lo = [np.array([r.min_ns for r in plain], np.int64)]
    hi = [np.array([r.max_ns for r in plain], np.int64) + 1]
    n = [np.array([r.n_records for r in plain], np.float64)]
    for r in batches:
        if len(r.knots) >= 2:
            at = np.array(r.knots, np.int64)
            lo.append(at[:-1])
            # A part of one instant; the last part ends behind its time.
            hi.append(np.maximum(at[1:], at[:-1] + 1))
            hi[-1][-1] = at[-1] + 1
            n.append(np.full(len(at) - 1, r.n_records / (len(at) - 1)))
    lo, hi, n = np.concatenate(lo), np.concatenate(hi), np.concatenate(n)
    rate = n / (hi - lo)
    at = np.concatenate([lo, hi, [a, b]])
    change = np.concatenate([rate, -rate, [0.0, 0.0]])
    order = np.argsort(at, kind="stable")
    at, density = at[order], np.maximum(np.cumsum(change[order]), 0)
    rows = np.concatenate([[0.0], np.cumsum(density[:-1] * np.diff(at))])
    inside = (at >= a) & (at <= b)
    at, rows = at[inside], rows[inside]
    return at, rows - rows[0]


def _times_at(at, rows, want):
    """The times before which ``want`` rows lie, to the nanosecond."""
    import numpy as np
    i = np.clip(np.searchsorted(rows, want, side="left"), 1, len(rows) - 1)
    gap = rows[i] - rows[i - 1]
    share = np.where(gap > 0, (want - rows[i - 1]) / np.where(gap > 0, gap, 1), 0)
    return at[i - 1] + np.ceil(share * (at[i] - at[i - 1])).astype(np.int64)


def balanced_cuts(batches: list[BatchRange], a: int, b: int, n: int) -> list[int]:
    """``n - 1`` cut times splitting ``[a, b)`` into slices of about equal
    estimated rows."""
    import numpy as np
    at, rows = _row_curve(batches, a, b)
    return _times_at(at, rows, rows[-1] * np.arange(1, n) / n).tolist()


def plan_partitions(batches: list[BatchRange], start: int, end: int, opts: SourceOptions,
                    data_root: str) -> list[TimeSlicePartition]:
    """Slices of ``[start, end)`` over the batches that overlap it: ``numSlices`` of
    equal width, or (``balance=count``) of equal estimated rows, each cut further
    until none is estimated above ``maxRowsPerSlice``."""
    import numpy as np
    if end <= start:
        return []
    live = [r for r in batches if r.max_ns >= start and r.min_ns < end]
    if not live:
        return []
    a = max(start, min(r.min_ns for r in live))
    b = min(end, max(r.max_ns for r in live) + 1)
    if b <= a:
        return []
    at, rows = _row_curve(live, a, b)
    n = max(opts.num_slices, math.ceil(rows[-1] / opts.max_rows_per_slice - 1e-6))
    n = max(1, min(n, b - a))
    edges = [a, *balanced_cuts(live, a, b, n), b] if opts.balance == "count" and n > 1 else [
        a, *(stop for _, _, stop in plan_slices(a, b, n))]
    edges = np.unique(np.clip(np.array(edges, np.int64), a, b))
    # Times from ``a``, as nanoseconds since 1970 are too long for a double.
    before = np.interp((edges - a).astype(np.float64), (at - a).astype(np.float64), rows)
    parts = np.ceil(np.diff(before) / opts.max_rows_per_slice - 1e-6).astype(int)
    more = [lo + (hi - lo) * np.arange(1, k) / k for lo, hi, k in zip(before, before[1:], parts) if k > 1]
    if more:
        edges = np.unique(np.concatenate([edges, _times_at(at, rows, np.concatenate(more))]))
    held = np.diff(np.interp((edges - a).astype(np.float64), (at - a).astype(np.float64), rows)).tolist()
    first = np.array([r.min_ns for r in live], np.int64)
    last = np.array([r.max_ns for r in live], np.int64)
    out = []
    for i, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        over = [live[x] for x in np.flatnonzero((last >= lo) & (first < hi))]
        days: dict[tuple, set] = {}
        crowd: dict[tuple, int] = {}
        for r in over:
            days.setdefault((r.writer, r.batch_id), set()).add(r.day)
            if len(r.knots) < 2:
                crowd[r.writer, r.batch_id] = max(crowd.get((r.writer, r.batch_id), 0), r.max_at_instant)
        if not days:
            continue
        sel = [(w, n_, sorted(d)) for (w, n_), d in sorted(days.items())]
        # Time cannot split one instant: when the rows that may share one instant
        # exceed the slice budget, split the slice by key hash instead (all
        # versions of a key stay together, so dedupe stays exact).  Knots show such
        # an instant as a slice that is still too big; a tenth over comes from rounding.
        k = max(1, math.ceil(sum(crowd.values()) / opts.max_rows_per_slice),
                math.ceil(held[i] / opts.max_rows_per_slice - 0.1))
        for j in range(k):
            out.append(TimeSlicePartition(i, lo, hi, opts.measurement, data_root, sel,
                                          opts.dedupe, j, k))
    return out


def key_buckets(col, k: int):
    """Deterministic bucket in ``[0, k)`` of each string of an Arrow column: a
    polynomial hash of its UTF-8 bytes, computed with numpy over the Arrow
    buffers (no per-row Python)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    a = pc.cast(col, pa.large_string())
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    n = len(a)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bufs = a.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[a.offset:a.offset + n + 1]
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None
            else np.zeros(0, dtype=np.uint8))
    lens = np.diff(offsets)
    start, end = int(offsets[0]), int(offsets[-1])
    h = np.zeros(n, dtype=np.uint64)
    if end > start:
        pos = np.arange(start, end, dtype=np.int64) - np.repeat(offsets[:-1], lens)
        powers = np.cumprod(np.full(int(lens.max()), 1_000_003, dtype=np.uint64),
                            dtype=np.uint64) // np.uint64(1_000_003)
        powers[0] = 1
        with np.errstate(over="ignore"):
            contrib = data[start:end].astype(np.uint64) * powers[pos]
        nz = lens > 0
        h[nz] = np.add.reduceat(contrib, (offsets[:-1] - start)[nz])
    # 64-bit finalizer so the low bits used by the modulo are well mixed
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
    return (h % np.uint64(k)).astype(np.int64)


def read_slice(p: TimeSlicePartition, more=None, columns: list[str] | None = None):
    """Arrow record batches of one slice: measurement, day and time bounds pushed
    into the Parquet scan; with ``dedupe`` the latest write per (series, field,
    time) -- every version of a key has the same time, so it is in this slice.
    ``more``: a further Arrow filter, on key columns only; ``columns``: the point
    columns to read and return, all by default.

    Files are decoded ``CHUNK_ROWS`` rows at a time and merged by time, so a task holds
    about ``STEP_ROWS`` rows and the chunks of the files that overlap there, however
    long the slice is; an instant is held whole."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    fs, root = arrow_path(p.data_root)
    part = ds.partitioning(pa.schema([("measurement", pa.string()), ("day", pa.date32())]),
                           flavor="hive")
    day_lo = p.start_ns // NS_PER_DAY
    day_hi = (p.stop_ns - 1) // NS_PER_DAY
    flt = ((ds.field("measurement") == p.measurement)
           & (ds.field("day") >= pa.scalar(day_lo, pa.date32()))
           & (ds.field("day") <= pa.scalar(day_hi, pa.date32()))
           & (ds.field("time_ns") >= p.start_ns) & (ds.field("time_ns") < p.stop_ns))
    if more is not None:
        flt = flt & more
    columns = _POINT_COLS if columns is None else columns
    cols = [*columns, *(c for c in ("measurement", "time_ns") if c not in columns)]
    if p.dedupe or more is not None:
        cols += [c for c in ("series_key", "field") if c not in cols]
    if p.dedupe:
        cols += ["written_at", "seq"]
    elif p.n_buckets > 1 and "series_key" not in cols:
        cols.append("series_key")
    files = []
    for writer, batch_id, days in p.batches:
        bdir = f"{root}/writer={writer}/batch_id={batch_id}"
        found = _slice_files(fs, bdir, p.measurement, [d for d in days if day_lo <= d <= day_hi])
        if not found:
            continue
        d = ds.dataset(found, filesystem=fs, format="parquet", partitioning=part, partition_base_dir=bdir)
        for f in d.get_fragments(filter=flt):
            groups = [g for x in f.split_by_row_group(flt, schema=d.schema) for g in x.row_groups]
            if groups:
                files.append(_SliceFile(p, fs, f, groups, batch_id, cols, more))
    if not p.dedupe:
        for f in files:
            for t in f.chunks():
                for rb in t.to_batches():
                    yield _conform(rb, columns)
        return
    for t in _whole_instants(files):
        for rb in _latest(t).select(columns).to_batches(max_chunksize=65536):
            yield _conform(rb, columns)


class _SliceFile:
    """The rows of a slice in one file, in chunks, and from which time on they lie."""

    def __init__(self, p: TimeSlicePartition, fs, fragment, groups: list, batch_id: int, cols: list[str], more):
        self.p, self.fs, self.path, self.metadata = p, fs, fragment.path, fragment.metadata
        self.groups = [g.id for g in groups]
        self.n_rows = sum(g.num_rows for g in groups)
        self.batch_id, self.cols, self.more = batch_id, cols, more
        self.at = 0                # rows decoded so far
        self.least = None          # least time from each block of CHUNK_ROWS rows to the end

    def _decoded(self, cols: list[str]):
        import pyarrow.parquet as pq
        # A buffered stream: a row group's columns are not fetched whole.
        with pq.ParquetFile(self.path, metadata=self.metadata, filesystem=self.fs, buffer_size=1 << 20) as f:
            yield from f.iter_batches(CHUNK_ROWS, row_groups=self.groups, columns=cols, use_threads=False)

    def find_times(self) -> None:
        """Reads the times alone, for :meth:`from_ns`; files need not be sorted."""
        import numpy as np
        import pyarrow.compute as pc
        least, at = np.full(self.n_rows // CHUNK_ROWS + 1, LONG_MAX, np.int64), 0
        for rb in self._decoded(["time_ns"]):
            t = pc.fill_null(rb.column(0), LONG_MAX).to_numpy(zero_copy_only=False)
            t = np.where((t >= self.p.start_ns) & (t < self.p.stop_ns), t, LONG_MAX)
            block = (at + np.arange(len(t))) // CHUNK_ROWS
            first = np.flatnonzero(np.diff(block, prepend=-1))
            least[block[first]] = np.minimum(least[block[first]], np.minimum.reduceat(t, first)) if len(t) else LONG_MAX
            at += len(t)
        self.least = np.minimum.accumulate(least[::-1])[::-1]

    def from_ns(self) -> int:
        """No row that is still to come lies before; ``LONG_MAX``: none is to come."""
        if self.at >= self.n_rows:
            return LONG_MAX
        return LONG_MIN if self.least is None else int(self.least[self.at // CHUNK_ROWS])

    def chunks(self):
        """Tables of the slice's rows, with ``batch_id``."""
        import pyarrow as pa
        import pyarrow.compute as pc
        p = self.p
        for rb in self._decoded([c for c in self.cols if c != "measurement"]):
            self.at += rb.num_rows
            t = pa.Table.from_batches([rb])
            t = t.filter(pc.and_(pc.greater_equal(t["time_ns"], p.start_ns), pc.less(t["time_ns"], p.stop_ns)))
            if t.num_rows and p.n_buckets > 1:
                t = t.filter(pa.array(key_buckets(t["series_key"], p.n_buckets) == p.key_bucket))
            t = t.append_column("measurement", pa.array([p.measurement] * t.num_rows, pa.string()))
            if self.more is not None and t.num_rows:
                t = t.filter(self.more)
            yield t.select(self.cols).append_column("batch_id", pa.array([self.batch_id] * t.num_rows, pa.int64()))


def _whole_instants(files: list[_SliceFile]):
    """Tables of the rows of ``files``, every instant whole in one of them: always the
    file whose rows begin first is read on, and what lies before all that is still to
    come goes out."""
    import heapq

    import pyarrow as pa
    import pyarrow.compute as pc
    if sum(f.n_rows for f in files) > STEP_ROWS:
        for f in files:
            f.find_times()
    ahead = [(f.from_ns(), i, f.chunks()) for i, f in enumerate(files) if f.from_ns() < LONG_MAX]
    heapq.heapify(ahead)
    held, n, most, schema = [], 0, STEP_ROWS, None
    while ahead:
        _, i, chunks = heapq.heappop(ahead)
        t = next(chunks)
        if files[i].from_ns() < LONG_MAX:
            heapq.heappush(ahead, (files[i].from_ns(), i, chunks))
        else:
            chunks.close()
        if t.num_rows:
            # batches written by different jobs can differ in nullability: one schema
            schema = schema or pa.schema([pa.field(f.name, f.type, nullable=True) for f in t.schema])
            held.append(t.cast(schema))
            n += t.num_rows
        if held and (n >= most or not ahead):
            t = pa.concat_tables(held)
            out = t.filter(pc.less(t["time_ns"], ahead[0][0])) if ahead else t
            held = [t.filter(pc.greater_equal(t["time_ns"], ahead[0][0]))] if ahead else []
            n = sum(x.num_rows for x in held)
            most = n + max(n, STEP_ROWS)   # rows that stay are looked at again when they have doubled
            if out.num_rows:
                yield out


def _latest(t):
    """The latest write of each (series, field, time) of a table."""
    import pyarrow as pa
    import pyarrow.compute as pc
    t = t.sort_by([("series_key", "ascending"), ("field", "ascending"), ("time_ns", "ascending"),
                   ("written_at", "ascending"), ("batch_id", "ascending"), ("seq", "ascending")])
    n = t.num_rows
    if n > 1:
        def ne(name):
            col = t[name].combine_chunks()
            return pc.not_equal(col.slice(0, n - 1), col.slice(1))
        last = pc.or_(pc.or_(ne("series_key"), ne("field")), ne("time_ns"))
        mask = pa.concat_arrays([last, pa.array([True])])
        t = t.filter(mask)
    return t


def _slice_files(fs, bdir: str, measurement: str, days: list[int]) -> list[str]:
    """Data files of one batch for the slice's days only: the task lists its
    ``measurement=<m>/day=<d>`` directories, never the whole batch.  The commit names
    these days, so one that is not there is an error and not an empty slice."""
    import datetime as dt

    import pyarrow.fs as pafs

    mdir = f"{bdir}/measurement={escape_partition_value(measurement)}"
    files = []
    for day in days:
        iso = (dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat()
        infos = fs.get_file_info(pafs.FileSelector(f"{mdir}/day={iso}", allow_not_found=True))
        found = [i.path for i in infos
                 if i.type == pafs.FileType.File and not i.base_name.startswith(("_", "."))]
        if not found:
            raise FileNotFoundError(f"committed files are gone: {mdir}/day={iso}")
        files += found
    return files


def _point_arrow_schema():
    import pyarrow as pa
    return pa.schema([
        ("measurement", pa.string()), ("tags", pa.map_(pa.string(), pa.string())),
        ("field", pa.string()), ("value_double", pa.float64()), ("value_long", pa.int64()),
        ("value_bool", pa.bool_()), ("value_string", pa.string()), ("time_ns", pa.int64()),
        ("series_key", pa.string())])


def _conform(rb, columns: list[str] = _POINT_COLS):
    """The declared output schema, whatever nullability the files had."""
    import pyarrow as pa
    schema = _point_arrow_schema()
    schema = pa.schema([schema.field(c) for c in columns])
    return pa.RecordBatch.from_arrays([rb.column(c).cast(schema.field(c).type) for c in columns], schema=schema)


# --------------------------------------------------------------------------- reader


def _ns(offset) -> int:
    if offset is None:
        return LONG_MIN
    return int(offset["ns"])


# Late records so far, surely and perhaps; records below the cursor and in hours that
# it divides when it was last moved.
_NOTHING_LATE = {"late": 0, "late_maybe": 0, "below": 0, "across": 0}


def _late_state(offset: dict) -> dict:
    return {k: int(offset.get(k, 0)) for k in _NOTHING_LATE}


def _held(batches: list[BatchRange], cursor: int) -> tuple[int, int]:
    """Records in hours below the cursor, and in hours that it divides."""
    return (sum(r.n_records for r in batches if r.max_ns < cursor),
            sum(r.n_records for r in batches if r.min_ns < cursor <= r.max_ns))


def _marks(batches: list[BatchRange], before: dict[str, int]) -> dict[str, int]:
    """The last known batch of each writer; a writer commits its batches in order."""
    out = dict(before)
    for r in batches:
        out[r.writer] = max(out.get(r.writer, r.batch_id), r.batch_id)
    return out


def _knows(marks: dict[str, int], r: BatchRange) -> bool:
    return r.writer in marks and r.batch_id <= marks[r.writer]


class CursorStreamReader(DataSourceStreamReader):
    """Event-time cursor over one measurement of the store."""

    def __init__(self, options: dict):
        self.opts = SourceOptions.parse(options)
        self.data_root, _ = _store_roots(self.opts.path, self.opts.bucket)
        self._cursor: int | None = None
        self._late = _NOTHING_LATE
        self._marks: dict[str, int] = {}
        self._commit_cache: dict = {}
        self._listed: list[BatchRange] | None = None

    def _batches(self) -> list[BatchRange]:
        self._listed = list_commits(self.opts.path, self.opts.bucket, self.opts.measurement,
                                    self._commit_cache)
        return self._listed

    def _vector(self, offset: dict, marks: dict[str, int]) -> dict:
        return {**offset, "marks": dict(sorted(marks.items()))} if self.opts.late == "read" else offset

    def initialOffset(self) -> dict:
        b = self._batches()
        return self._vector({"ns": min(r.min_ns for r in b) if b else LONG_MIN, **_NOTHING_LATE}, {})

    def _moved(self, b: list[BatchRange], end: int) -> dict:
        """The offset ``end``; what came in below the old cursor since it was set is late."""
        was, cur = self._late, self._cursor
        late, maybe = was["late"], was["late_maybe"]
        if cur is not None and cur != LONG_MIN:
            below, across = _held(b, cur)
            late, maybe = late + below - was["below"], maybe + across - was["across"]
        below, across = _held(b, end)
        self._cursor = end
        self._late = {"late": late, "late_maybe": maybe, "below": below, "across": across}
        self._marks = _marks(b, self._marks)
        return self._vector({"ns": end, **self._late}, self._marks)

    def latestOffset(self) -> dict:
        b = self._batches()
        o = self.opts
        if not b:
            return self._moved(b, self._cursor if self._cursor is not None else LONG_MIN)
        lo = min(r.min_ns for r in b)
        hi = max(r.max_ns for r in b)
        cur = self._cursor
        if o.compat:
            if cur is None or cur == LONG_MIN:
                end = lo
            elif hi > cur:
                end = cur + o.delta_ns
            else:
                end = cur
        else:
            end = hi + 1 - o.lateness_ms * 1_000_000
            if cur is not None and cur != LONG_MIN:
                if o.max_delta_per_trigger_ms is not None:
                    ahead = [max(r.min_ns, cur) for r in b if r.max_ns >= cur]
                    if ahead:
                        end = min(end, min(ahead) + o.max_delta_per_trigger_ms * 1_000_000)
                end = max(end, cur)
            elif o.max_delta_per_trigger_ms is not None:
                end = min(end, lo + o.max_delta_per_trigger_ms * 1_000_000)
        return self._moved(b, end)

    def partitions(self, start: dict, end: dict):
        s, e = _ns(start), _ns(end)
        # A restarted reader learns its cursor here (Spark replays the last offsets).
        if self._cursor is None or e > self._cursor:
            self._cursor, self._late = e, _late_state(end)
            self._marks = dict(end.get("marks", {}))
        # What latestOffset listed for this batch, if it did: one listing a trigger.
        listed = self._listed if self._listed is not None else self._batches()
        self._listed = None
        if "marks" not in end:
            return plan_partitions(listed, s, e, self.opts, self.data_root)
        known = [r for r in listed if _knows(end["marks"], r)]
        new = [r for r in known if not _knows(start.get("marks", {}), r)]
        return (plan_partitions(known, s, e, self.opts, self.data_root)
                + plan_partitions(new, LONG_MIN, s, self.opts, self.data_root))

    def read(self, partition: TimeSlicePartition):
        return read_slice(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class LinePointsDataSource(DataSource):
    """The format ``linepoints``: ``read`` and ``write`` (batch), ``readStream`` and
    ``writeStream``.  The stream reader's options: ``path``, ``bucket``,
    ``measurement`` (required), ``delta-time``, ``numSlices``, ``maxRowsPerSlice``,
    ``lateness``, ``late``, ``maxDeltaPerTrigger``, ``compat``, ``dedupe``.  Emits long
    points; :func:`read_stream` turns them into line text with Column
    expressions."""

    @classmethod
    def name(cls) -> str:
        return "linepoints"

    def schema(self) -> str:
        return POINT_DDL

    def reader(self, schema):
        from chronoline.sources.format_reader import PointsReader
        return PointsReader(self.options, schema)

    def writer(self, schema, overwrite: bool):
        from chronoline.sources.format_writer import PointsWriter
        return PointsWriter(self.options, schema, overwrite)

    def streamWriter(self, schema, overwrite: bool):
        from chronoline.sources.format_writer import PointsStreamWriter
        return PointsStreamWriter(self.options, schema, overwrite)

    def streamReader(self, schema):
        arrow_uri(SourceOptions.parse(self.options).path)   # a path of no scheme is an error
        return CursorStreamReader(self.options)


_registered: set = set()


def register(spark) -> None:
    """Register ``linepoints`` with the session, and let Spark push filters into readers
    in Python (``spark.sql.python.filterPushdown.enabled``).  The package is pickled by value
    into the Python workers, so executors need no install of it."""
    key = spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()
    if key not in _registered:
        import chronoline
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(chronoline)
        spark.dataSource.register(LinePointsDataSource)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        _registered.add(key)


def read_stream(spark, path: str, bucket: str, measurement: str, output: str = "lines",
                mode: str = "compat", order: str = "event", time_zone: str | None = None,
                **options):
    """A streaming DataFrame of one measurement of the store.

    ``output='lines'`` gives ``value STRING`` (the reference's row shape),
    ``'points'`` the long point rows.  ``order='event'`` uses the cursor source;
    ``order='arrival'`` uses Spark's file stream source on the store instead (each
    new file once, whatever its times; ``maxFilesPerTrigger`` applies).  That is a
    dirty read: files show before their batch is committed, and those of a replayed
    batch show again.  A path without a scheme is on the cluster's default file
    system, as for Spark's own readers.
    ``numSlices`` defaults to the cluster's default parallelism.  ``time_zone``
    (the ``time-zone`` option) adds ``local_ns``, the wall-clock ns of each point
    in that zone, to either output.
    """
    from pyspark.sql import functions as F

    from chronoline.functions.codec import encode_lines

    if output not in ("lines", "points"):
        raise ValueError("output must be 'lines' or 'points'")
    if order == "arrival":
        from chronoline.sources.store import STORE_SCHEMA, data_root
        reader = (spark.readStream.schema(STORE_SCHEMA)
                  .option("basePath", data_root(path, bucket)))
        for k, v in options.items():
            reader = reader.option(k, str(v))
        df = (reader.parquet(data_root(path, bucket))
              .where(F.col("measurement") == measurement).select(*_POINT_COLS))
    elif order == "event":
        register(spark)
        opts = {"path": qualified(spark, path) if path else path, "bucket": bucket, "measurement": measurement,
                "numSlices": spark.sparkContext.defaultParallelism}
        opts.update({k: str(v) for k, v in options.items()})
        SourceOptions.parse(opts)   # fail on the driver, before start
        df = spark.readStream.format("linepoints").options(**{k: str(v) for k, v in opts.items()}).load()
    else:
        raise ValueError("order must be 'event' or 'arrival'")
    tz = time_zone or options.get("time-zone")
    if tz:
        from chronoline.functions.nanos import to_zone
        df = df.withColumn("local_ns", to_zone("time_ns", str(tz)))
    return df if output == "points" else encode_lines(df, mode, ["local_ns"] if tz else None)


def drain(start, most: int = 10_000) -> int:
    """Runs ``start()`` -- a query with the ``availableNow`` trigger and a checkpoint --
    until a run moves the cursor no further, and returns the number of runs.

    A source in Python cannot tell Spark that a trigger's limit is not the end of the
    data, so with ``maxDeltaPerTrigger`` or ``compat`` one ``availableNow`` run is one
    step; this is how to read all of it."""
    before = None
    for n in range(1, most + 1):
        q = start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        ends = [src["endOffset"] for p in q.recentProgress for src in p["sources"]]
        if not ends or ends[-1] == before:
            return n
        before = ends[-1]
    raise RuntimeError(f"not drained after {most} runs")
