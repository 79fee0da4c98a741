"""Batch reader of the ``linepoints`` format with pushed filters.

Filters on the key columns (``measurement``, ``time_ns``, ``series_key``, ``field``) are
taken over whole: measurement and time bounds choose commit records, days and slices;
all of them go into each task's Parquet scan.  They name whole keys, so they commute with
"the last write wins".  Filters on values do not: they stay with Spark, above the
reader.  Spark's type of a tag condition is one on the series key, for example
``series_key = 'mem,host=a'`` or ``contains(series_key, ',host=a')``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import datasource as D

from chronoline.sources.options import SourceOptions, _get
from chronoline.sources.paths import arrow_path, arrow_uri
from chronoline.streaming.source import (_POINT_COLS, BatchRange, TimeSlicePartition, _commit_schema, _store_roots,
                                         plan_partitions, read_slice)

KEYS = ("measurement", "time_ns", "series_key", "field")
LONG_MIN, LONG_MAX = -2**63, 2**63 - 1


def _expression(f):
    """An Arrow expression that equals the filter, or None."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    if isinstance(f, D.Not):
        inner = _expression(f.child)
        return None if inner is None else ~inner
    if len(f.attribute) != 1 or f.attribute[0] not in KEYS:
        return None
    c = ds.field(f.attribute[0])
    if isinstance(f, D.IsNotNull):
        return c.is_valid()
    if isinstance(f, D.IsNull):
        return c.is_null()
    v = f.value
    if v is None or (isinstance(f, D.In) and any(x is None for x in v)):
        return None
    if isinstance(f, (D.EqualTo, D.EqualNullSafe)):
        return c == v
    if isinstance(f, D.In):
        return c.isin(list(v))
    if isinstance(f, D.GreaterThan):
        return c > v
    if isinstance(f, D.GreaterThanOrEqual):
        return c >= v
    if isinstance(f, D.LessThan):
        return c < v
    if isinstance(f, D.LessThanOrEqual):
        return c <= v
    if isinstance(f, D.StringStartsWith):
        return pc.starts_with(c, pattern=v)
    if isinstance(f, D.StringEndsWith):
        return pc.ends_with(c, pattern=v)
    if isinstance(f, D.StringContains):
        return pc.match_substring(c, pattern=v)
    return None


def _bounds(filters: list) -> tuple[int, int]:
    """``[start, stop)`` in ns that the filters leave open."""
    lo, hi = LONG_MIN, LONG_MAX
    for f in filters:
        if isinstance(f, D.Not) or f.attribute != ("time_ns",) or isinstance(f, (D.IsNull, D.IsNotNull)):
            continue
        if isinstance(f, (D.EqualTo, D.EqualNullSafe, D.In)):
            v = list(f.value) if isinstance(f, D.In) else [f.value]
            if v:
                lo, hi = max(lo, min(v)), min(hi, max(v) + 1)
        elif isinstance(f, (D.GreaterThan, D.GreaterThanOrEqual)):
            lo = max(lo, f.value + isinstance(f, D.GreaterThan))
        elif isinstance(f, (D.LessThan, D.LessThanOrEqual)):
            hi = min(hi, f.value + isinstance(f, D.LessThanOrEqual))
    return lo, hi


def _measurements(filters: list) -> set | None:
    """The measurements that the filters name, None for all."""
    out = None
    for f in filters:
        if not isinstance(f, D.Not) and f.attribute == ("measurement",) and isinstance(f, (D.EqualTo, D.EqualNullSafe, D.In)):
            v = set(f.value) if isinstance(f, D.In) else {f.value}
            out = v if out is None else out & v
    return out


def commit_rows(path: str, bucket: str, measurements: set | None, start: int, stop: int) -> dict[str, list[BatchRange]]:
    """Committed hours that overlap ``[start, stop)``, by measurement: one Arrow scan
    over all commit records, filtered inside it."""
    import posixpath

    import pyarrow as pa
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    _, croot = _store_roots(path, bucket)
    fs, root = arrow_path(croot)
    if fs.get_file_info(posixpath.dirname(root)).type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no point store at {path}, bucket {bucket}")
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    done = {posixpath.dirname(i.path) for i in infos if i.base_name == "_SUCCESS"}
    files = [i.path for i in infos if i.type == pafs.FileType.File and posixpath.dirname(i.path) in done
             and not i.base_name.startswith(("_", "."))]
    if not files:
        return {}
    schema = pa.schema([*_commit_schema(), ("writer", pa.string()), ("batch_id", pa.int64())])
    d = ds.dataset(files, schema=schema, filesystem=fs, format="parquet", partition_base_dir=root,
                   partitioning=ds.partitioning(pa.schema([schema.field("writer"), schema.field("batch_id")]), flavor="hive"))
    flt = (ds.field("max_ns") >= start) & (ds.field("min_ns") < stop)
    if measurements is not None:
        flt = flt & ds.field("measurement").isin(sorted(measurements))
    found: dict[str, list[BatchRange]] = {}
    for r in d.to_table(filter=flt).to_pylist():
        found.setdefault(r["measurement"], []).append(
            BatchRange(r["writer"], r["batch_id"], r["min_ns"], r["max_ns"], r["n_records"],
                       r["max_at_instant"] or r["n_records"], r["min_ns"] // 86_400_000_000_000,
                       tuple(r["time_knots"] or ())))
    return found


class PointsReader(D.DataSourceReader):
    """``spark.read.format("linepoints")``: options ``path``, ``bucket``, and if wanted
    ``measurement``, ``numSlices``, ``maxRowsPerSlice``, ``balance``, ``dedupe``.  A schema
    with some of the point columns reads these columns only."""

    def __init__(self, options: dict, schema):
        measurement = _get(options, "measurement")
        self.opts = SourceOptions.parse({**options, "measurement": measurement or "*"})
        arrow_uri(self.opts.path)     # a path of no scheme is an error
        self.columns = [f.name for f in schema.fields]
        unknown = [c for c in self.columns if c not in _POINT_COLS]
        if unknown:
            raise ValueError(f"points have no columns {unknown}")
        self.filters = [D.EqualTo(("measurement",), measurement)] if measurement else []

    def pushFilters(self, filters):
        for f in filters:
            if _expression(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list:
        lo, hi = _bounds(self.filters)
        data, _ = _store_roots(self.opts.path, self.opts.bucket)
        found = commit_rows(self.opts.path, self.opts.bucket, _measurements(self.filters), lo, hi)
        out = []
        for measurement, rows in sorted(found.items()):
            out += plan_partitions(rows, lo, hi, replace(self.opts, measurement=measurement), data)
        return out

    def read(self, partition: TimeSlicePartition) -> Iterator:
        if partition is None or not isinstance(partition, TimeSlicePartition):   # no partition: nothing in range
            return
        more = None
        for f in self.filters:
            e = _expression(f)
            more = e if more is None else more & e
        yield from read_slice(partition, more, self.columns)
