"""The point store: a folder of Parquet points written and read by Spark.

Layout under ``<path>/<bucket>/``::

    data/writer=<w>/batch_id=<n>/measurement=<m>/day=<yyyy-mm-dd>/part-*.parquet
    _commits/writer=<w>/batch_id=<n>/part-*.parquet     (+ _SUCCESS)
    _rejects/writer=<w>/batch_id=<n>/part-*.parquet     (lines that did not decode)

* A batch directory is always written whole with ``overwrite``, then its commit
  record (per measurement and hour: ``min_ns``, ``max_ns``, ``n_records``).  Readers take
  committed batches only, so a crash between the two leaves nothing visible,
  and a replayed batch overwrites the same directory: the store ends the same.
* ``measurement`` and ``day`` (UTC) are partition columns: a measurement or time
  filter prunes directories; inside, files are sorted by ``time_ns`` so Parquet
  row-group statistics prune the rest (``PushedFilters`` on ``time_ns``).
* ``written_at, batch_id, seq`` give the write order; a key (series, field, time)
  written twice keeps its latest write (:func:`read_points` ``dedupe=True``).
* The commit records are small (one row per batch, measurement and hour); the stream
  reader plans its cursor from them and never scans points on the driver.  They carry
  quantiles of the times, by which slices are cut, and a sketch of the series, from
  which :func:`series_estimate` counts series without a scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, DoubleType, LongType, MapType, StringType,
                               StructField, StructType, TimestampType)

from chronoline.functions.codec import POINT_COLUMNS
from chronoline.sources.paths import escape_partition_value
from chronoline.functions.nanos import floor_div
from chronoline.operators.points import in_range, upsert_latest

NS_PER_DAY = 86_400_000_000_000
NS_PER_HOUR = 3_600_000_000_000
BROADCAST_HOURS = 100_000   # most hours of a range that are sent to every task
KLL_K = 4096                # rank error of the time sketches about 0.13 %
MOST_KNOTS, LEAST_KNOTS, KNOT_ROWS = 1024, 64, 100_000   # pieces of an hour's time quantiles
HLL_BITS = 12               # series sketches of 4096 registers
# Three standard errors of a merged sketch of that size.
SERIES_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)

# Write order, most significant first.
def write_order() -> list:
    return ["written_at", "batch_id", "seq"]

POINT_SCHEMA = StructType([
    StructField("measurement", StringType()),
    StructField("tags", MapType(StringType(), StringType())),
    StructField("field", StringType()),
    StructField("value_double", DoubleType()),
    StructField("value_long", LongType()),
    StructField("value_bool", BooleanType()),
    StructField("value_string", StringType()),
    StructField("time_ns", LongType()),
    StructField("series_key", StringType()),
])
# Data file columns, then the partition columns (typed here, not inferred).
STORE_SCHEMA = StructType(
    [f for f in POINT_SCHEMA.fields if f.name != "measurement"]
    + [StructField("written_at", TimestampType()), StructField("seq", LongType()),
       StructField("writer", StringType()), StructField("batch_id", LongType()),
       StructField("measurement", StringType()), StructField("day", DateType())])
COMMIT_SCHEMA = StructType([
    StructField("measurement", StringType()), StructField("day", DateType()),
    StructField("hour", LongType()),
    StructField("min_ns", LongType()),
    StructField("max_ns", LongType()), StructField("n_records", LongType()),
    StructField("max_at_instant", LongType()), StructField("n_keys", LongType()),
    StructField("time_knots", ArrayType(LongType())), StructField("series_sketch", BinaryType()),
    StructField("writer", StringType()), StructField("batch_id", LongType())])


def bucket_root(path: str, bucket: str) -> str:
    if not path:
        raise ValueError("Option 'path' is required")
    if not bucket:
        raise ValueError("Option 'bucket' is required")
    return f"{path.rstrip('/')}/{bucket}"


def data_root(path: str, bucket: str) -> str:
    return f"{bucket_root(path, bucket)}/data"


def commits_root(path: str, bucket: str) -> str:
    return f"{bucket_root(path, bucket)}/_commits"


def rejects_root(path: str, bucket: str) -> str:
    return f"{bucket_root(path, bucket)}/_rejects"


def batch_dir(root: str, writer: str, batch_id: int) -> str:
    return f"{root}/writer={writer}/batch_id={int(batch_id)}"


def day_of(time_ns) -> Column:
    """UTC calendar day of an ns instant (independent of the session zone)."""
    return F.date_from_unix_date(floor_div(time_ns, NS_PER_DAY).cast("int"))


# --------------------------------------------------------------------------- file system


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def is_committed(spark: SparkSession, path: str, bucket: str, writer: str, batch_id: int) -> bool:
    return path_exists(spark, batch_dir(commits_root(path, bucket), writer, batch_id) + "/_SUCCESS")


# --------------------------------------------------------------------------- write


def _check_points(points: DataFrame) -> None:
    missing = [c for c in POINT_COLUMNS if c not in points.columns]
    if missing:
        raise ValueError(f"not a point DataFrame, missing columns {missing}")


def shape_for_write(points: DataFrame, num_partitions: int | None = None,
                    cluster_by_time: bool = False) -> DataFrame:
    """Partition shape before a write.

    ``num_partitions`` lowers the partition count with ``coalesce`` (never a
    shuffle, never an increase; n < 1 is an error).  ``cluster_by_time``
    rebalances on the partition columns (measurement, day) with AQE's
    ``rebalance`` hint instead: each task then writes one or a few (measurement,
    day) directories, AQE splits a hot day over several tasks and merges small
    ones, and -- unlike a range partitioning -- no sampling pass evaluates the
    input an extra time.
    """
    if num_partitions is not None:
        if int(num_partitions) <= 0:
            raise ValueError(f"numPartitions is {num_partitions}; it must be 1 or more")
        return points.coalesce(int(num_partitions))
    if cluster_by_time:
        with_day = points if "day" in points.columns else points.withColumn("day", day_of("time_ns"))
        return with_day.hint("rebalance", "measurement", "day")
    return points


def write_data(points: DataFrame, path: str, bucket: str, writer: str, batch_id: int,
               batch_size: int | None = None) -> None:
    """The data files of batch ``(writer, batch_id)``, from points with ``written_at``
    and ``seq``.  The batch's directory is overwritten whole; nobody reads it before
    :func:`write_commit`."""
    if batch_size is not None and int(batch_size) < 1:
        raise ValueError(f"batchSize is {batch_size}; it must be 1 or more")
    if "day" not in points.columns:
        points = points.withColumn("day", day_of("time_ns"))
    # Spark leaves a constant out of a sort, and then sorts by the partition columns alone,
    # not by time; the same for a string that may be null.  Neither is so of this name.
    nothing = F.coalesce(F.substring("series_key", 1, 0), F.lit(""))
    measurement = F.concat(F.coalesce(F.col("measurement"), F.lit("")), nothing).alias("measurement")
    out = (points
           .select(*[c for c in POINT_COLUMNS if c != "measurement"], "written_at", "seq",
                   measurement, "day")
           .sortWithinPartitions("measurement", "day", "time_ns"))
    # Bloom filters, sized by the keys found: a read of one series skips row groups
    # whose least and largest key enclose it.
    w = (out.write.mode("overwrite").partitionBy("measurement", "day")
         .option("parquet.bloom.filter.enabled#series_key", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true"))
    if batch_size:
        w = w.option("maxRecordsPerFile", int(batch_size))
    w.parquet(batch_dir(data_root(path, bucket), writer, batch_id))


def write_batch(points: DataFrame, path: str, bucket: str, writer: str, batch_id: int,
                batch_size: int | None = None, prove_keys: bool = True) -> None:
    """:func:`write_data`, then :func:`write_commit`: a retry of the same batch leaves
    the same store."""
    write_data(points, path, bucket, writer, batch_id, batch_size)
    write_commit(points.sparkSession, path, bucket, writer, batch_id, prove_keys)


def time_knots(sketch, n) -> Column:
    """Times that cut a sketch's ``n`` rows into equal parts, its least and largest
    included: ``KNOT_ROWS`` rows a part, but 64 to 1024 parts, and no more than rows."""
    def picked(most: int, parts: Column) -> Column:
        every = F.kll_sketch_get_quantile_bigint(sketch, F.lit([i / most for i in range(most + 1)]))
        part_of = lambda i: F.floor(i * parts / most)
        return F.filter(every, lambda t, i: (i == 0) | (part_of(i) > part_of(i - 1)))

    # Most hours are small, and 1025 quantiles of each cost more than its rows.
    few = picked(LEAST_KNOTS, F.least(F.col(n), F.lit(LEAST_KNOTS)))
    many = picked(MOST_KNOTS, F.least(F.ceil(F.col(n) / KNOT_ROWS), F.lit(MOST_KNOTS)))
    return F.when(F.col(n) > LEAST_KNOTS * KNOT_ROWS, many).otherwise(few)


def write_commit(spark: SparkSession, path: str, bucket: str, writer: str, batch_id: int,
                 prove_keys: bool = True) -> None:
    """Commit record of a written batch, one row per measurement, day and hour, from
    the narrow columns of the files just written.

    ``min_ns, max_ns, n_records``, ``time_knots`` and ``max_at_instant`` plan slices;
    ``series_sketch`` counts series.  Without
    ``prove_keys`` they cost one aggregation of which only partial rows are shuffled
    (an hour, not a row, each); ``max_at_instant`` then is the number
    of rows at the write time, where lines without a time lie (all rows of an hour of
    one instant), and
    ``n_keys`` is null: readers must take it that keys repeat.  ``prove_keys`` adds
    the number of distinct keys, which lets append-only data be read without the
    upsert; it shuffles the batch's keys once."""
    schema = StructType([f for f in STORE_SCHEMA.fields if f.name not in ("writer", "batch_id")])
    bdir = batch_dir(data_root(path, bucket), writer, batch_id)
    written = spark.read.schema(schema).parquet(bdir)
    hour = floor_div("time_ns", NS_PER_HOUR).alias("hour")
    at_write = F.count_if(F.col("time_ns") == F.unix_micros("written_at") * 1000)
    stats = written.groupBy("measurement", "day", hour).agg(
        F.min("time_ns").alias("min_ns"), F.max("time_ns").alias("max_ns"), F.count(F.lit(1)).alias("n_records"),
        at_write.alias("_w"), F.kll_sketch_agg_bigint("time_ns", KLL_K).alias("_times"),
        F.hll_sketch_agg("series_key", HLL_BITS).alias("series_sketch"))
    crowd = F.when(F.col("min_ns") == F.col("max_ns"), F.col("n_records")).otherwise(F.greatest("_w", F.lit(1)))
    n_keys = F.lit(None).cast("bigint")
    if prove_keys:
        per_instant = (written.groupBy("measurement", "day", "time_ns", "series_key", "field").agg(F.count(F.lit(1)).alias("_c"))
                       .groupBy("measurement", "day", "time_ns").agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_k")))
        proof = per_instant.groupBy(F.col("measurement").alias("_m"), F.col("day").alias("_d"), hour.alias("_h")).agg(
            F.max("_n").alias("_most"), F.sum("_k").alias("_keys"))
        same = [F.col(x).eqNullSafe(F.col(y)) for x, y in (("measurement", "_m"), ("day", "_d"), ("hour", "_h"))]
        stats, crowd, n_keys = stats.join(proof, same), F.col("_most"), F.col("_keys")
    stats = stats.select("measurement", "day", "hour", "min_ns", "max_ns", "n_records", crowd.alias("max_at_instant"),
                         n_keys.alias("n_keys"), time_knots("_times", "n_records").alias("time_knots"), "series_sketch")
    stats.write.mode("overwrite").parquet(batch_dir(commits_root(path, bucket), writer, batch_id))


def write_points(points: DataFrame, path: str, bucket: str, batch_size: int | None = None,
                 num_partitions: int | None = None, cluster_by_time: bool = True,
                 writer: str | None = None, prove_keys: bool = True) -> dict:
    """Append long points to the store as one new committed batch.

    Returns ``{"writer": w, "batch_id": 0}``.  The write order columns are taken
    here, before any shuffle: ``written_at`` = this query's timestamp, ``seq`` =
    ``monotonically_increasing_id()``.
    """
    _check_points(points)
    writer = writer or f"batch-{uuid.uuid4().hex}"
    stamped = (points.select(*POINT_COLUMNS)
               .withColumn("written_at", F.current_timestamp())
               .withColumn("seq", F.monotonically_increasing_id()))
    shaped = shape_for_write(stamped, num_partitions, cluster_by_time)
    write_batch(shaped, path, bucket, writer, 0, batch_size, prove_keys)
    return {"writer": writer, "batch_id": 0}


# --------------------------------------------------------------------------- read


def commits(spark: SparkSession, path: str, bucket: str) -> DataFrame:
    """Commit records: ``measurement, day, hour, min_ns, max_ns, n_records,
    max_at_instant, writer, batch_id``.
    Only batches whose commit finished (``_SUCCESS``) have files here."""
    root = commits_root(path, bucket)
    if not path_exists(spark, root):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(root)


def commits_in(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
               start: int | None = None, stop: int | None = None) -> DataFrame:
    """The commit records that overlap the range."""
    c = commits(spark, path, bucket)
    if measurement is not None:
        c = c.where(F.col("measurement") == measurement)
    if start is not None:
        c = c.where(F.col("max_ns") >= F.lit(int(start)))
    if stop is not None:
        c = c.where(F.col("min_ns") < F.lit(int(stop)))
    return c


def committed_dirs(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
                   start: int | None = None, stop: int | None = None) -> list[str]:
    """Directories of committed batches that may hold points of the range: whole
    batches, or with a measurement their ``measurement=<m>/day=<d>`` directories.
    The driver gets one row for each, fewer than the files it lists there next."""
    return _dirs_of(commits_in(spark, path, bucket, measurement, start, stop), path, bucket,
                    by_day=measurement is not None)


def _dirs_of(rows: DataFrame, path: str, bucket: str, by_day: bool) -> list[str]:
    found = rows.select("writer", "batch_id", *(["measurement", "day"] if by_day else [])).distinct().collect()
    root = data_root(path, bucket)
    return sorted(batch_dir(root, r["writer"], r["batch_id"])
                  + (f"/measurement={escape_partition_value(r['measurement'])}/day={r['day'].isoformat()}"
                     if by_day else "") for r in found)


def hours_with_repeats(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
                       start: int | None = None, stop: int | None = None) -> DataFrame:
    """``measurement, hour, repeats``: whether a key (series, field, time) may occur
    twice in that hour, from the commit records alone.  It cannot where one batch
    holds the hour and was proven to have distinct keys."""
    c = commits_in(spark, path, bucket, measurement, start, stop)
    clean = F.coalesce(F.col("n_keys") == F.col("n_records"), F.lit(False))
    return c.groupBy("measurement", "hour").agg(
        ((F.count(F.lit(1)) > 1) | ~F.min(clean)).alias("repeats"))


def may_hold_duplicates(spark: SparkSession, path: str, bucket: str,
                        measurement: str | None = None, start: int | None = None,
                        stop: int | None = None) -> bool:
    """Whether a key (series, field, time) can occur twice in the range."""
    hours = hours_with_repeats(spark, path, bucket, measurement, start, stop)
    return bool(hours.agg(F.max("repeats")).first()[0])


def series_estimate(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
                    start: int | None = None, stop: int | None = None) -> DataFrame:
    """``measurement, n_series, least, most``: about how many series have points in
    ``[start, stop)``, and the bounds of three standard errors (``SERIES_ERROR``).

    Hours that lie in the range come from the sketches of the commit records, merged;
    points are read only for commit rows that the range cuts, or that have no sketch
    (:mod:`~chronoline.sources.format_writer`), and sketched the same way.  A measurement
    without points in the range has no row."""
    rows = commits_in(spark, path, bucket, measurement, start, stop)
    inside = F.col("series_sketch").isNotNull()
    if start is not None:
        inside = inside & (F.col("min_ns") >= F.lit(int(start)))
    if stop is not None:
        inside = inside & (F.col("max_ns") < F.lit(int(stop)))
    sketches = rows.where(inside).select("measurement", F.col("series_sketch").alias("s"))
    dirs = _dirs_of(rows.where(~inside), path, bucket, by_day=True)
    if dirs:
        on = ["writer", "batch_id", "measurement", "hour"]
        points = (_read_dirs(spark, path, bucket, dirs, measurement, start, stop)
                  .withColumn("hour", floor_div("time_ns", NS_PER_HOUR))
                  .join(rows.where(~inside).select(*on), on, "left_semi"))
        sketches = sketches.unionByName(points.groupBy("measurement").agg(
            F.hll_sketch_agg("series_key", HLL_BITS).alias("s")))
    n = F.col("n_series")
    return (sketches.groupBy("measurement").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("n_series"))
            .select("measurement", "n_series", F.floor(n / (1 + SERIES_ERROR)).alias("least"),
                    F.ceil(n / (1 - SERIES_ERROR)).alias("most")))


def _read_dirs(spark: SparkSession, path: str, bucket: str, dirs: list[str],
               measurement, start, stop) -> DataFrame:
    if not dirs:
        return spark.createDataFrame([], STORE_SCHEMA)
    df = (spark.read.schema(STORE_SCHEMA).option("basePath", data_root(path, bucket))
          .parquet(*dirs))
    if start is not None:
        df = df.where(F.col("day") >= F.date_from_unix_date(F.lit(int(start) // NS_PER_DAY)))
    if stop is not None:
        df = df.where(F.col("day") <= F.date_from_unix_date(F.lit((int(stop) - 1) // NS_PER_DAY)))
    return in_range(df, measurement, start, stop)


def read_store(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
               start: int | None = None, stop: int | None = None,
               series: str | list[str] | None = None) -> DataFrame:
    """Committed stored rows (points plus write-order and partition columns),
    filtered by measurement and ``[start, stop)``; every version of a point.

    With a measurement, Spark is given the committed day directories in range
    only; partition filters on ``measurement``/``day`` and pushed ``time_ns``
    filters then prune further.  ``series`` (series keys; none of them: no rows) is
    pushed too, to the Bloom filters of the files."""
    dirs = committed_dirs(spark, path, bucket, measurement, start, stop)
    rows = _read_dirs(spark, path, bucket, dirs, measurement, start, stop)
    if series is None:
        return rows
    return rows.where(F.col("series_key") == series if isinstance(series, str) else F.col("series_key").isin(list(series)))


def read_points(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
                start: int | None = None, stop: int | None = None,
                dedupe: bool | str = "auto", series: str | list[str] | None = None) -> DataFrame:
    """Long points of the store (the batch form of the time-range scan), of all series
    or of some series keys.

    ``dedupe`` applies last-write-wins on (series_key, field, time_ns) -- the
    store's upsert semantics -- as one aggregation with map-side partial
    aggregation.  ``"auto"`` (default) does so only for the hours in which the
    commit records leave it open whether a key repeats; other hours are scanned
    without a shuffle.  ``False`` returns every stored version without a shuffle.
    """
    df = read_store(spark, path, bucket, measurement, start, stop, series)
    latest = lambda d: upsert_latest(d, order=write_order()).select(*POINT_COLUMNS)
    if dedupe != "auto":
        return latest(df) if dedupe else df.select(*POINT_COLUMNS)
    hours = hours_with_repeats(spark, path, bucket, measurement, start, stop)
    n = hours.agg(F.count_if("repeats").alias("dirty"), F.count_if(~F.col("repeats")).alias("clean")).first()
    if not n["dirty"]:
        return df.select(*POINT_COLUMNS)
    if not n["clean"]:
        return latest(df)
    dirty = hours.where("repeats").select(F.col("measurement").alias("_m"), F.col("hour").alias("_h"))
    if n["dirty"] <= BROADCAST_HOURS:   # else an ordinary join by hour
        dirty = F.broadcast(dirty)
    on = (F.col("measurement") == F.col("_m")) & (floor_div("time_ns", NS_PER_HOUR) == F.col("_h"))
    return (df.join(dirty, on, "left_anti").select(*POINT_COLUMNS)
            .unionByName(latest(df.join(dirty, on, "left_semi"))))


def read_lines(spark: SparkSession, path: str, bucket: str, measurement: str | None = None,
               start: int | None = None, stop: int | None = None, mode: str = "compat",
               dedupe: bool | str = "auto") -> DataFrame:
    """Stored points as ``value STRING`` line rows (the reference's read output)."""
    from chronoline.functions.codec import encode_lines
    return encode_lines(read_points(spark, path, bucket, measurement, start, stop, dedupe), mode)
