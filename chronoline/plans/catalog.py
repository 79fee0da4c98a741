"""Named query plans over the given tables, one per operator group.

Each plan takes ``(spark, sf_dir)`` and returns a DataFrame built from the whole
tables in ``sf_dir``.  Test tables as points:

* ``events``  -> measurement ``events``, tags ``event_type``, ``user_id``,
  field ``value`` (and ``props`` where a string field is wanted), time ``ts``.
* ``orders``  -> measurement ``orders``, tags ``o_orderstatus``,
  ``o_orderpriority`` (``4-NOT SPECIFIED`` has a space), fields ``o_totalprice``
  (double) and ``o_custkey`` (integer), time ``o_orderdate``.
* ``lineitem`` -> measurement ``lineitem``, tags ``l_returnflag``,
  ``l_linestatus``, four double fields, time ``l_shipdate``; (series, time) keys
  repeat, so it drives upsert and wide.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.functions import codec, nanos
from chronoline.operators import points as P
from chronoline.operators import slices as S

# Fixed query parameters.
RANGE_START_NS = 1_704_672_000_000_000_000   # 2024-01-08T00:00:00Z
RANGE_STOP_NS = 1_705_276_800_000_000_000    # 2024-01-15T00:00:00Z
N_SLICES = 8
BATCH_DELTA_NS = 6 * 3_600_000_000_000       # 6 h cursor step
TAIL_DELTA_NS = 1_000                        # 1 us cursor step
ARRIVAL_BATCHES = 10
ARRIVAL_MULTIPLIER = 7919
ZONES = {"shanghai_ns": "Asia/Shanghai", "new_york_ns": "America/New_York",
         "paris_ns": "Europe/Paris"}
LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]
LINEITEM_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STORE_BATCH_ROWS = 50_000                    # batchSize: rows per store file (cap)
COMPAT_DELTA_MS = 7 * 86_400_000             # compat cursor step: 7 days
SESSION_GAP, SESSION_DELAY = "1 day", "2 days"
SESSION_SPAN = "400 days"                    # how far versions of a point may lie behind


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_points(spark: SparkSession, sf_dir: str, fields=("value",), keep=(), start=None,
                  stop=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return P.to_points(ev, "events", ["event_type", "user_id"], list(fields), "ts", list(keep),
                       start=start, stop=stop)


def orders_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return P.to_points(o, "orders", ["o_orderstatus", "o_orderpriority"],
                       ["o_totalprice", "o_custkey"], "o_orderdate")


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of ``lineitem`` after the upsert: the latest row of each (series,
    time) is found before the rows are exploded into fields."""
    tags = ["l_returnflag", "l_linestatus"]
    rows = P.latest_rows(table(spark, sf_dir, "lineitem"), [*tags, "l_shipdate"], LINEITEM_FIELDS, LINEITEM_ORDER)
    return P.to_points(rows, "lineitem", tags, LINEITEM_FIELDS, "l_shipdate")


def _bounds(df: DataFrame) -> tuple[int, int]:
    """min, max time_ns: one row of two longs to the driver."""
    row = df.agg(F.min("time_ns"), F.max("time_ns")).first()
    return row[0], row[1]


# --------------------------------------------------------------------------- scans, probes


def range_scan(spark, sf_dir):
    ev = events_points(spark, sf_dir, start=RANGE_START_NS, stop=RANGE_STOP_NS)
    return (P.in_range(ev, "events", RANGE_START_NS, RANGE_STOP_NS)
            .select("series_key", "field", "value_double", "time_ns"))


def first_last_time(spark, sf_dir):
    return P.first_last_time(events_points(spark, sf_dir))


def series_stats(spark, sf_dir):
    return P.series_stats(events_points(spark, sf_dir))


def series_cardinality(spark, sf_dir):
    return P.series_cardinality(events_points(spark, sf_dir, fields=("value", "props")))


def first_last_record(spark, sf_dir):
    r = P.first_last_records(events_points(spark, sf_dir), carry=["value_double"])
    return r.select("series_key", "field", "first_ns",
                    F.col("first_value_double").alias("first_value"), "last_ns",
                    F.col("last_value_double").alias("last_value"))


def range_count(spark, sf_dir):
    ev = events_points(spark, sf_dir, start=RANGE_START_NS, stop=RANGE_STOP_NS)
    return P.range_count(ev, RANGE_START_NS, RANGE_STOP_NS)


def range_count_by_series(spark, sf_dir):
    ev = events_points(spark, sf_dir, start=RANGE_START_NS, stop=RANGE_STOP_NS)
    return P.range_count(ev, RANGE_START_NS, RANGE_STOP_NS, by_series=True)


# --------------------------------------------------------------------------- slices, cursor


def time_slices(spark, sf_dir):
    return S.time_slices(S.data_bounds(events_points(spark, sf_dir)), N_SLICES)


def slice_counts(spark, sf_dir):
    ev = events_points(spark, sf_dir)
    lo, hi = _bounds(ev)
    return S.slice_counts(ev, lo, hi + 1, N_SLICES)


def balanced_slices(spark, sf_dir):
    """The cut points of count-balanced slices, judged by exact counts: whether each
    slice holds its share of the records to within a hundredth of all of them."""
    ev = events_points(spark, sf_dir)
    edges = [r["start_ns"] for r in S.balanced_bounds(ev, N_SLICES).orderBy("slice_id").collect()]   # N_SLICES rows
    in_slice = sum((F.col("time_ns") >= F.lit(e)).cast("int") for e in edges) - 1
    counts = ev.groupBy(in_slice.alias("slice_id")).agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy(F.lit(0))    # one row for each slice
    return counts.select("slice_id", F.sum("n").over(total).alias("n_all"),
                         (F.abs(F.col("n") * N_SLICES - F.sum("n").over(total)) * 100
                          <= F.sum("n").over(total) * N_SLICES).alias("within_tolerance"))


def incremental_batches(spark, sf_dir):
    return S.incremental_batches(events_points(spark, sf_dir), BATCH_DELTA_NS)


def tail_held(spark, sf_dir):
    ev = events_points(spark, sf_dir)
    return S.tail_held(ev, TAIL_DELTA_NS).select("series_key", "field", "value_double", "time_ns")


def late_rows(spark, sf_dir):
    ev = events_points(spark, sf_dir, keep=("event_id",))
    arrival = F.pmod(F.col("event_id") * ARRIVAL_MULTIPLIER, F.lit(ARRIVAL_BATCHES)).cast("int")
    return S.late_counts(ev.withColumn("arrival_batch", arrival), "arrival_batch")


# --------------------------------------------------------------------------- codec


def encode_compat(spark, sf_dir):
    return codec.encode_lines(events_points(spark, sf_dir), mode="compat")


def encode_safe(spark, sf_dir):
    return codec.encode_lines(orders_points(spark, sf_dir), mode="safe")


def encode_wide(spark, sf_dir):
    return codec.encode_wide_lines(events_points(spark, sf_dir, fields=("value", "props")))


def decode_lines(spark, sf_dir):
    lines = codec.encode_lines(orders_points(spark, sf_dir), mode="safe")
    pts = codec.decode_lines(lines)
    return pts.select("measurement",
                      F.col("tags")["o_orderstatus"].alias("o_orderstatus"),
                      F.col("tags")["o_orderpriority"].alias("o_orderpriority"),
                      "series_key", "field", "value_double", "value_long", "time_ns")


def decode_no_time(spark, sf_dir):
    """Lines without a timestamp take a per-row default time (D3): the points come
    back equal to the source when that default is the row's own time."""
    pts = events_points(spark, sf_dir)
    lines = pts.select(F.concat(F.col("series_key"), F.lit(" value="),
                                F.col("value_double").cast("string")).alias("value"),
                       F.col("time_ns").alias("t"))
    out = codec.decode_lines(lines, default_time_ns=F.col("t"), keep=["t"])
    return out.select("series_key", "field", "value_double", "time_ns")


def bad_lines(spark, sf_dir):
    lines = codec.encode_lines(events_points(spark, sf_dir, fields=("value", "props")), mode="compat")
    return codec.bad_lines(lines)


def bad_line_reasons(spark, sf_dir):
    """Lines of every kind that does not decode, one kind for each remainder of
    ``event_id``, with the reason found."""
    ev = table(spark, sf_dir, "events")
    i = F.col("event_id").cast("string")
    kinds = [F.lit(None).cast("string"), F.lit("  "), F.concat(F.lit("# "), i),
             F.concat(F.lit("m,a="), i, F.lit(" f")), F.concat(F.lit("m,a="), i, F.lit(",a=2 f=1 5")),
             F.concat(F.lit("m f="), i, F.lit(",f=2 5")), F.concat(F.lit("m f=x"), i, F.lit(" 5")),
             F.concat(F.lit("m f=1 99999999999999999999"), i), F.concat(F.lit("m f=1e400,g="), i, F.lit(" 5")),
             F.concat(F.lit("m f="), i, F.lit(" 5\r"))]
    line = F.get(F.array(*kinds), F.pmod("event_id", F.lit(len(kinds))).cast("int"))
    lines = ev.select(line.alias("value"), "event_id")
    return codec.bad_lines(lines, keep=["event_id"]).select("event_id", "reason")


def bad_points(spark, sf_dir):
    """Points without a safe line, with the reason found."""
    pts = events_points(spark, sf_dir, keep=("event_id",))
    kind = F.pmod("event_id", F.lit(4))
    value = (F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("-inf")))
             .when(kind == 2, F.col("value_double")))
    return codec.bad_points(pts.withColumn("value_double", value), keep=["event_id"]).select("event_id", "reason")


# --------------------------------------------------------------------------- nanoseconds


def ns_parts(spark, sf_dir):
    ev = events_points(spark, sf_dir, keep=("event_id",))
    neg = nanos.ns_add("time_ns", -20_000, "d")
    return ev.select(
        "event_id", "time_ns",
        nanos.ns_seconds("time_ns").alias("seconds"),
        nanos.ns_nanos("time_ns").alias("nanos"),
        neg.alias("neg_ns"),
        nanos.ns_seconds(neg).alias("neg_seconds"),
        nanos.ns_nanos(neg).alias("neg_nanos"),
        F.unix_micros(nanos.ns_to_timestamp(neg)).alias("neg_us"),
        nanos.ns_from_parts(nanos.ns_seconds(neg), nanos.ns_nanos(neg)).alias("neg_back_ns"))


def ns_add(spark, sf_dir):
    ev = events_points(spark, sf_dir, keep=("event_id",))
    return ev.select(
        "event_id",
        nanos.ns_add("time_ns", 90, "min").alias("plus_90min"),
        nanos.ns_add("time_ns", -2, "d").alias("minus_2d"),
        nanos.ns_add("time_ns", 1500).alias("plus_1500ms"),
        nanos.ns_add("time_ns", 250, "us").alias("plus_250us"),
        nanos.ns_add("time_ns", 7, "ns").alias("plus_7ns"),
        nanos.ns_add("time_ns", F.col("event_id"), "s").alias("plus_id_s"))


def ns_units(spark, sf_dir):
    ev = events_points(spark, sf_dir, keep=("event_id",))
    ms = nanos.floor_div("time_ns", 1_000_000)
    s = nanos.floor_div("time_ns", 1_000_000_000)
    # An id is a count of hours only here: ids above 2,562,047 have no nanoseconds.
    return ev.select("event_id", ms.alias("epoch_ms"), nanos.millis_to_ns(ms).alias("ms_ns"),
                     s.alias("epoch_s"), nanos.seconds_to_ns(s).alias("s_ns"),
                     nanos.try_to_ns("event_id", "h").alias("id_hours_ns"))


def ns_from_iso(spark, sf_dir):
    # Each text is a column before it is parsed: as one expression, Spark would copy the
    # formatting into every use.
    ev = (events_points(spark, sf_dir, keep=("event_id",)).select("event_id", "time_ns")
          .withColumn("iso", nanos.ns_to_iso("time_ns"))
          .withColumn("trimmed", F.regexp_replace("iso", r"(\.\d*?)0+Z$", "$1Z")))
    return ev.select("event_id", "time_ns", "iso", nanos.ns_from_iso("iso").alias("parsed_ns"),
                     nanos.ns_from_iso("trimmed").alias("parsed_trimmed_ns"))


def to_zone(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = nanos.ns_from_timestamp_ntz("o_orderdate")
    return o.select("o_orderkey", t.alias("time_ns"),
                    *[nanos.to_zone(t, z).alias(name) for name, z in ZONES.items()])


# --------------------------------------------------------------------------- upsert, wide


def upsert_latest(spark, sf_dir):
    return lineitem_points(spark, sf_dir).select("series_key", "field", "time_ns", "value_double")


def upsert_long(spark, sf_dir):
    """The upsert of long points, as a store does it: the latest by ``event_id``."""
    ev = events_points(spark, sf_dir, keep=("event_id",))
    day = F.col("time_ns") - F.pmod("time_ns", F.lit(86_400_000_000_000))
    return (P.upsert_latest(ev.withColumn("time_ns", day), order=["event_id"], carry=["value_double"])
            .select("series_key", "field", "time_ns", "value_double"))


def wide_points(spark, sf_dir):
    return P.to_wide(lineitem_points(spark, sf_dir), LINEITEM_FIELDS)


def wide_map(spark, sf_dir):
    """The wide form for an unknown set of fields: a map of texts, shown as text."""
    wide = P.to_wide(events_points(spark, sf_dir, fields=("value", "props")))
    return wide.select("series_key", "time_ns", F.array_join(F.transform(
        F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("fields"))


def wide_variant(spark, sf_dir):
    """The wide form for an unknown set of fields with their types, read back as columns."""
    wide = P.to_wide_variant(events_points(spark, sf_dir, fields=("value", "event_id", "props")))
    get = lambda name, kind: F.try_variant_get("fields", f"$.{name}", kind).alias(name)
    return wide.select("series_key", "time_ns", get("value", "double"), get("event_id", "bigint"), get("props", "string"),
                       F.schema_of_variant("fields").alias("types"))


# --------------------------------------------------------------------------- store, streams


def _store_events(spark, sf_dir, bucket="events_bucket"):
    from chronoline.session import scratch_path
    from chronoline.sources import store
    root = scratch_path(spark, "store")
    store.write_points(events_points(spark, sf_dir), root, bucket, batch_size=STORE_BATCH_ROWS)
    return root, bucket


def store_roundtrip(spark, sf_dir):
    """Points written to a fresh store in the shared folder and read back."""
    from chronoline.sources import store
    root, bucket = _store_events(spark, sf_dir)
    return (store.read_points(spark, root, bucket, "events")
            .select("series_key", "field", "value_double", "time_ns"))


def store_range_scan(spark, sf_dir):
    """The time-range scan on the store: partition (measurement, day) and
    row-group (time_ns) pruning."""
    from chronoline.sources import store
    root, bucket = _store_events(spark, sf_dir)
    return (store.read_points(spark, root, bucket, "events", RANGE_START_NS, RANGE_STOP_NS)
            .select("series_key", "field", "value_double", "time_ns"))


def store_series_scan(spark, sf_dir):
    """One series of the store, the first by key: the key reaches the files' Bloom filters."""
    from chronoline.sources import store
    root, bucket = _store_events(spark, sf_dir)
    key = events_points(spark, sf_dir).agg(F.min("series_key")).first()[0]
    return (store.read_points(spark, root, bucket, "events", series=key or "")
            .select("series_key", "field", "value_double", "time_ns"))


def store_series_estimate(spark, sf_dir):
    """Series of the whole store and of a range, from the sketches of its commit records,
    and whether the exact number lies within their bounds."""
    from chronoline.sources import store
    root, bucket = _store_events(spark, sf_dir)
    ev, out = events_points(spark, sf_dir), None
    for name, start, stop in (("all", None, None), ("range", RANGE_START_NS, RANGE_STOP_NS)):
        exact = P.in_range(ev, "events", start, stop).groupBy("measurement").agg(F.count_distinct("series_key").alias("n_exact"))
        found = store.series_estimate(spark, root, bucket, "events", start, stop).join(exact, "measurement").select(
            F.lit(name).alias("part"), "measurement", "n_exact", F.col("n_exact").between(F.col("least"), F.col("most")).alias("within_bounds"))
        out = found if out is None else out.unionByName(found)
    return out


def store_coalesced(spark, sf_dir):
    """Two batches with overlapping hours, one lowered to two partitions: hours of one
    proven batch are scanned, the shared ones upserted."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    root, ev = scratch_path(spark, "store"), events_points(spark, sf_dir)
    store.write_points(ev, root, "b", num_partitions=2)
    again = P.in_range(ev, "events", RANGE_START_NS, RANGE_STOP_NS)
    store.write_points(again.withColumn("value_double", -F.col("value_double")), root, "b", prove_keys=False)
    return (store.read_points(spark, root, "b", "events")
            .select("series_key", "field", "value_double", "time_ns"))


def stream_capped_drain(spark, sf_dir):
    """The cursor source in capped steps, run until nothing is left."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import drain, read_stream
    root, bucket = _store_events(spark, sf_dir)
    out, ck = scratch_path(spark, "capped-out"), scratch_path(spark, "capped-ck")
    drain(lambda: read_stream(spark, root, bucket, "events", output="points", maxDeltaPerTrigger=2 * COMPAT_DELTA_MS)
          .select("series_key", "field", "value_double", "time_ns")
          .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
          .trigger(availableNow=True).start())
    return spark.read.parquet(out)


def stream_gap_drain(spark, sf_dir):
    """Orders at the first day of their year, read in steps of 30 days at most: each step
    goes over the gap to the next stored hour, so it holds one year's orders."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.source import drain, read_stream
    root, out, ck = scratch_path(spark, "store"), scratch_path(spark, "gap-out"), scratch_path(spark, "gap-ck")
    years = table(spark, sf_dir, "orders").withColumn("t", F.trunc("o_orderdate", "year"))
    store.write_points(P.to_points(years, "orders", ["o_orderkey"], ["o_totalprice"], "t"), root, "b")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    drain(lambda: read_stream(spark, root, "b", "orders", output="points", maxDeltaPerTrigger=30 * 86_400_000)
          .select("time_ns", "series_key", "value_double").writeStream.foreachBatch(write)
          .option("checkpointLocation", ck).trigger(availableNow=True).start())
    steps = spark.read.parquet(out).groupBy("batch", "time_ns").agg(
        F.count("*").alias("n_orders"), F.sum("value_double").alias("sum_price"))
    return steps.select(F.dense_rank().over(Window.orderBy("batch")).cast("bigint").alias("step"), "time_ns",
                        "n_orders", F.round("sum_price", 2).alias("sum_price"))


def stream_late_drain(spark, sf_dir):
    """Batches committed out of order: one week, drained, then all other events, drained
    again.  The cursor reads what lies above it; the stream counts the rest as late."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.source import drain, read_stream
    root, ev = scratch_path(spark, "store"), events_points(spark, sf_dir)
    out, ck, said = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck"), []

    def start():
        q = (read_stream(spark, root, "b", "events", output="points").select("time_ns")
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        said.append(q)
        return q

    week = (F.col("time_ns") >= RANGE_START_NS) & (F.col("time_ns") < RANGE_STOP_NS)
    for part in (week, ~week):
        store.write_points(ev.where(part), root, "b")
        drain(start)
    ends = [src["endOffset"] for q in said for p in q.recentProgress for src in json.loads(p.json)["sources"]]
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_read")).withColumn(
        "n_late", F.lit(ends[-1]["late"] + ends[-1]["late_maybe"]).cast("bigint"))


def stream_late_read(spark, sf_dir):
    """Batches committed out of order, drained after each one by a query that starts
    again from its checkpoint: the late lane delivers what came in below the cursor."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.source import drain, read_stream
    root, ev = scratch_path(spark, "store"), events_points(spark, sf_dir)
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    week = (F.col("time_ns") >= RANGE_START_NS) & (F.col("time_ns") < RANGE_STOP_NS)
    for part in (week, ~week & (F.col("value_double") > 50), ~week & ~(F.col("value_double") > 50)):
        store.write_points(ev.where(part), root, "b")
        drain(lambda: read_stream(spark, root, "b", "events", output="points", late="read")
              .select("series_key", "field", "value_double", "time_ns")
              .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
              .trigger(availableNow=True).start())
    return spark.read.parquet(out)


def stream_tail_drain(spark, sf_dir):
    """The reference's cursor rule where the span is a multiple of the step: events by
    whole days, one step from the first to the last, which stays behind."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.source import read_stream
    day = F.col("time_ns") - F.pmod("time_ns", F.lit(86_400_000_000_000))
    ev = events_points(spark, sf_dir, keep=("event_id",)).withColumn("time_ns", day)
    root, out, ck = scratch_path(spark, "store"), scratch_path(spark, "tail-out"), scratch_path(spark, "tail-ck")
    store.write_points(P.upsert_latest(ev, order=["event_id"]), root, "b")
    lo, hi = _bounds(ev)
    q = (read_stream(spark, root, "b", "events", output="points", compat="true",
                     **{"delta-time": (hi - lo) // 1_000_000})
         .select("series_key", "time_ns", "value_double")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)


def stream_read_drain(spark, sf_dir):
    """The cursor source drained with availableNow into Parquet, read back as lines."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import read_stream
    root, bucket = _store_events(spark, sf_dir)
    out, ck = scratch_path(spark, "drain-out"), scratch_path(spark, "drain-ck")
    q = (read_stream(spark, root, bucket, "events", output="lines", mode="compat")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)


def stream_arrival_drain(spark, sf_dir):
    """Arrival-order read of the store (Spark's file stream source) drained with
    availableNow."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import read_stream
    root, bucket = _store_events(spark, sf_dir)
    out, ck = scratch_path(spark, "arrival-out"), scratch_path(spark, "arrival-ck")
    q = (read_stream(spark, root, bucket, "events", output="points", order="arrival")
         .select("series_key", "field", "value_double", "time_ns")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)


def stream_compat_drain(spark, sf_dir):
    """The reference's cursor rule (compat): one delta of event time per trigger
    while the maximum is above the cursor, run until it stops."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import read_stream
    root, bucket = _store_events(spark, sf_dir)
    out, ck = scratch_path(spark, "compat-out"), scratch_path(spark, "compat-ck")
    df = read_stream(spark, root, bucket, "events", output="lines", mode="compat",
                     compat="true", **{"delta-time": COMPAT_DELTA_MS})
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)


def stream_write_drain(spark, sf_dir):
    """Line files streamed through the sink into a store, read back as points."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.sink import write_stream
    lines_dir = scratch_path(spark, "lines")
    codec.encode_lines(events_points(spark, sf_dir), "safe").write.text(lines_dir)
    root, ck = scratch_path(spark, "sink-store"), scratch_path(spark, "sink-ck")
    src = spark.readStream.schema("value STRING").text(lines_dir)
    q = write_stream(src, root, "events_bucket", ck, trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return (store.read_points(spark, root, "events_bucket", "events")
            .select("series_key", "field", "value_double", "time_ns"))


def _document_lines(spark, sf_dir):
    """A folder of line files of ``documents``: whole texts as string fields, their line
    breaks inside the quotes."""
    from chronoline.session import scratch_path
    docs = table(spark, sf_dir, "documents").withColumn("t", F.col("doc_id").cast("bigint"))
    path = scratch_path(spark, "document-lines")
    codec.encode_lines(P.to_points(docs, "documents", ["lang", "source"], ["text"], "t"), "safe").write.text(path)
    return path


def _texts(points):
    return points.select("series_key", "time_ns", F.length("value_string").alias("n_chars"),
                         F.md5("value_string").alias("text_md5"))


def quoted_records(spark, sf_dir):
    """Line files whose strings hold line breaks, read and decoded as points."""
    from chronoline.sources.line_files import join_records, read_line_files
    return _texts(codec.decode_lines(join_records(read_line_files(spark, _document_lines(spark, sf_dir)))))


def stream_quoted_drain(spark, sf_dir):
    """The same files streamed through the sink into a store, read back as points."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.sources.line_files import read_line_files
    from chronoline.streaming.sink import write_stream
    root, ck = scratch_path(spark, "sink-store"), scratch_path(spark, "sink-ck")
    src = read_line_files(spark, _document_lines(spark, sf_dir), stream=True)
    q = write_stream(src, root, "b", ck, trigger={"availableNow": True}, line_breaks=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _texts(store.read_points(spark, root, "b", "documents"))


def _written_by_format(spark, sf_dir):
    """Events written by ``df.write.format("linepoints")``: root and bucket."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import qualified, register
    register(spark)
    root = qualified(spark, scratch_path(spark, "format-store"))
    (events_points(spark, sf_dir).write.format("linepoints").mode("append")
     .option("path", root).option("bucket", "b").save())
    return root, "b"


def format_range_scan(spark, sf_dir):
    """The format's batch reader: measurement, time range and a tag go down to its
    tasks, the value condition stays above them."""
    root, bucket = _written_by_format(spark, sf_dir)
    return (spark.read.format("linepoints").option("path", root).option("bucket", bucket).load()
            .where((F.col("measurement") == "events") & (F.col("time_ns") >= RANGE_START_NS)
                   & (F.col("time_ns") < RANGE_STOP_NS) & F.col("series_key").startswith("events,event_type=click,")
                   & (F.col("value_double") > 10))
            .select("series_key", "field", "value_double", "time_ns"))


def stream_format_write(spark, sf_dir):
    """Point files streamed into a store by ``writeStream.format("linepoints")``, read back
    by the format's batch reader."""
    from chronoline.session import scratch_path
    from chronoline.streaming.source import qualified, register
    register(spark)
    files, root = scratch_path(spark, "points"), qualified(spark, scratch_path(spark, "format-store"))
    events_points(spark, sf_dir).write.parquet(files)
    src = spark.readStream.schema(spark.read.parquet(files).schema).parquet(files)
    q = (src.withColumn("written_at", F.current_timestamp()).writeStream.format("linepoints")
         .option("path", root).option("bucket", "b")
         .option("checkpointLocation", qualified(spark, scratch_path(spark, "format-ck")))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return (spark.read.format("linepoints").option("path", root).option("bucket", "b").load()
            .select("series_key", "field", "value_double", "time_ns"))


def stream_upsert(spark, sf_dir):
    """Versions of points streamed in several batches, in no order: the state keeps each
    key's latest by ``event_id``, whichever batch brings it."""
    from chronoline.session import scratch_path
    from chronoline.sources import store
    from chronoline.streaming.stateful import upsert_stream, write_upserts
    files, root = scratch_path(spark, "versions"), scratch_path(spark, "store")
    ev = events_points(spark, sf_dir, keep=("event_id",))
    day = F.col("time_ns") - F.pmod("time_ns", F.lit(86_400_000_000_000))
    versions = ev.withColumn("time_ns", day).repartition(4, F.xxhash64("event_id"))
    versions.write.parquet(files)
    src = (spark.readStream.schema(spark.read.parquet(files).schema).option("maxFilesPerTrigger", 1).parquet(files))
    q = write_upserts(upsert_stream(src, ["event_id"], SESSION_SPAN), root, "b", scratch_path(spark, "upsert-ck"),
                      trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return store.read_points(spark, root, "b", "events").select("series_key", "field", "time_ns", "value_double")


def stream_sessions(spark, sf_dir):
    """Line files decoded in a stream, then event-time sessions of each series; those
    that the watermark has closed."""
    from chronoline.session import scratch_path
    from chronoline.streaming.stateful import sessions
    lines, out, ck = (scratch_path(spark, f"sessions-{x}") for x in ("lines", "out", "ck"))
    codec.encode_lines(events_points(spark, sf_dir), "safe").write.text(lines)
    pts = codec.decode_lines(spark.readStream.schema("value STRING").text(lines))
    q = (sessions(pts, SESSION_GAP, SESSION_DELAY).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)


QUERIES = {
    "range_scan": range_scan,
    "first_last_time": first_last_time,
    "series_stats": series_stats,
    "series_cardinality": series_cardinality,
    "first_last_record": first_last_record,
    "range_count": range_count,
    "range_count_by_series": range_count_by_series,
    "time_slices": time_slices,
    "slice_counts": slice_counts,
    "balanced_slices": balanced_slices,
    "incremental_batches": incremental_batches,
    "tail_held": tail_held,
    "late_rows": late_rows,
    "encode_compat": encode_compat,
    "encode_safe": encode_safe,
    "encode_wide": encode_wide,
    "decode_lines": decode_lines,
    "bad_lines": bad_lines,
    "bad_line_reasons": bad_line_reasons,
    "bad_points": bad_points,
    "decode_no_time": decode_no_time,
    "ns_parts": ns_parts,
    "ns_add": ns_add,
    "ns_units": ns_units,
    "ns_from_iso": ns_from_iso,
    "to_zone": to_zone,
    "upsert_latest": upsert_latest,
    "upsert_long": upsert_long,
    "wide_points": wide_points,
    "wide_map": wide_map,
    "wide_variant": wide_variant,
    "store_roundtrip": store_roundtrip,
    "store_range_scan": store_range_scan,
    "store_coalesced": store_coalesced,
    "store_series_scan": store_series_scan,
    "store_series_estimate": store_series_estimate,
    "stream_read_drain": stream_read_drain,
    "stream_write_drain": stream_write_drain,
    "quoted_records": quoted_records,
    "stream_quoted_drain": stream_quoted_drain,
    "stream_arrival_drain": stream_arrival_drain,
    "stream_compat_drain": stream_compat_drain,
    "stream_capped_drain": stream_capped_drain,
    "stream_gap_drain": stream_gap_drain,
    "stream_late_drain": stream_late_drain,
    "stream_late_read": stream_late_read,
    "stream_tail_drain": stream_tail_drain,
    "stream_upsert": stream_upsert,
    "stream_sessions": stream_sessions,
    "format_range_scan": format_range_scan,
    "stream_format_write": stream_format_write,
}


def flagship(spark, sf_dir):
    """events -> points -> safe lines -> decoded points -> measurement and time
    range -> per-series records, first and last time.  All narrow until the one
    aggregation."""
    lines = codec.encode_lines(events_points(spark, sf_dir), mode="safe")
    pts = codec.decode_lines(lines)
    return P.series_stats(P.in_range(pts, "events", RANGE_START_NS, RANGE_STOP_NS))


QUERIES["flagship"] = flagship
