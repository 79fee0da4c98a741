"""chronoline: time-series points on Spark.

Points live in a Parquet point store; they are read as a batch or as an
incremental event-time stream, turned into line-protocol text and back with
Column expressions, probed for first/last/count per series, and appended from
streams so that a replayed batch leaves the same data.
"""

__version__ = "0.1.0"

from chronoline.functions.codec import (bad_lines, bad_points, decode_lines, encode_lines,  # noqa: E402
                                        encode_wide_lines, parse_lines)
from chronoline.functions.nanos import (millis_to_ns, ns_add, ns_from_iso,  # noqa: E402
                                        ns_from_timestamp, ns_from_timestamp_ntz, ns_split,
                                        ns_to_iso, ns_to_timestamp, seconds_to_ns, to_ns, to_zone)
from chronoline.operators.points import (first_last_records, first_last_time,  # noqa: E402
                                         in_range, range_count, series_cardinality,
                                         series_stats, to_points, to_wide, upsert_latest)
from chronoline.operators.slices import (balanced_bounds, incremental_batches,  # noqa: E402
                                         late_counts, late_rows, plan_slices, slice_counts,
                                         slice_of, tail_held, time_slices)
from chronoline.session import get_session  # noqa: E402
from chronoline.sources.store import read_lines, read_points, write_points  # noqa: E402
from chronoline.streaming.sink import write_stream  # noqa: E402
from chronoline.streaming.source import read_stream  # noqa: E402

__all__ = [
    "bad_lines", "bad_points", "decode_lines", "encode_lines", "encode_wide_lines", "parse_lines",
    "millis_to_ns", "ns_add", "ns_from_iso", "ns_from_timestamp", "ns_from_timestamp_ntz",
    "ns_split", "ns_to_iso", "ns_to_timestamp", "seconds_to_ns", "to_ns", "to_zone",
    "first_last_records", "first_last_time", "in_range", "range_count", "series_cardinality",
    "series_stats", "to_points", "to_wide", "upsert_latest",
    "balanced_bounds", "incremental_batches", "late_counts", "late_rows", "plan_slices",
    "slice_counts", "slice_of", "tail_held", "time_slices",
    "get_session", "read_lines", "read_points", "write_points",
    "write_stream", "read_stream",
]
