"""Options of the point store, the stream source and the stream sink.

Names and defaults follow the reference's option table where they carry over
(``bucket``, ``measurement``, ``delta-time``, ``time-zone``, ``batchSize``,
``numPartitions``); the server connection options are replaced by ``path``.
Every check runs on the driver before any job starts and raises ``ValueError``
naming the option.
"""

from __future__ import annotations

from dataclasses import dataclass

# Option defaults.
DEFAULT_DELTA_TIME_MS = 1000
# The reference's batchSize (1000) counted rows per network write request.  Here
# it caps rows per Parquet file; applying 1000 by default would make tiny files,
# so by default files are not capped (Spark sizes them by task).
DEFAULT_BATCH_SIZE = None
DEFAULT_TIME_ZONE = "UTC"
DEFAULT_NUM_SLICES = 4
DEFAULT_MAX_ROWS_PER_SLICE = 2_000_000


def _get(options: dict, name: str, *aliases: str):
    for k in (name, *aliases):
        if k in options and options[k] is not None:
            return options[k]
        for ok in options:
            if ok.lower() == k.lower() and options[ok] is not None:
                return options[ok]
    return None


def require(options: dict, name: str) -> str:
    v = _get(options, name)
    if v is None or str(v) == "":
        raise ValueError(f"Option '{name}' is required")
    return str(v)


def _int(options: dict, name: str, default, minimum: int | None = None, aliases=()):
    v = _get(options, name, *aliases)
    if v is None:
        return default
    try:
        n = int(str(v))
    except ValueError:
        raise ValueError(f"Option '{name}' must be an integer, got {v!r}") from None
    if minimum is not None and n < minimum:
        raise ValueError(f"Invalid value `{n}` for option `{name}`. The minimum value is {minimum}.")
    return n


def _bool(options: dict, name: str, default: bool) -> bool:
    v = _get(options, name)
    if v is None:
        return default
    s = str(v).strip().lower()
    if s in ("true", "1", "yes"):
        return True
    if s in ("false", "0", "no"):
        return False
    raise ValueError(f"Option '{name}' must be true or false, got {v!r}")


def _choice(options: dict, name: str, default: str, allowed: tuple) -> str:
    v = _get(options, name)
    if v is None:
        return default
    v = str(v).lower()
    if v not in allowed:
        raise ValueError(f"Option '{name}' must be one of {list(allowed)}, got {v!r}")
    return v


@dataclass(frozen=True)
class SourceOptions:
    path: str
    bucket: str
    measurement: str
    delta_time_ms: int = DEFAULT_DELTA_TIME_MS
    time_zone: str = DEFAULT_TIME_ZONE
    num_slices: int = DEFAULT_NUM_SLICES
    max_rows_per_slice: int = DEFAULT_MAX_ROWS_PER_SLICE
    lateness_ms: int = 0
    max_delta_per_trigger_ms: int | None = None
    compat: bool = False
    dedupe: bool = True
    balance: str = "time"
    late: str = "count"

    @property
    def delta_ns(self) -> int:
        return self.delta_time_ms * 1_000_000

    @classmethod
    def parse(cls, options: dict) -> "SourceOptions":
        return cls(
            path=require(options, "path"),
            bucket=require(options, "bucket"),
            measurement=require(options, "measurement"),
            delta_time_ms=_int(options, "delta-time", DEFAULT_DELTA_TIME_MS, 1, ("deltaTime",)),
            time_zone=str(_get(options, "time-zone", "timeZone") or DEFAULT_TIME_ZONE),
            num_slices=_int(options, "numSlices", DEFAULT_NUM_SLICES, 1),
            max_rows_per_slice=_int(options, "maxRowsPerSlice", DEFAULT_MAX_ROWS_PER_SLICE, 1),
            lateness_ms=_int(options, "lateness", 0, 0),
            max_delta_per_trigger_ms=_int(options, "maxDeltaPerTrigger", None, 1),
            compat=_bool(options, "compat", False),
            dedupe=_bool(options, "dedupe", True),
            balance=_choice(options, "balance", "time", ("time", "count")),
            late=_choice(options, "late", "count", ("count", "read")),
        )


@dataclass(frozen=True)
class SinkOptions:
    path: str
    bucket: str
    batch_size: int | None = DEFAULT_BATCH_SIZE
    num_partitions: int | None = None
    compat: bool = False
    rebalance: bool = True

    @classmethod
    def parse(cls, options: dict) -> "SinkOptions":
        return cls(
            path=require(options, "path"),
            bucket=require(options, "bucket"),
            batch_size=_int(options, "batchSize", DEFAULT_BATCH_SIZE, 1),
            num_partitions=_int(options, "numPartitions", None, 1),
            compat=_bool(options, "compat", False),
            rebalance=_bool(options, "rebalance", True),
        )
