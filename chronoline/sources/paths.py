"""Store paths as Arrow names them and partition directories as Spark writes them (no
Spark import: this runs in tasks of the format's readers and writers too)."""

from __future__ import annotations

# Characters Spark percent-encodes (%XX, upper-case hex) in a
# partition directory value, besides the control characters 0x01-0x1F.
_PATH_ESCAPED = '"#%\'*/:=?\\\x7f{[]^'


def escape_partition_value(v: str) -> str:
    """A partition value as Spark writes it in a ``name=value`` directory."""
    return "".join(f"%{ord(ch):02X}" if (ch in _PATH_ESCAPED or "\x01" <= ch <= "\x1f") else ch
                   for ch in v)


# Schemes that Hadoop and Arrow name differently.
_ARROW_SCHEME = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def arrow_uri(uri: str) -> str:
    """A store path as Arrow's file systems name it.  It must have a scheme: a path
    without one means the cluster's default file system, which only the driver knows
    (``chronoline.streaming.source.qualified``)."""
    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        raise ValueError(f"store path {uri!r} has no scheme; use read_stream or chronoline.streaming.source.qualified")
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    return f"{_ARROW_SCHEME.get(scheme, scheme)}:{rest}"


def arrow_path(uri: str):
    """Arrow's file system of a store path, and the path on it."""
    import pyarrow.fs as pafs
    if uri.startswith("/"):     # callers other than the data source: a plain local path
        return pafs.LocalFileSystem(), uri
    uri = arrow_uri(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)
