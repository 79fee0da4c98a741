"""The Parquet point store: batch write, read, commit records."""
