"""Operators of a training-data pipeline: tokens, shards, near-duplicates,
classifiers, scans, search and mixing.  Nothing else in the package imports it."""
