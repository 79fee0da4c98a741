"""DataFrame operators on long point tables: filters, probes, upsert, wide, slices."""
