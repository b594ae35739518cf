"""DataFrame operators: dedup, metrics, detail search, region, upsert."""
