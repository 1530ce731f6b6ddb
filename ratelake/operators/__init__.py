"""DataFrame -> DataFrame operators (rollups, windows, dedup, upsert, checks)."""
