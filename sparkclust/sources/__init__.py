"""Matrix readers and writers (CSV / Parquet)."""
