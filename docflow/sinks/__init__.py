"""Writers (K1-K10): partitioned Parquet tables, JSON lines, ledgers."""
