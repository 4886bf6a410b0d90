"""Reading and writing: parquet tables, topics, keyed stage tables."""
