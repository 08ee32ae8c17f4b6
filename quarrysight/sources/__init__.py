"""Readers (JSON/CSV/text/parquet), ingest metadata, table writes, upsert
and table contracts."""
