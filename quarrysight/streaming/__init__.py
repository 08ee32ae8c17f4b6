"""Structured Streaming: incremental file ingest and windowed KPIs."""
