"""Structured Streaming ingest of lead messages into bronze."""
