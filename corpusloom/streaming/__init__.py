"""Structured Streaming forms of ingest, staging, dedup and counters."""
