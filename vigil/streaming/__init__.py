"""Structured Streaming ingestion (STR-01..05)."""
