"""End-to-end jobs composed from operators: ingest, maintenance, checks."""
