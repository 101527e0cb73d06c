"""Readers: delimited text files, protected shards, legacy JSONL, fixtures."""
