"""Structured Streaming entry: vendor drop folder -> one run per file."""
