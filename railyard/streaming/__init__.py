"""Structured Streaming: raw append from snapshot files and incremental keep-latest (foreachBatch)."""
