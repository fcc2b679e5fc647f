"""Scans (reference files, raw tables, feed snapshots) and sinks (enforced append, materialise, DDL)."""
