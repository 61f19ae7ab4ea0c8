"""Whole runs: ingest a window, catch up, backfill."""
