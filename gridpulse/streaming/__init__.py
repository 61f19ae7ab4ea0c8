"""Incremental ingestion of landed pages as a stream."""
