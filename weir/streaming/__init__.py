"""Structured Streaming drivers (STM-1, STM-2)."""

from weir.streaming.ingest import append_stream, collection_stream, first_within, ingest_stream, last_within, late_rows

__all__ = ["append_stream", "collection_stream", "first_within", "ingest_stream", "last_within", "late_rows"]
