"""Structured Streaming ingest."""

from tidemark.streaming.ingest import append_stage_stream, stream_ingest

__all__ = ["append_stage_stream", "stream_ingest"]
