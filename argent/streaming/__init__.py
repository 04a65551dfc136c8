"""Structured Streaming forms of the incremental load (ST1-ST4)."""

from argent.streaming.micro import bronze_stream, run_incremental, stream_upsert

__all__ = ["bronze_stream", "run_incremental", "stream_upsert"]
