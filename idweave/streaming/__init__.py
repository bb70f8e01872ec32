"""Structured Streaming driver for the incremental history job."""

from idweave.streaming.snapshot_stream import advance_from_stream, advance_batch

__all__ = ["advance_from_stream", "advance_batch"]
