"""Structured Streaming form of the incremental file load."""

from .incremental import stream_incremental_load

__all__ = ["stream_incremental_load"]
