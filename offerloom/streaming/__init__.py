"""Structured Streaming jobs over the same column functions."""

from offerloom.streaming.jobs import (
    publish_batches,
    stream_frontier,
    stream_offers,
    stream_popularity,
)

__all__ = [name for name in dir() if not name.startswith("_")]
