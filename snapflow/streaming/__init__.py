"""Structured Streaming form of the daily increment over the landing folders."""

from snapflow.streaming.latest import latest_order_key, null_counts, read_latest, stream_latest

__all__ = ["latest_order_key", "null_counts", "read_latest", "stream_latest"]
