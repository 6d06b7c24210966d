"""Rate-limited loading with Structured Streaming."""

from keyedload.streaming.throttle import stream_load, throttled_files

__all__ = ["stream_load", "throttled_files"]
