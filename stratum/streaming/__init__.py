"""Incremental bronze landing with Structured Streaming."""

from stratum.streaming.landing import land_new_files

__all__ = ["land_new_files"]
