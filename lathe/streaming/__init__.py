"""Streaming: fitted preparation and models applied to streaming DataFrames."""

from lathe.streaming.scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]
