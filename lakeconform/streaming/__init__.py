"""Streams: windows over event time with kept state."""

from lakeconform.streaming.windows import closed_windows, event_stream, run_windows

__all__ = ["closed_windows", "event_stream", "run_windows"]
