"""Structured Streaming jobs."""

from millrace.streaming.envelopes import (
    ingest_available,
    land_available,
    landed_records,
    read_envelopes,
    stream_decode,
    stream_latest,
    write_stream,
)
from millrace.streaming.joins import join_within
from millrace.streaming.windows import (
    Windows,
    all_windows,
    closed_windows,
    first_within,
    late_rows,
    latest_until_idle,
    open_windows,
    window_available,
)

__all__ = [
    "Windows",
    "all_windows",
    "closed_windows",
    "first_within",
    "ingest_available",
    "join_within",
    "land_available",
    "landed_records",
    "late_rows",
    "latest_until_idle",
    "open_windows",
    "read_envelopes",
    "stream_decode",
    "stream_latest",
    "window_available",
    "write_stream",
]
