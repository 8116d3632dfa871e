"""Structured Streaming: the same operators as micro-batches.

Tables hold each batch exactly once; envelopes reach an error topic at least once.
"""

from tamis.streaming.errors import (
    error_totals,
    running_totals,
    stream_error_records,
    stream_error_summary,
    stream_error_totals,
)
from tamis.streaming.ingest import ingest_stream, medallion_stream

__all__ = [
    "error_totals",
    "ingest_stream",
    "medallion_stream",
    "running_totals",
    "stream_error_records",
    "stream_error_summary",
    "stream_error_totals",
]
