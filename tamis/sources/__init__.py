"""Readers and writers: topics (Kafka or files), delimited files, parquet."""

from tamis.sources.files import (
    read_csv_infer,
    read_csv_strings,
    read_delimited_rows,
    read_parquet_or_none,
    write_csv,
)
from tamis.sources.topics import Topics, read_topic, spread, stream_topic, write_topic

__all__ = [
    "Topics",
    "read_csv_infer",
    "read_csv_strings",
    "read_delimited_rows",
    "read_parquet_or_none",
    "read_topic",
    "spread",
    "stream_topic",
    "write_csv",
    "write_topic",
]
