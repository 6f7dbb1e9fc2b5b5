"""Sinks and record shapers."""

from eventide.sinks.files import stream_rolling_files, write_delimited, write_rolling
from eventide.sinks.records import (
    bus_payload, document_records, hash_records, latest_by_key, upsert_latest_batch,
)

__all__ = ["stream_rolling_files", "write_delimited", "write_rolling", "bus_payload",
           "document_records", "hash_records", "latest_by_key", "upsert_latest_batch"]
