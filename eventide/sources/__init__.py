"""Sources: text lines, positional/delimited record parsing, access logs,
message-bus values, in-memory rows, and the driver tables."""

from eventide.sources.text import document_lines, read_lines, stream_lines
from eventide.sources.parse import parse_access_log, parse_positional
from eventide.sources.bus import bus_records_to_rows, lines_to_bus_records, read_bus
from eventide.sources.memory import rows_to_frame
from eventide.sources.tables import load_table

__all__ = ["document_lines", "read_lines", "stream_lines", "parse_access_log", "parse_positional",
           "bus_records_to_rows", "lines_to_bus_records", "read_bus", "rows_to_frame", "load_table"]
