"""Readers for raw responses, sink logs, seeds and number tables."""

from ledgerlake.sources.numbers import numbers
from ledgerlake.sources.responses import keep_answered, read_responses, shape_responses, stream_responses
from ledgerlake.sources.sink_log import stream_results
from ledgerlake.sources.tables import read_seed, read_table, write_append, write_full

__all__ = [
    "numbers", "keep_answered", "read_responses", "shape_responses", "stream_responses", "stream_results", "read_seed", "read_table",
    "write_append", "write_full",
]
