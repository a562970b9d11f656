"""Incremental builds: which rows to read, and how a batch enters its table."""

from ledgerlake.incremental.table import KeyedTable
from ledgerlake.incremental.watermark import earliest_touched_hour, lookback_days, since_mark, since_mark_minus

__all__ = ["KeyedTable", "earliest_touched_hour", "lookback_days", "since_mark", "since_mark_minus"]
