"""Structured Streaming over the batch functions."""

from ledgerlake.streaming.closed_hours import ClosedHours
from ledgerlake.streaming.micro_batch import hourly_counts, matched_packets, run_available

__all__ = ["ClosedHours", "hourly_counts", "matched_packets", "run_available"]
