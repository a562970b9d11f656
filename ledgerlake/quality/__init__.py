"""Checks that return the rows (or groups) that violate them."""

from ledgerlake.quality.checks import (
    accepted_values, column_types, differs_from, gaps, matches, not_null, recent, report, tx_gaps, unique,
)
from ledgerlake.quality.quarantine import quarantined
from ledgerlake.quality.stored import CheckPlan

__all__ = [
    "CheckPlan", "accepted_values", "column_types", "differs_from", "gaps", "matches", "not_null", "quarantined", "recent", "report", "tx_gaps",
    "unique",
]
