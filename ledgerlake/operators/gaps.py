"""Missing numbers, calendars and page lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordered import id_chunk, previous_value

GAP_PIECE = 10_000


def sequence_gaps(df: DataFrame, column: str, partition_by: Sequence[str] = (), width: int = 100_000) -> DataFrame:
    """Rows whose predecessor is not one less: ``prev_<column>``, ``<column>`` and the size of the gap."""
    prev = f"prev_{column}"
    chained = previous_value(df, partition_by, [column], id_chunk(F.col(column), width), F.col(column), prev)
    return chained.where(F.col(column) - F.col(prev) != 1).withColumn("gap", F.col(column) - F.col(prev) - 1)


def fill_gaps(gaps: DataFrame, low: str, high: str, out: str) -> DataFrame:
    """One row per number strictly between ``low`` and ``high``.

    A long gap is first cut into pieces, so no row ever holds the whole gap as one array.
    """
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(high) - F.col(low) - 2) / GAP_PIECE))
    cut = gaps.where(F.col(high) - F.col(low) > 1).withColumn("_piece", F.explode(pieces))
    first = F.col(low) + 1 + F.col("_piece") * GAP_PIECE
    last = F.least(first + GAP_PIECE - 1, F.col(high) - 1)
    return cut.withColumn(out, F.explode(F.sequence(first, last))).drop("_piece")


def missing_ids(universe: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Numbers of ``universe`` that ``present`` lacks, as often as ``universe`` holds them."""
    return universe.select(column).join(present.select(column), column, "left_anti")


def pages(count: Column, size: int, first: int = 1) -> Column:
    """Page numbers that ``count`` items need, as an array (empty where no page is needed)."""
    last = F.ceil(count / F.lit(size)).cast("bigint")
    return F.when(last >= first, F.sequence(F.lit(first).cast("bigint"), last)).otherwise(
        F.array().cast("array<bigint>")
    )


def spine(ranges: DataFrame, start: str, end: Column, out: str, step: str = "1 day") -> DataFrame:
    """One row per entity and date from ``start`` to ``end``; a calendar without a range join."""
    dates = F.sequence(F.col(start), end, F.expr(f"interval {step}"))
    return ranges.withColumn(out, F.explode(dates))
