"""Data checks. Each returns violations as a DataFrame; an empty result passes.

``where`` limits a check to part of a table and is applied first, so it reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.gaps import sequence_gaps
from ledgerlake.operators.joins import symmetric_difference


def _scoped(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def gaps(
    df: DataFrame, column: str, partition_by: Sequence[str] = (), where=None, time: str = "block_timestamp",
    width: int = 100_000,
) -> DataFrame:
    """Numbers whose predecessor is missing, largest gap first."""
    rows = _scoped(df, where).select(time, *partition_by, column)
    found = sequence_gaps(rows, column, partition_by, width)
    return found.select(time, *partition_by, f"prev_{column}", column, "gap").orderBy(F.desc("gap"), column)


def tx_gaps(df: DataFrame, blocks: DataFrame, tx: str, block: str, declared: str) -> DataFrame:
    """Blocks whose number of distinct transactions differs from the declared one.

    A block without any transaction row is not reported: its count is unknown, not zero.
    """
    counted = df.groupBy(block).agg(F.count_distinct(tx).alias("model_tx_count"))
    joined = blocks.select(block, declared).join(counted, block, "left")
    return joined.where(F.col(declared) != F.col("model_tx_count"))


def unique(df: DataFrame, columns: Sequence[str], where=None) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    counted = _scoped(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _scoped(df, where).where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    """Values outside the list, with their count; nulls pass."""
    outside = _scoped(df, where).where(~F.col(column).isin(list(values)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def column_types(df: DataFrame, expected: dict[str, Sequence[str]]) -> DataFrame:
    """Columns whose type is not among the expected ones (a schema check; no data is read)."""
    types = dict(df.dtypes)
    wrong = [(c, types.get(c)) for c, kinds in expected.items() if types.get(c) not in kinds]
    return df.sparkSession.createDataFrame(wrong, "column string, type string")


def matches(df: DataFrame, column: str, pattern: str, where=None) -> DataFrame:
    """Rows whose value does not contain a match; nulls pass."""
    return _scoped(df, where).where(~F.col(column).rlike(pattern))


def recent(df: DataFrame, column: str, days: int, now: datetime, where=None) -> DataFrame:
    """One row when the newest value is older than ``days`` days (or there is none)."""
    newest = _scoped(df, where).agg(F.max(column).alias("newest"))
    limit = F.lit(now - timedelta(days=days))
    return newest.where(F.col("newest").isNull() | (F.col("newest") < limit))


def differs_from(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of one side only."""
    return symmetric_difference(actual, expected)


def report(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(check, severity, violations) for named checks: ``name -> (severity, violations)``."""
    out = None
    for name, (severity, violations) in checks.items():
        row = violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check"), F.lit(severity).alias("severity"), "violations"
        )
        out = row if out is None else out.unionByName(row)
    return out
