"""Joins that recur in the models.

No join carries a broadcast hint: Spark broadcasts a side only when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, with skewed partitions split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi(df: DataFrame, keys_from: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key occurs in ``keys_from``; no ``distinct`` is needed for a semi join."""
    return df.join(keys_from.select(*keys), list(keys), "left_semi")


def lookup(df: DataFrame, table: DataFrame, on: dict[str, Column], take: dict[str, str]) -> DataFrame:
    """Left join on computed keys: ``on`` maps a column of ``table`` to an expression over ``df``.

    ``take`` maps columns of ``table`` to their new names in the result.
    """
    left = df.withColumns({f"_on{i}": expr for i, expr in enumerate(on.values())})
    right = table.select(
        *[F.col(name).alias(f"_at{i}") for i, name in enumerate(on)],
        *[F.col(name).alias(new) for name, new in take.items()],
    )
    same = None
    for i in range(len(on)):
        part = F.col(f"_on{i}") == F.col(f"_at{i}")
        same = part if same is None else same & part
    scratch = [f"{p}{i}" for p in ("_on", "_at") for i in range(len(on))]
    return left.join(right, same, "left").drop(*scratch)


def pair_nth(left: DataFrame, right: DataFrame, keys: Sequence[str], rank: str, how: str = "inner") -> DataFrame:
    """The n-th row of one side with the n-th of the other; both sides already carry ``rank``."""
    return left.join(right, [*keys, rank], how)


def earliest_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows that have any match; the earliest match adds no column, so this is a semi join."""
    return left.join(right.select(*keys), list(keys), "left_semi")


def with_next(df: DataFrame, index: str) -> DataFrame:
    """Positions ``i`` and ``i + 1`` of every row, each once."""
    following = df.withColumn(index, F.col(index) + 1)
    return df.unionByName(following).distinct()


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right).unionByName(right.subtract(left))


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a side that grows with the tables: its join sorts and merges at any size.

    A few columns of a table with VARIANTs, which count as two kilobytes each, are taken for far smaller than they are, and
    would be broadcast through the driver; AQE does not take a broadcast back where that needs another shuffle.
    """
    return df.hint("merge")
