"""Latest-row and highest-group selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark plans this as a group limit ahead of the shuffle: a map task sends at most one row per key, however
    many copies a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_latest", rank).where(F.col("_latest") == 1).drop("_latest")


def nth_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", rank).where(F.col("_nth") == n).drop("_nth")


def keep_max_ties(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows whose ``by`` equals the greatest of their key (re-org removal: the rows of the last block).

    The maxima are pre-aggregated, and the join back can be split by the skew rule, so a hot key does not end in
    one task as it would with ``rank`` over the key.
    """
    top = df.groupBy(*keys).agg(F.max(by).alias("_top"))
    left, right = df.alias("l"), top.alias("r")
    same = F.col(f"l.{by}") == F.col("r._top")
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, same).select("l.*")


def first_value_by(df: DataFrame, keys: Sequence[str], value: Column, order: Column, out: str) -> DataFrame:
    """``value`` of the row with the smallest ``order`` per key; combined on the map side."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(out))


def tombstoned(df: DataFrame, flagged: DataFrame, key: str) -> DataFrame:
    """Drop every row whose key was ever flagged, with ``NOT IN`` null rules.

    A null among the flagged keys empties the result, and a row with a null key survives only an empty list. Both
    are decided by one scalar aggregate, so the join itself stays a plain anti join that can shuffle.
    """
    counts = F.struct(F.count(F.lit(1)).alias("all"), F.count_if(F.col(key).isNull()).alias("nulls"))
    kept = df.join(flagged.select(key), key, "left_anti").select(*df.columns)
    counted = kept.withColumn("_flags", flagged.agg(counts).scalar())
    empty, plain = F.col("_flags.all") == 0, F.col("_flags.nulls") == 0
    return counted.where(empty | (plain & F.col(key).isNotNull())).drop("_flags")
