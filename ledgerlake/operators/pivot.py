"""Key/value rows to columns or objects, and object arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_known(
    df: DataFrame, grain: Sequence[str], wanted: Sequence[str], key: str = "attribute_key", value: str = "attribute_value"
) -> DataFrame:
    """One row per grain with a column per wanted key.

    The aggregate holds one value per wanted key and is combined on the map side; the attributes of one event are
    stored next to each other, so nearly all of the reduction happens before the shuffle. Of a key that occurs twice in
    a grain the greatest value is kept; ``repeated_keys`` lists such grains.
    """
    columns = [F.max(F.when(F.col(key) == k, F.col(value))).alias(k) for k in wanted]
    return df.groupBy(*grain).agg(*columns)


def repeated_keys(df: DataFrame, grain: Sequence[str], key: str = "attribute_key") -> DataFrame:
    """(grain, key, n) of keys that a grain holds more than once: a data check for ``pivot_known``."""
    counted = df.groupBy(*grain, key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def object_of(
    df: DataFrame, grain: Sequence[str], key: str, value: str, out: str = "j"
) -> DataFrame:
    """Key/value rows as one map per grain; null values are skipped and a repeated key is an error.

    Meant for grains of one event or one transaction, whose size the payload bounds.
    """
    pairs = F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(key), F.col(value))))
    return df.groupBy(*grain).agg(F.map_from_entries(pairs).alias(out))


def object_merge(left: Column, right: Column) -> Column:
    """Fields of both maps; the right one wins. Independent of the session's duplicate-key policy."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)


def object_delete(obj: Column, *names: str) -> Column:
    return F.map_filter(obj, lambda k, _: ~k.isin(*names))


def object_insert(obj: Column, name: str, value: Column) -> Column:
    return F.map_concat(object_delete(obj, name), F.create_map(F.lit(name), value))
