"""Number tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def numbers(spark: SparkSession, last: int, first: int = 1, name: str = "height") -> DataFrame:
    """``first`` .. ``last``; the range is generated in the tasks, nothing is stored or shipped."""
    return spark.range(first, last + 1).toDF(name)
