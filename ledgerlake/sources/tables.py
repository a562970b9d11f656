"""Seeds, plain tables and plain sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A seed CSV with its declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_full(df: DataFrame, path: str) -> None:
    """Rebuild the table (the whole previous content is replaced)."""
    df.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str) -> None:
    """Add rows; used for response landing, run logs and stored check failures."""
    df.write.mode("append").parquet(path)
