"""RPC responses stored as JSON lines, one object per response.

A line holds ``block_number``, ``data`` and optionally ``metadata``. Files lie in folders whose path names the block
range they cover, so the range can be read off the path.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import safe_json, vlong, vstr, vvar

# RPC error codes that will be retried, so their responses are not kept.
RETRYABLE_CODES = [
    "-32000", "-32001", "-32002", "-32003", "-32004", "-32005", "-32006", "-32007", "-32008", "-32009", "-32010",
]


def partition_from_path(file_name: Column, position: int = 4) -> Column:
    """The block range's first number: the part before ``_`` of one path element (counted from 1).

    An element may be a plain ``<first>_<last>`` or a partition folder ``name=<first>_<last>``.
    """
    element = F.regexp_replace(F.split_part(file_name, F.lit("/"), F.lit(position)), "^[^=]*=", "")
    return F.split_part(element, F.lit("_"), F.lit(1)).try_cast("bigint")


def keep_answered(df: DataFrame, data: str = "data") -> DataFrame:
    """Drop responses that carry a retryable error; other errors stay."""
    code = vstr(F.col(data), "error.code")
    return df.where(code.isNull() | ~code.isin(RETRYABLE_CODES))


def shape_responses(lines: DataFrame, key: str = "block_number", root: str = "") -> DataFrame:
    """Text lines with ``_file`` and ``_modified`` to the published response columns.

    ``root`` is the part of the file location that precedes the object name.
    """
    name = F.when(F.col("_file").contains(root), F.split_part(F.col("_file"), F.lit(root), F.lit(-1))).otherwise(
        F.col("_file")
    ) if root else F.col("_file")
    parsed = lines.withColumn("value", safe_json("value")).withColumn("file_name", name)
    shaped = parsed.select(
        vlong("value", key).alias(key),
        vvar("value", "data").alias("data"),
        F.col("_modified").cast("timestamp_ntz").alias("_inserted_timestamp"),
        F.md5(F.coalesce(vstr("value", key), F.lit(""))).alias("id"),
        vvar("value", "metadata").alias("metadata"),
        "file_name",
        partition_from_path(F.col("file_name")).alias("_partition_by_block_id"),
        "value",
    )
    return keep_answered(shaped)


def read_responses(
    spark: SparkSession,
    path: str,
    root: str = "",
    recent_days: int | None = None,
    now: datetime | None = None,
    key: str = "block_number",
) -> DataFrame:
    """All responses under ``path``, or only those in files of the last ``recent_days`` days.

    Old files are skipped while listing (``modifiedAfter``), before anything is opened.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if recent_days is not None:
        since = (now or datetime.now(timezone.utc).replace(tzinfo=None)) - timedelta(days=recent_days)
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_modified"),
    )
    return shape_responses(lines, key, root)


def stream_responses(spark: SparkSession, path: str, root: str = "", key: str = "block_number") -> DataFrame:
    """The same rows as a stream; the checkpoint of the query remembers which files were read."""
    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_modified"),
        )
    )
    return shape_responses(lines, key, root)
