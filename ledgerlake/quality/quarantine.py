"""Odd rows beside clean ones, written in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import write_whole

ODD = "_odd"


def quarantined(df: DataFrame, reasons: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(clean rows without ``reasons``, odd rows with them). ``reasons`` is an array column; a row is odd if it has any.

    Both sides lie in ``folder``, in partitions of their own, so the input is computed once and each side reads its own files.
    """
    write_whole(df.withColumn(ODD, F.coalesce(F.size(reasons) > 0, F.lit(False))), folder, ODD)
    schema = df.withColumn(ODD, F.lit(True)).schema  # an empty table has no files to read a schema from
    stored = df.sparkSession.read.schema(schema).parquet(folder)
    clean, odd = stored.where(~F.col(ODD)), stored.where(F.col(ODD))
    return clean.drop(reasons, ODD), odd.drop(ODD)
