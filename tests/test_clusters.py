"""Clustering inside partitions: how many row groups a selective read meets."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.incremental.table import KeyedTable
from ledgerlake.session import new_folder


def met(table, column, low, high):
    """(row groups whose statistics meet the range, all row groups)"""
    groups = []
    for file in table.read().inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            groups += [c.statistics for c in columns if c.path_in_schema == column]
    return sum(s.min <= high and s.max >= low for s in groups), len(groups)


@pytest.mark.parametrize(("cluster", "most_a", "most_b"), [((), 1.0, 1.0), (("a",), 0.2, 1.0), (("a", "b"), 0.5, 0.5)])
def test_selective_reads_meet_few_row_groups(spark, cluster, most_a, most_b):
    rows = spark.range(0, 60_000, 1, 4).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"), F.pow(F.pmod(F.hash("id"), F.lit(1000)) / 1000, 4).alias("b"), F.lit("x").alias("pad")
    )
    table = KeyedTable(spark, new_folder(spark, "clustered"), ["id"], F.col("id") % 1, moves=False, cluster=cluster)
    spark.conf.set("parquet.block.size", str(64 << 10))  # small row groups, so that a small table has many
    try:
        table.delete_insert(rows)
    finally:
        spark.conf.unset("parquet.block.size")
    assert table.read().count() == 60_000
    few, all_ = met(table, "a", 5000, 5100)
    assert all_ >= 8
    if cluster == ():
        assert few == all_
    assert few <= most_a * all_ and met(table, "b", 0.5, 0.52)[0] <= most_b * all_


def test_columns_without_values(spark):
    rows = spark.range(10).select("id", F.lit(None).cast("double").alias("a"), F.col("id").alias("b"))
    table = KeyedTable(spark, new_folder(spark, "clustered"), ["id"], F.lit(0), moves=False, cluster=("a", "b"))
    table.delete_insert(rows)
    table.delete_insert(rows)
    assert table.read().count() == 10
