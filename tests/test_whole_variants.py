"""VARIANTs of stages and keyed tables are written in one piece, and the session is left as it was."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.incremental import KeyedTable
from ledgerlake.quality import quarantined
from ledgerlake.session import new_folder, settle, whole_variants

SHREDDING = "spark.sql.variant.inferShreddingSchema"


def payloads(spark, n=500):
    text = F.concat(F.lit('{"a":{"b":"x'), F.col("id").cast("string"), F.lit('"},"c":[1,{"d":null}]}'))
    return spark.range(n).select("id", F.parse_json(text).alias("v"))


def columns(path):
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file://')}/**/*.parquet", recursive=True)]
    found = [m.row_group(g).column(c) for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)]
    return {c.path_in_schema for c in found if c.path_in_schema.startswith("v")}, {c.compression for c in found}


def same(left, right):
    rows = lambda df: sorted((r.id, r.j) for r in df.select("id", F.to_json("v").alias("j")).collect())
    return rows(left) == rows(right)


def stage(spark, rows, folder):
    return settle(rows)


def table(spark, rows, folder):
    found = KeyedTable(spark, folder, ["id"], F.col("id") % 2, moves=False)
    found.merge(rows.where("id < 400"))
    found.merge(rows.where("id >= 300"))
    return found.read()


def clean(spark, rows, folder):
    return quarantined(rows.withColumn("odd", F.array().cast("array<string>")), "odd", folder)[0]


@pytest.mark.parametrize("stored", [stage, table, clean])
def test_variants_are_written_whole(spark, stored):
    rows, before = payloads(spark), spark.conf.get(SHREDDING, None)
    back = stored(spark, rows, new_folder(spark, "whole"))
    paths = {f.rsplit("/", 1)[0] for f in back.inputFiles()}
    assert {c for p in paths for c in columns(p)[0]} == {"v.value", "v.metadata"}  # before: typed_value columns of inferred fields
    assert {c for p in paths for c in columns(p)[1]} == {"ZSTD"}  # before: SNAPPY
    assert same(back, rows) and spark.conf.get(SHREDDING, None) == before


def test_a_failed_write_restores_the_session(spark):
    before = spark.conf.get(SHREDDING, None)
    with pytest.raises(ZeroDivisionError), whole_variants(spark.range(1)):
        assert spark.conf.get(SHREDDING) == "false"
        1 / 0  # noqa: B018
    assert spark.conf.get(SHREDDING, None) == before


def test_an_empty_stage(spark):
    assert settle(payloads(spark, 0)).count() == 0
