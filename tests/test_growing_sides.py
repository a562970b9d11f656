"""Sides that grow with the tables: keys of a table with VARIANTs are not broadcast because they are taken for small."""

from pyspark.sql import functions as F

from ledgerlake.incremental import KeyedTable
from ledgerlake.incremental.table import hash_part
from ledgerlake.session import new_folder

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def batch(spark, n):
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.parse_json(F.lit('{"a":1}')).alias("v"), F.lit(1).alias("first"))


def plan_of_upsert(spark, monkeypatch, rows, keep):
    table, plans = KeyedTable(spark, new_folder(spark, "measured"), ["k"], hash_part(2, "k"), moves=False), []
    table.append(batch(spark, 5000))

    def look(self, found, mode, partitions="dynamic"):
        found.collect()
        plans.append(found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])

    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "_write", look)
        table.upsert(batch(spark, rows), "merge", keep)
    return plans[0]


def test_many_keys_are_not_broadcast(spark, monkeypatch):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "200000")  # 5000 keys are 5000 rows of 48 bytes and more; they are estimated at a few kilobytes
    try:
        plan = plan_of_upsert(spark, monkeypatch, 5000, ["first"])
    finally:
        spark.conf.set(LIMIT, before)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
