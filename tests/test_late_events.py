"""The last batch of incremental runs takes in the newest events, whenever they end."""

import pytest
from pyspark.sql import functions as F

from workload import QUERIES, table_queries  # noqa: F401


@pytest.mark.parametrize("name", ["upsert_bucket", "incremental_equals_full"])
def test_last_batch_has_the_newest_events(spark, tmp_path, name):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    late = events.withColumn("ts", F.col("ts") + F.expr("interval 60 days"))
    late.write.parquet(f"{tmp_path}/events.parquet")
    rows = QUERIES[name](spark, str(tmp_path))
    if name == "upsert_bucket":
        assert rows.agg(F.sum("n")).first()[0] == late.count()
    else:
        assert rows.count() == late.select("user_id", "event_type").distinct().count()
