"""Orders are spread by their number."""

from workload.shared import ROWS_A_TASK, spread


def test_more_orders_are_more_tasks(spark):
    few, many = (spread(spark.range(n).withColumnRenamed("id", "o_orderkey")) for n in (10, 20 * ROWS_A_TASK + 1))
    text = [df._jdf.queryExecution().optimizedPlan().toString() for df in (few, many)]
    assert ", 8" in text[0] and ", 21" in text[1]
