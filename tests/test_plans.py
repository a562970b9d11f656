"""Properties of the physical plans that decide whether a job survives large or skewed data."""

import ast
import pathlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.operators.dedupe import latest_by
from ledgerlake.plans import chain_silver
from ledgerlake.plans import observability
from workload.chainlike import RUN, Chain
from workload.model_queries import counted_in_batches
from workload.table_queries import order_checks

SMALL = entry.SMALL
ROOT = pathlib.Path(entry.__file__).parent


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_reduces_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(latest_by(orders, ["o_custkey"], [F.desc("o_orderdate")]))
    below = text.split("Exchange")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_row_checks_share_one_scan(spark):
    checks, orders = order_checks(), spark.read.parquet(f"{SMALL}/orders.parquet").withColumn("status", F.col("o_orderstatus"))
    text = plan(checks.violations(orders))
    assert len(checks.rows) == 5 and text.count("FileScan") == 1 and "Exchange" not in text


def test_reports_read_the_state_of_their_blocks(spark):
    built = counted_in_batches(spark, SMALL)
    checked = Chain(spark, SMALL).blocks.where("block_id between 4711600 and 4711700").select("block_id", "block_timestamp")
    text = plan(observability.landed_near(built, checked))
    assert "p4711" in text and "p4710" not in text and "p4712" not in text and built.table("landed_transactions").read().count() > 1000


def test_event_groups_need_no_shuffle(spark):
    transactions = Chain(spark, SMALL).transactions
    text = plan(chain_silver.msg_attributes_2(chain_silver.msgs_2(transactions, RUN), RUN))
    assert "Exchange" not in text and "Window" not in text


def test_packets_need_no_shuffle_and_transfers_only_that_of_the_payer(spark):
    events = Chain(spark, SMALL).msgs_2
    assert "Exchange" not in plan(chain_silver.transfers_ibc_packets(events, RUN))
    assert plan(chain_silver.transfers(events, RUN)).count("Exchange hashpartitioning") <= 2


def test_scans_read_only_what_is_used(spark):
    text = plan(entry.queries()["closed_hours_only"](spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    text = plan(entry.queries()["tombstones"](spark, SMALL))
    assert "EqualTo(l_returnflag,R)" in text and "l_extendedprice" not in text


SHUFFLE_ONLY = ["latest_by_key", "locf", "running_group", "pair_nth", "price_lookup", "tombstones", "anti_join_null_aware", "gap_ranges", "balance_chain", "transfers_roundtrip"]


@pytest.mark.parametrize("name", SHUFFLE_ONLY)
def test_no_nested_loops(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_library_has_no_python_in_the_data_path():
    banned = {"udf", "pandas_udf", "applyInPandas", "mapInPandas", "mapPartitions", "crossJoin", "broadcast", "localCheckpoint", "toPandas", "cache"}
    for path in (ROOT / "ledgerlake").rglob("*.py"):
        if "llm" in path.parts:  # those operators choose their own style
            continue
        names = {n.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Attribute)}
        assert not names & banned, (path, names & banned)
