"""Packet matching as a stream, and the coins expected from pool calls."""

import base64
import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlake.quality.pool_pairs import expected_coins, wrong_pairs
from ledgerlake.session import new_folder
from ledgerlake.streaming import matched_packets

START = datetime(2024, 1, 1)


def test_late_acknowledgement_joins_its_packet(spark):
    path = new_folder(spark, "packets")
    rows = [("send_packet", 1, 0), ("send_packet", 2, 0), ("acknowledge_packet", 1, 5), ("acknowledge_packet", 1, 6), ("acknowledge_packet", 3, 6)]
    data = [(k, n, START + timedelta(hours=h)) for k, n, h in rows]
    packets = spark.createDataFrame(data, "msg_type string, seq bigint, at timestamp")
    packets.coalesce(1).write.parquet(path)
    source = lambda kind: spark.readStream.schema(packets.schema).parquet(path).where(F.col("msg_type") == kind).select("seq", "at")
    joined = matched_packets(source("send_packet"), source("acknowledge_packet"), ["seq"], "at", "2 days")
    out = new_folder(spark, "matched")
    query = (
        joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_folder(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [r["seq"] for r in spark.read.schema("seq bigint, at timestamp").parquet(out).collect()] == [1]


def test_pool_coins(spark):
    labels = spark.createDataFrame([("pool", "Pool LP", "pool"), ("other", "x", "token")], "address string, label string, label_subtype string")
    sent = base64.b64encode(json.dumps({"withdraw_liquidity": {}}).encode()).decode()
    calls = [
        ("w", {"contract": "pool", "msg": {"send": {"msg": sent}}}, {"_contract_address_0": "pool", "withdrawn_share": "9", "refund_assets": "1uusd, 2ibc/A"}),
        ("p", {"contract": "pool", "msg": {"provide_liquidity": {}}}, {"_contract_address_0": "pool", "share": "5", "assets": "3uluna, 4uusd"}),
        ("n", {"contract": "other", "msg": {"provide_liquidity": {}}}, {"share": "5", "assets": "3uluna"}),
    ]
    rows = [(t, json.dumps(v), {"wasm": log}) for t, v, log in calls]
    messages = spark.createDataFrame(rows, "tx_id string, v string, attributes map<string,map<string,string>>").withColumn("message_value", F.parse_json("v"))
    got = sorted((r["tx_id"], int(r["amount"]), r["currency"]) for r in expected_coins(labels, messages).collect())
    assert got == [("p", 3, "uluna"), ("p", 4, "uusd"), ("p", 5, "Pool LP"), ("w", 1, "uusd"), ("w", 2, "ibc/A"), ("w", 9, "Pool LP")]
    actual = expected_coins(labels, messages).where(F.col("amount") != 9)
    assert [int(r["amount"]) for r in wrong_pairs(actual, labels, messages).collect()] == [9]
