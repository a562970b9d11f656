"""Payloads of the current chain that are read in one pass, against reads of single values, and how often they are read."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.functions import decode_attr, safe_json, varray, vlong, vstr
from ledgerlake.plans import chain_bronze, chain_silver
from workload import chainlike

LOGS = [
    '[{"msg_index":"3","events":[{"type":"a","attributes":[{"key":"k","value":"v"},{"key":"k"}]},{"type":"b"}]},{"events":[]},7,null,"x"]',
    '[{"msg_index":1,"events":[{"type":null,"attributes":5},9]}] rest', '[{"msg_index":1,"events":{"type":"no list"}}]', "{}", "null", "", "out of gas",
    '[{"msg_index":1.0,"events":[{"type":{"o":1},"attributes":[{"key":1,"value":{"p":[1]}},4]}]}]', None, '[{"msg_index":2,"events":[]}],[1]',
]


def test_log_entries_equal_single_reads(spark):
    log = spark.createDataFrame([(i, t) for i, t in enumerate(LOGS)], "i int, log string")
    one = log.select("i", F.explode(varray(safe_json("log"))).alias("e")).select("i", vlong("e", "msg_index").alias("n"), F.try_variant_get("e", "$.events", chain_silver.EVENTS).alias("events"))
    tx = log.select("i", F.parse_json(F.to_json(F.struct(F.struct("log").alias("tx_result")))).alias("tx")).select("i", vstr("tx", "tx_result.log").alias("log"))
    both = [sorted(map(str, rows.collect())) for rows in (one, tx.select("i", chain_silver._log_entries(chain_silver.EVENTS)).toDF("i", "n", "events"))]
    assert both[0] == both[1] and len(both[0]) == 7


def test_texts_that_are_no_base64(spark):
    texts = ["YWJj", "YWJjZA==", "abcd", "#123", "a_cd", "YW Jj", "YWJj\r\nYWJj", "é123", "", "====", "Y=Jj", "a-b/", None, "+/+/", "w6k=", "/w==", "YWJj AAA"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    decoded = F.try_validate_utf8(F.try_to_binary("t", F.lit("base64")).cast("string"))
    plain = F.coalesce(F.when(F.length("t") % 4 == 0, decoded), F.col("t"))
    assert rows.where(~decode_attr(F.col("t")).eqNullSafe(plain)).count() == 0


def test_a_payload_is_read_once(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    chain = chainlike.Chain(spark, entry.SMALL)
    messages = plan(chain_silver.checked_messages(chain.transactions, chain.block_times, chainlike.RUN))
    assert messages.count("parseJson") == 1  # before: two parses of each log, and a copy of each entry
    answers = plan(chain_bronze.response_transactions(chainlike.tx_responses(spark, entry.SMALL).select("block_number", "data", "_inserted_timestamp")))
    assert answers.count("try_variant_get(") == 2 and "lambda" not in answers  # the list and the hash; no lambda codes the events


ODD_EVENTS = [
    '[{"type":"a","attributes":[{"key":"YWN0aW9u","value":"djE="},{"key":"k"},{"value":7},5,null,{"key":{"o":1},"value":[1,"x"]}]},{"type":"b"},{"attributes":null}]',
    '[{"type":"message","attributes":[{"key":"action","value":"/x.MsgExec"}]},3,{"type":"message","attributes":[{"key":"module","value":"m"}]},'
    '{"type":"message","attributes":[{"key":"bW9kdWxl","value":"m"}]},{"type":"t","attributes":{"key":"no list"}},{"type":"tx","attributes":[]}]',
    '[{"type":"message","attributes":[{"key":"YWN0aW9u","value":"L2liYy5jb3JlLmNoYW5uZWwudjEuTXNnUmVjdlBhY2tldA=="}]},{"type":"message","attributes":[{"key":"module"}]},{"type":"z"}]',
    "[]", "null", '{"type":"no list"}',
]


def odd_transactions(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_EVENTS)], "i bigint, t string")
    tx = F.parse_json(F.concat(F.lit('{"tx_result":{"events":'), F.col("t"), F.lit("}}")))
    now = F.lit("2020-01-01").cast("timestamp_ntz")
    return rows.select(F.col("i").alias("block_id"), now.alias("block_timestamp"), F.concat(F.lit("tx"), "i").alias("tx_id"), F.lit(True).alias("tx_succeeded"), now.alias("_inserted_timestamp"), tx.alias("tx"))


def test_attributes_equal_single_reads(spark):
    events = chain_silver.msgs_2(odd_transactions(spark), chainlike.RUN)
    single = events.select("_unique_key", F.posexplode(varray("msg", "attributes")).alias("i", "a")).select(
        F.concat_ws("-", "_unique_key", "i").alias("id"), decode_attr(vstr("a", "key")).alias("k"), decode_attr(vstr("a", "value")).alias("v")
    )
    found = chain_silver.msg_attributes_2(events, chainlike.RUN)
    both = [sorted(map(str, df.collect())) for df in (single, found.select(F.col("_unique_key").alias("id"), F.col("attribute_key").alias("k"), F.col("attribute_value").alias("v")))]
    assert both[0] == both[1] and len(both[0]) == 11
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode(")[0]
    assert plan.count("try_variant_get(") == 0  # before: ten reads of each attribute, whose texts were decoded


def test_groups_of_odd_events(spark):
    rows = chain_silver.msgs_2(odd_transactions(spark), chainlike.RUN).orderBy("tx_id", "msg_index").collect()
    assert [(r.tx_id, r.msg_index, r.msg_group, r.msg_sub_group, r.msg_type) for r in rows] == [
        ("tx0", 0, 0, None, "a"), ("tx0", 1, 0, None, "b"), ("tx0", 2, 0, None, None),
        ("tx1", 0, 0, 0, "message"), ("tx1", 1, 0, 0, None), ("tx1", 2, 0, 0, "message"), ("tx1", 3, 0, 1, "message"), ("tx1", 4, 0, None, "t"), ("tx1", 5, 0, None, "tx"),
        ("tx2", 0, 0, 0, "message"), ("tx2", 1, 0, 0, "message"), ("tx2", 2, 0, 0, "z"),
    ]


def test_the_text_of_an_answer_is_made_once(spark):
    rows = chainlike.tx_responses(spark, entry.SMALL)
    above, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate explode(")
    assert "tx_result" not in above and "tx_result" in below  # before: made after the landings, for each of them
    gas = rows.select("block_number", vstr("data", "result.txs[0].hash").alias("tx"), vlong("data", "result.txs[0].tx_result.gasUsed").alias("gas"))
    twice = gas.groupBy("tx").agg(F.count("*").alias("n"), (F.max("gas") - F.min("gas")).alias("more"))
    assert twice.where((F.col("n") != 2) | (F.col("more") != 1)).count() == 0


def test_an_order_without_a_customer_lands(spark, monkeypatch):
    one = chainlike.orders(spark, entry.SMALL).limit(1).withColumn("o_custkey", F.lit(None).cast("bigint"))
    monkeypatch.setattr(chainlike, "orders", lambda *_: one)
    found = chainlike.tx_responses(spark, entry.SMALL).select(F.to_json("data").alias("j")).collect()
    assert len(found) == 2 and all('"hash"' in r.j and "gasUsed" not in r.j for r in found)
