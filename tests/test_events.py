"""Events of the current chain: grouping against a brute force, and the traps of the payload."""

import base64
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import coin_amount, coin_denom, decode_attr, denom_cut, safe_json
from ledgerlake.operators.flatten import flatten_recursive, prefix_regroup
from ledgerlake.plans import chain_bronze, chain_silver
from ledgerlake.run import Run
from ledgerlake.sources import keep_answered

RUN = Run(datetime(2024, 1, 1), "run")
NOW = datetime(2023, 1, 1)


def transactions(spark, payloads):
    rows = [(10, NOW, f"tx{i}", True, json.dumps(p), NOW, NOW) for i, p in enumerate(payloads)]
    schema = (
        "block_id bigint, block_timestamp timestamp_ntz, tx_id string, tx_succeeded boolean, tx string, "
        "_ingested_at timestamp_ntz, _inserted_timestamp timestamp_ntz"
    )
    return spark.createDataFrame(rows, schema).withColumn("tx", F.parse_json("tx"))


def event(kind, *pairs):
    return {"type": kind, "attributes": [{"key": k, "value": v} for k, v in pairs]}


def brute_groups(events):
    """(msg_group, msg_sub_group) per event, straight from the rules."""
    group, groups = None, []
    for e in events:
        if e["attributes"] and e["attributes"][0]["key"] == "action":
            group = 0 if group is None else group + 1
        groups.append(group)
    last = events[-1]["type"]
    special = chain_silver.GROUPED_ACTIONS
    execs = {
        g for e, g in zip(events, groups)
        if g is not None and e["type"] == "message" and e["attributes"] and e["attributes"][0]["key"] == "action"
        and ("exec" in e["attributes"][0]["value"].lower() or e["attributes"][0]["value"] in special)
    }
    steps, counts = {}, {}
    for i, (e, g) in enumerate(zip(events, groups)):
        if g in execs and e["type"] == "message" and e["attributes"] and e["attributes"][0]["key"] == "module":
            steps[i] = counts.get(g, 0)
            counts[g] = steps[i] + 1
    out = []
    for i, g in enumerate(groups):
        later = [s for j, s in steps.items() if j >= i and groups[j] == g]
        out.append((g, None if g is None else later[0] if later else 0 if last != "tx" else None))
    return out


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    choices = [
        lambda: event("message", ("action", rng.choice(["/a.MsgExecX", "/b.Send", chain_silver.GROUPED_ACTIONS[0]]))),
        lambda: event("message", ("module", "bank")), lambda: event("transfer", ("sender", "x")),
        lambda: event("wasm", ("module", "no")), lambda: event("tx", ("fee", "1uluna")), lambda: event("message"),
    ]
    payloads = [{"tx_result": {"events": [rng.choice(choices)() for _ in range(rng.randrange(1, 25))]}} for _ in range(120)]
    rows = chain_silver.msgs_2(transactions(spark, payloads), RUN).collect()
    got = {(r["tx_id"], r["msg_index"]): (r["msg_group"], r["msg_sub_group"]) for r in rows}
    for i, p in enumerate(payloads):
        for j, expected in enumerate(brute_groups(p["tx_result"]["events"])):
            assert got[(f"tx{i}", j)] == expected, (p, j)


def test_decode_attributes(spark):
    coded = base64.b64encode("terra1abc".encode()).decode()
    cases = {coded: "terra1abc", "action": "action", "receiver": "receiver", "": "", "12uluna": "12uluna", "a=b=": "a=b=", "####": "####"}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", decode_attr(F.col("x")).alias("y"))
    assert {r["x"]: r["y"] for r in df.collect()} == cases


@pytest.mark.parametrize(
    "coin, amount, denom",
    [("12uluna", 12, "uluna"), ("12uluna,5ibc/A", 12, "uluna,5ibc/A"), ("7", 7, ""), ("", None, ""), ("abc", None, "abc"),
     ("99999999999999999999uusd", 99999999999999999999, "uusd")],
)
def test_coins(spark, coin, amount, denom):
    df = spark.createDataFrame([(coin,)], "c string").select(coin_amount(F.col("c")).alias("a"), coin_denom(F.col("c")).alias("d"))
    row = df.first()
    assert (None if row["a"] is None else int(row["a"]), row["d"]) == (amount, denom)


def test_denom_cut(spark):
    cases = {"5uluna": (5, "uluna"), "5gamm/pool/1": (5, "gamm/pool/1"), "5ibc/AB": (5, "ibc/AB"), "5": (5, "uluna"), "7ibc/" + "A" * 150: (7, "ibc/" + "A" * 150), "8gamm/pool/" + "1" * 150: (8, "gamm/pool/" + "1" * 150)}
    amount, currency = denom_cut(F.col("c"))
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", amount.alias("a"), currency.alias("d")).collect()
    assert {r["c"]: (int(r["a"]), r["d"]) for r in rows} == cases


def test_safe_json(spark):
    cases = {'{"a":1}': True, '{"a":1}{': False, "[1,2]": True, "1,2": False, "": False, "oops": False, "null": True}
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", safe_json("c").isNotNull().alias("ok")).collect()
    assert {r["c"]: r["ok"] for r in rows} == cases


def test_retryable_errors_are_dropped(spark):
    bodies = ['{"result":1}', '{"error":{"code":-32000}}', '{"error":{"code":-32600}}', '{"error":{"code":-32010}}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").withColumn("data", F.parse_json("b"))
    assert sorted(r["i"] for r in keep_answered(df).collect()) == [0, 2]


def test_era_boundary_and_validators(spark):
    edge = chain_bronze.LAST_OLD_BLOCK

    def body(height, old):
        commit = {"height": str(height - 1), "signatures": [{"validator_address": "B"}, {"validator_address": "A"}, {"validator_address": "B"}]}
        header = {"time": "2022-05-28T06:00:00.123456789Z", "height": str(height)}
        block = {"header": {**header, "last_commit": commit}} if old else {"header": header, "last_commit": commit}
        return json.dumps({"result": {"block": {**block, "data": {"txs": None}}}})

    rows = [(edge, body(edge, True), NOW), (edge + 1, body(edge + 1, False), NOW), (edge + 2, body(edge + 2, True), NOW)]
    responses = spark.createDataFrame(rows, "block_number bigint, data string, _inserted_timestamp timestamp_ntz").withColumn("data", F.parse_json("data"))
    empty = chain_bronze.response_blocks(responses.where("false"))
    got = {r["block_id"]: r["validator_address_array"] for r in chain_silver.blocks_val_array(empty, responses, RUN).collect()}
    # The newer layout ignores a commit in the header.
    assert got == {edge - 1: ["A", "B"], edge: ["A", "B"]}
    first = chain_bronze.response_blocks(responses).where(F.col("block_id") == edge).first()
    assert (first["tx_count"], first["block_timestamp"]) == (0, datetime(2022, 5, 28, 6, 0, 0, 123456))


def test_log_messages_and_broken_log(spark):
    log = [
        {"msg_index": 0, "events": [event("message", ("action", "/x.MsgExec"))]},
        {"msg_index": 1, "events": [event("message", ("module", "a")), event("message", ("module", "b"))]},
    ]
    txs = transactions(spark, [{"tx_result": {"log": json.dumps(log)}}, {"tx_result": {"log": "out of gas"}}])
    blocks = spark.createDataFrame([(10, "c")], "block_id bigint, chain_id string")
    rows = chain_silver.msgs(txs, blocks, RUN).collect()
    # Two steps in one log entry repeat its two events; a broken log gives nothing.
    assert sorted((r["msg_index"], r["msg_group"]) for r in rows) == [(0, "0:0")] + [(1, "0:0")] * 4
    assert len({r["message_id"] for r in rows}) == 5


def test_header_events_have_no_group_in_log(spark):
    log = [{"msg_index": 0, "events": [event("tx", ("fee", "1")), event("message", ("action", "/x.Send"))]}]
    blocks = spark.createDataFrame([(10, "c")], "block_id bigint, chain_id string")
    rows = chain_silver.msgs(transactions(spark, [{"tx_result": {"log": json.dumps(log)}}]), blocks, RUN).collect()
    assert sorted(((r["msg_type"], r["msg_group"]) for r in rows), key=str) == [("message", "0:0"), ("tx", None)]


def test_repeated_fields_of_a_message(spark):
    log = [{"msg_index": 0, "events": [event("transfer", ("amount", "5uluna"), ("to", "a"), ("amount", "7ibc/X"))]}]
    payload = {"tx_result": {"log": json.dumps(log)}, "body": {"messages": [{"@type": "/t"}]}}
    blocks = spark.createDataFrame([(10, "c")], "block_id bigint, chain_id string")
    row = chain_silver.messages(transactions(spark, [payload]), blocks, RUN).first()
    assert row["attributes"]["transfer"] == {"amount_0": "5", "amount_1": "7", "to": "a", "currency_0": "uluna", "currency_1": "ibc/X"}
    assert row["message_type"] == "/t"


def test_prefix_regroup_orders_by_text(spark):
    df = spark.createDataFrame([({"10_a": "x", "2_a": "y", "plain": "z", "0_b": "w", "_contract_address": "c"},)], "m map<string,string>")
    row = df.select(prefix_regroup(F.col("m")).alias("p")).first()["p"]
    assert [(g["array_index"], dict(g["fields"])) for g in row] == [
        ("0", {"plain": "z", "b": "w", "_contract_address": "c"}), ("10", {"a": "x"}), ("2", {"a": "y"})
    ]


def test_flatten_recursive_paths(spark):
    df = spark.createDataFrame([('{"a":[{"b":1},2]}',)], "j string").withColumn("j", F.parse_json("j"))
    rows = flatten_recursive(df, F.col("j")).select("path", "key", "index").collect()
    assert sorted((r["path"], r["key"], r["index"]) for r in rows) == [
        ("a", "a", None), ("a[0]", None, 0), ("a[0].b", "b", None), ("a[1]", None, 1)
    ]


def test_flatten_recursive_has_no_depth_limit(spark):
    deep = '{"k]":["' + '\\\\\\"{[[[' + '",' + '{"a":' * 40 + "[1]" + "}" * 40 + "]}"
    df = spark.createDataFrame([(1, deep), (2, "7"), (3, None), (4, "[]"), (5, '"x{[" ')], "i int, j string").withColumn("j", F.parse_json("j"))
    rows = flatten_recursive(df, F.col("j")).select("i", "path").collect()
    assert {r["i"] for r in rows} == {1}
    assert len(rows) == 1 + 2 + 40 + 1 and max(len(r["path"]) for r in rows) == len("k][1]" + ".a" * 40 + "[0]")


def test_regroup_and_numbering_of_many_fields(spark):
    """A thousand fields in one event: the work grows with the fields, not with their square."""
    fields = {f"{i % 250}_f{i}": str(i) for i in range(1000)}
    row = spark.createDataFrame([(fields,)], "m map<string,string>").select(prefix_regroup(F.col("m")).alias("p")).first()["p"]
    assert [g["array_index"] for g in row] == sorted(str(i) for i in range(250))
    assert {f"{g['array_index']}_{k}": v for g in row for k, v in g["fields"].items()} == fields
    pairs = [("a" if i % 2 else f"k{i}", str(i)) for i in range(1000)] + [(None, "x")]
    df = spark.createDataFrame([(pairs,)], "p array<struct<key:string,value:string>>")
    got = df.select(chain_silver._numbered_fields(F.col("p")).alias("n")).first()["n"]
    assert [(r["key"], r["suffix"]) for r in got[:4]] == [("k0", ""), ("a", "_0"), ("k2", ""), ("a", "_1")]
    assert got[999]["suffix"] == "_499" and [r["value"] for r in got] == [v for _, v in pairs]
