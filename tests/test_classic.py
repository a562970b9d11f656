"""Rules of the predecessor chain that the derived log does not reach."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.dedupe import tombstoned
from ledgerlake.operators.enrich import hourly_prices, priced
from ledgerlake.plans import classic_bronze, classic_dex, classic_gold, classic_prices, classic_silver
from ledgerlake.plans import classic_lending as lending
from ledgerlake.run import Run

NOW = datetime(2022, 1, 3)
DAY = datetime(2022, 1, 1)
RUN = Run(NOW)
MSG = (
    "blockchain string, chain_id string, block_id bigint, block_timestamp timestamp_ntz, tx_id string, tx_status string, "
    "msg_module string, msg_type string, msg_index bigint, msg_value string"
)
EVENT = (
    "blockchain string, chain_id string, block_id bigint, block_timestamp timestamp_ntz, tx_id string, tx_status string, "
    "msg_module string, msg_type string, msg_index bigint, event_index bigint, event_type string, event_attributes string"
)
ACTION = (
    "blockchain string, chain_id string, block_id bigint, block_timestamp timestamp_ntz, tx_id string, action_index bigint, "
    "msg_index bigint, action_contract_address string, action_method string, action_log string"
)


def messages(spark, *values, tx="t", module="wasm", kind="wasm/MsgExecuteContract"):
    rows = [("terra", "columbus-5", 1, DAY, f"{tx}{i}", "SUCCEEDED", module, kind, 0, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MSG).withColumn("msg_value", F.parse_json("msg_value"))


def events(spark, *values):
    rows = [("terra", "columbus-5", 1, DAY, tx, "SUCCEEDED", "m", "t", 0, i, kind, json.dumps(v)) for i, (tx, kind, v) in enumerate(values)]
    return spark.createDataFrame(rows, EVENT).withColumn("event_attributes", F.parse_json("event_attributes"))


def actions(spark, *values):
    rows = [("terra", "columbus-5", 1, DAY, tx, i, 0, contract, method, json.dumps(log)) for i, (tx, contract, method, log) in enumerate(values)]
    df = spark.createDataFrame(rows, ACTION)
    return df.withColumn("action_log", F.parse_json("action_log").cast("map<string,variant>"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("pool", "a", "b", "Pool", "p")], "address string, l1_label string, l2_label string, address_name string, project_name string")


@pytest.fixture(scope="module")
def hourly(spark):
    rows = [(DAY, "tokA", "A1", 2.0), (DAY, "tokA", "A2", 3.0), (DAY, "uusd", "UST", 1.0), (DAY, lending.EIGHT_DECIMAL_COLLATERAL, "AV", 10.0)]
    return spark.createDataFrame(rows, "hour timestamp_ntz, currency string, symbol string, price double")


def test_null_aware_exclusion(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = lambda values: {r["k"] for r in tombstoned(left, spark.createDataFrame([(v,) for v in values], "k string"), "k").collect()}
    assert got(["a"]) == {"b"}
    assert got(["a", None]) == set()
    assert got([]) == {None, "a", "b"}


def test_two_symbols_fan_out(spark, hourly):
    rows = messages(spark, {}).withColumn("c", F.lit("tokA"))
    assert sorted(r["p"] for r in priced(rows, hourly, F.col("c"), {"price": "p"}).collect()) == [2.0, 3.0]


def test_hourly_average(spark):
    rows = spark.createDataFrame([(datetime(2022, 1, 1, 0, m), "c", "s", p) for m, p in [(1, 1.0), (59, 3.0)]], "block_timestamp timestamp_ntz, currency string, symbol string, price_usd double")
    assert hourly_prices(rows).first()["price"] == 2.0


def test_collateral_decimals_and_bridge(spark, hourly, labels):
    value = {"sender": "u", "contract": "c", "execute_msg": {"withdraw_collateral": {}}}
    bridge = {"sender": "w", "contract": "w", "execute_msg": {"process_anchor_message": {}}}
    token = lending.EIGHT_DECIMAL_COLLATERAL
    seen = events(
        spark, ("t0", "from_contract", {"collaterals": [{"denom": token, "amount": "500000000"}]}),
        ("t1", "from_contract", {"collaterals": [{"denom": "tokB", "amount": "1"}]}),
    )
    acts = actions(spark, ("t1", "cust", "lock_collateral", {"borrower": "b", "amount": "3000000"}))
    got = lending.ez_anchor_collateral(messages(spark, value, bridge), seen, acts, hourly, labels)
    assert sorted((r["source"], r["event_type"], r["sender"], r["amount"], r["amount_usd"]) for r in got.collect()) == [
        ("Terra", "withdraw", "u", 5.0, 50.0), ("Wormhole", "provide", "b", 3.0, None)
    ]


def test_provide_collateral_needs_a_lock_in_the_transaction(spark, hourly, labels):
    custody = lending.COLLATERAL_CONTRACTS[0]
    send = {"sender": "u", "contract": "tokA", "execute_msg": {"send": {"contract": custody, "amount": "2000000"}}}
    lock = {"sender": "u", "contract": "x", "execute_msg": {"lock_collateral": {}}}
    alone = messages(spark, send)
    none = events(spark, ("zz", "x", {}))
    acts = actions(spark, ("zz", "x", "y", {}))
    assert lending.ez_anchor_collateral(alone, none, acts, hourly, labels).isEmpty()
    both = alone.unionByName(messages(spark, lock).withColumn("msg_index", F.lit(1).cast("bigint")))
    rows = lending.ez_anchor_collateral(both, none, acts, hourly, labels).collect()
    assert sorted(r["amount_usd"] for r in rows) == [4.0, 6.0]


def test_redeem_three_ways(spark, hourly, labels):
    direct = {"sender": "u", "contract": lending.DEPOSIT_TOKEN, "execute_msg": {"send": {"contract": lending.MARKET}}}
    bridge = {"sender": "w", "contract": "w", "execute_msg": {"process_anchor_message": {}}}
    other = {"sender": "o", "contract": "x", "execute_msg": {"call": {}}}
    seen = events(spark, ("t0", "from_contract", {"redeem_amount": "1000000"}))
    acts = actions(
        spark, *[x for i in (1, 2) for x in [
            (f"t{i}", lending.MARKET, "redeem_stable", {"redeem_amount": str(i * 1000000)}),
            (f"t{i}", "uusd", "send", {"from": f"f{i}", "to": lending.MARKET}),
        ]],
    )
    got = lending.ez_anchor_redeem(messages(spark, direct, bridge, other), seen, acts, hourly, labels)
    assert sorted((r["tx_id"], r["sender"], r["amount"], r["source"]) for r in got.collect()) == [
        ("t0", "u", 1.0, "Terra"), ("t1", "f1", 1.0, "Wormhole"), ("t2", "o", 2.0, "Terra")
    ]


def test_multi_reward_claim(spark, hourly, labels):
    rows = messages(spark, {"sender": "u", "contract": lending.LP_REWARDS, "execute_msg": {"withdraw": {}}})
    claim = messages(spark, {"sender": "u", "contract": lending.MARKET, "execute_msg": {"claim_rewards": {}}}).withColumn("msg_index", F.lit(1).cast("bigint"))
    seen = events(
        spark, ("t0", "from_contract", {"0_action": "withdraw", "0_amount": "1000000", "1_contract_address": "anc"}),
        ("t0", "from_contract", {"0_action": "claim_rewards", "claim_amount": "2000000", "2_contract_address": "anc"}),
    ).withColumn("msg_index", F.col("event_index"))
    got = lending.ez_anchor_reward_claims(rows.unionByName(claim), seen, hourly, labels).collect()
    assert [(r["claim_0_amount"], r["claim_1_amount"]) for r in got] == [(1.0, 2.0)]


def test_swap_pools_of_the_other_factory(spark, hourly, labels):
    create = {"sender": "u", "contract": classic_dex.ASTRO_FACTORY, "execute_msg": {"create_pair": {}}}
    msgs = messages(spark, create)
    log = {"offer_asset": "uusd", "offer_amount": "1000000", "ask_asset": "tokA", "return_amount": "2000000", "sender": "s"}
    acts = actions(spark, ("a", "pool", "swap", log), ("b", "astro", "swap", log))
    dex = spark.createDataFrame([], "contract_address string, symbol string")
    made = events(spark, ("t0", "from_contract", {"pair_contract_addr": "astro"}))
    got = classic_dex.ez_terraswap_swaps(acts, msgs, made, hourly, labels, dex).collect()
    assert {(r["pool_address"], r["pool_name"]) for r in got} == {("pool", "Pool")}
    # An event without a pair address is a null in the list, which empties the result.
    unknown = events(spark, ("t0", "from_contract", {"pair_contract_addr": "astro"}), ("t0", "from_contract", {}))
    assert classic_dex.ez_terraswap_swaps(acts, msgs, unknown, hourly, labels, dex).isEmpty()


def test_eight_decimal_swap(spark, hourly, labels):
    token = classic_dex.EIGHT_DECIMAL_SWAP_TOKEN
    quotes = hourly.unionByName(hourly.limit(1).withColumns({"currency": F.lit(token), "price": F.lit(2.0)}))
    log = {"offer_asset": token, "offer_amount": "300000000", "ask_asset": "uusd", "return_amount": "1000000", "maker_fee_amount": "1"}
    dex = spark.createDataFrame([], "contract_address string, symbol string")
    row = classic_dex.ez_astroport_swaps(actions(spark, ("a", "p", "swap", log)), messages(spark, {}), quotes, labels, dex).first()
    assert (row["offer_amount"], row["offer_amount_usd"], row["return_amount_usd"]) == (3.0, 600.0, 1.0)


def test_withdrawn_liquidity_and_zaps(spark, hourly, labels):
    msgs = messages(
        spark, {"sender": "u"},
        {"sender": "z", "contract": classic_dex.STRATEGY_CONTRACTS[0], "execute_msg": {"zap_out_of_strategy": {"strategy_id": 1, "amount": "5000000"}}},
        {"sender": "i", "contract": classic_dex.STRATEGY_CONTRACTS[1], "execute_msg": {"zap_into_strategy": {"strategy_id": 1}}},
        {"sender": "r", "contract": classic_dex.MIRROR_FARM, "execute_msg": {"re_invest": {"asset_token": "x"}}},
    )
    acts = actions(
        spark, ("t0", "pool", "withdraw_liquidity", {"refund_assets": "10uusd, 20terra1abc", "withdrawn_share": "7"}),
        ("t0", "lp", "burn", {"amount": "7"}), ("t0", "x", "unbond", {"staker_addr": "s", "amount": "1000000", "asset_token": "tok"}),
    )
    seen = events(
        spark, ("t1", "from_contract", {"staking_token": "lpz"}), ("t2", "from_contract", {"share": "2000000", "lp_token": "lpi"}),
        ("t3", "from_contract", {"share": "3000000", "staking_token": "lpr"}),
    )
    row = classic_dex.ez_terraswap_lp_actions(acts, msgs, seen, hourly, labels).first()
    assert (row["event_type"], row["token_1_currency"], row["lp_pool_address"], row["pool_name"]) == ("withdraw_liquidity", "terra1abc", "lp", "Pool")
    dex = spark.createDataFrame([("lpr", classic_dex.ASTRO_LP_NAME)], "contract_address string, contract_name string")
    got = classic_dex.ez_terraswap_lp_stake(acts, msgs, seen, labels, dex).collect()
    assert sorted((r["event_type"], r["sender"], r["amount"], r["contract_address"]) for r in got) == [
        ("stake_lp", "i", 2.0, "lpi"), ("unstake_lp", "s", 1.0, "tok"), ("unstake_lp", "z", 5.0, "lpz")
    ]


def test_balances_of_shared_ranks_repeat(spark):
    rows = [("a", 5.0, "liquid", b, DAY, chain, "LUNA", DAY, DAY) for b, chain in [(1, "x"), (1, "y"), (2, "x"), (3, "x")]]
    schema = (
        "address string, balance double, balance_type string, block_number bigint, block_timestamp timestamp_ntz, "
        "blockchain string, currency string, system_created_at timestamp_ntz, _inserted_timestamp timestamp_ntz"
    )
    got = classic_silver.balance_chain(spark.createDataFrame(rows, schema)).groupBy("block_number").count().collect()
    assert {r["block_number"]: r["count"] for r in got} == {1: 2, 2: 2, 3: 1}


def test_history_balances_get_their_chain_version(spark):
    schema = "address string, balance double, balance_type string, block_number bigint, block_timestamp timestamp_ntz, blockchain string, currency string"
    rows = [("a", 1.0, "l", 5, datetime(2020, 1, 1), "terra", "X"), ("b", 1.0, "l", 4000000, datetime(2020, 1, 1), "terra", "X"),
            ("c", 1.0, "l", 5, datetime(2021, 1, 1), "terra-5", "X"), ("d", 0.0, "l", 5, datetime(2020, 1, 1), "terra", "X")]
    history = spark.createDataFrame(rows, schema)
    empty = history.limit(0).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("system_created_at", "_inserted_timestamp")})
    got = {r["address"]: r["blockchain"] for r in classic_silver.balances(empty, history).collect()}
    assert got == {"a": "columbus-3", "b": "columbus-4", "c": "columbus-5"}


def test_synthetic_balances_carry_forward(spark):
    text = "x" * 24 + "w" * 44
    rows = [(text, DAY, json.dumps({"balances": [{"denom": "tok", "amount": "5"}]})), (text, NOW, json.dumps({"balances": [{"denom": "tok", "amount": "7"}]}))]
    df = spark.createDataFrame(rows, "inputs string, block_timestamp timestamp_ntz, value_obj string").withColumn("value_obj", F.parse_json("value_obj"))
    got = classic_silver.block_synthetic_balances(df, Run(datetime(2022, 1, 4))).orderBy("date").collect()
    assert [r["balance"] for r in got] == [5.0, 5.0, 7.0, 7.0] and got[0]["address"] == "w" * 44


def test_contract_values_reuse_the_last_price(spark, labels):
    schema = "date date, address string, currency string, balance_type string, blockchain string, is_native boolean, balance double"
    rows = [(datetime(2022, 1, d).date(), "pool", "tok", "liquid", "terra", False, 2.0) for d in (1, 2, 3)]
    contract, native = spark.createDataFrame(rows, schema), spark.createDataFrame([(DAY.date(), "z", "uUS", "l", "terra", True, 1.0)], schema)
    prices = spark.createDataFrame([(datetime(2022, 1, 2), "tok", 4.0), (DAY, "UUT", 3.0)], "block_timestamp timestamp_ntz, symbol string, price_usd double")
    none = spark.createDataFrame([], "address string, address_name string")
    got = classic_gold.dim_daily_balances(native, contract, prices, none, labels).orderBy("currency", "date").collect()
    assert [r["balance_usd"] for r in got] == [None, 8.0, 8.0, 3.0]


def test_labels_with_quotes_and_case(spark):
    key = lambda chain, at: json.dumps({"key": f'"labels-{chain}-{at}"', "CreateTime": 1})
    entry = lambda address, **more: json.dumps([{"address": address, "creator": "c", "l1_label": "x", "address_name": "n", "project_name": "p", **more}])
    rows = [(key("terra", 10), entry("ABC", address_name="old")), (key("terra", 20), entry("abc")), (key("terra", 10), entry("Proj", l1_label="project")),
            (json.dumps({"key": '"other-terra-1"', "CreateTime": 1}), entry("no")), (key("solana", 10), entry("KeepCase"))]
    log = spark.createDataFrame(rows, "m string, c string").select(F.parse_json("m").alias("record_metadata"), F.parse_json("c").alias("record_content"))
    got = [(r["address"], r["address_name"]) for r in classic_silver.address_labels(log).collect()]
    assert got == [("abc", "n")]


def test_pinned_runs(spark):
    rows = [("terra_tx_model", "v2022.03.02.0", 1), ("terra_tx_model", "old", 2), ("terra-5_tx_model", "v2022.01.14.0", 3), ("terra-5_tx_model", "v2022.03.02.0", 4)]
    body = [json.dumps({"model": {"name": n, "run_id": r}, "results": [{"block_id": i, "tx_id": str(i)}]}) for n, r, i in rows]
    log = spark.createDataFrame([(b, DAY) for b in body], "c string, _inserted_timestamp timestamp_ntz").select(
        F.parse_json(F.lit('{"CreateTime":1}')).alias("record_metadata"), F.parse_json("c").alias("record_content"), "_inserted_timestamp"
    )
    assert sorted(r["block_id"] for r in classic_bronze.classic_transactions(log).collect()) == [1, 3]


def test_symbols(spark):
    df = spark.createDataFrame([("uusd",), ("umyr",), ("other",)], "c string").select(classic_prices.symbol_of(F.col("c")).alias("s"))
    assert [r["s"] for r in df.collect()] == ["UST", "MYT", "other"] and len(classic_prices.SYMBOLS) == 22


def test_mirror_assets_and_wormhole_tokens(spark):
    whitelist = {"contract": classic_silver.MIRROR_FACTORY, "execute_msg": {"whitelist": {}}}
    seen = events(spark, ("t0", "from_contract", {"0_asset_token": "asset"}), ("w", "instantiate_contract", {"creator": classic_silver.WORMHOLE, "contract_address": "worm"}))
    info = spark.createDataFrame([("asset", '{"decimals":6,"name":"A","symbol":"a"}'), ("worm", '{"decimals":8,"name":"W","symbol":"w"}'), ("lost", "{}"),
                                  (classic_silver.DECODED_ELSEWHERE[0], "{}")], "address string, init_msg string").withColumn("init_msg", F.parse_json("init_msg"))
    got = classic_silver.contract_metadata(seen, messages(spark, whitelist), info).collect()
    assert sorted((r["contract_address"], int(r["decimals"]), r["symbol"], r["is_wormhole"]) for r in got) == [("asset", 6, "a", False), ("worm", 8, "w", True)]
    assert [r["token_contract"] for r in classic_silver.token_contracts(seen, RUN).collect()] == ["worm"]


def test_contract_info_keeps_the_first_answer(spark):
    body = lambda admin: json.dumps({"name": "n", "request_meta": {"path": "/bulk_get_contract_info"}, "response_data": [{"contract_info": {"address": "a", "admin": admin, "code_id": 3}}]})
    api = spark.createDataFrame([(body("first"), DAY), (body("second"), NOW)], "d string, _inserted_timestamp timestamp_ntz").withColumn("data", F.parse_json("d"))
    row = classic_silver.contract_info(api, RUN).first()
    assert (row["_uk"], row["admin"], row["code_id"]) == ("n-/bulk_get_contract_info-a", "first", 3)
