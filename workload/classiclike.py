"""Sink-log records of the predecessor chain made from the orders table by Spark, row by row.

An order is a transaction with one message, or two of some kinds; the order key decides which kind. Payloads are JSON templates with a few
fields filled in. Every record also arrives as a re-org copy one block earlier and as an older copy; both are empty
and must vanish.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.enrich import hourly_prices, published_labels
from ledgerlake.plans import classic_bronze, classic_dex, classic_prices, classic_silver
from ledgerlake.plans import classic_lending as lending
from ledgerlake.plans.classic_silver import WORMHOLE
from ledgerlake.run import Run
from workload import table
from workload.relational import cents
from workload.shared import Stage, spread, stage

RUN = Run(datetime(2010, 1, 1), label_creator="curator")
FIRST_DAY = "1992-01-01"


def _call(contract: str, execute: str, extra: str = "") -> str:
    return '{"sender":"<u>","contract":"' + contract + '"' + extra + ',"execute_msg":' + execute + "}"


def _coins(denom: str, amount: str = "<n>") -> str:
    return '[{"denom":"' + denom + '","amount":"' + amount + '"}]'


WASM = ("wasm", "wasm/MsgExecuteContract")
USD_COINS = ',"coins":' + _coins("uusd")
_BRIDGED = '{"process_anchor_message":{"option_token_info":"x"}}'

# kind -> (module, message type, message value)
MESSAGES: dict[str, tuple[str, str, str]] = {
    "send": ("bank", "bank/MsgSend", '{"from_address":"<u>","to_address":"<v>","amount":' + _coins("uusd") + "}"),
    "multi": (
        "bank", "bank/MsgMultiSend",
        '{"inputs":[{"address":"<u>","coins":' + _coins("ukrw") + '},{"address":"<v>","coins":' + _coins("uluna", "<k>")
        + '}],"outputs":[{"address":"<v>"},{"address":"<u>"}]}',
    ),
    "token": (*WASM, _call("tokA", '{"transfer":{"recipient":"<v>","amount":"<n>"}}')),
    "wrapped": (*WASM, _call(WORMHOLE, '{"submit_vaa":{"data":"x"}}')),
    "native": (*WASM, _call(WORMHOLE, '{"submit_vaa":{"data":"y"}}')),
    "delegate": ("staking", "staking/MsgDelegate", '{"delegator_address":"<u>","validator_address":"user1","amount":{"amount":"<n>","denom":"uluna"}}'),
    "undelegate": ("staking", "staking/MsgUndelegate", '{"delegator_address":"<u>","validator_address":"user1","amount":{"amount":"<n>","denom":"uluna"}}'),
    "redelegate": ("staking", "staking/MsgBeginRedelegate", '{"delegator_address":"<u>","validator_dst_address":"user2","amount":{"amount":"<n>","denom":"uluna"}}'),
    "reward": ("distribution", "distribution/MsgWithdrawDelegationReward", '{"delegator_address":"<u>","validator_address":"user2"}'),
    "commission": ("distribution", "distribution/MsgWithdrawValidatorCommission", '{"validator_address":"user3"}'),
    "proposal": (
        "gov", "gov/MsgSubmitProposal",
        '{"proposer":"<u>","content":{"type":"text","value":{"title":"T<id>","description":"D"}},"initial_deposit":' + _coins("uluna") + "}",
    ),
    "vote": ("gov", "gov/MsgVote", '{"voter":"<u>","proposal_id":"<id>","option":"yes"}'),
    "swap": ("market", "market/MsgSwap", '{"trader":"<u>","ask_denom":"ukrw","offer_coin":{"amount":"<n>","denom":"uusd"}}'),
    "claim": (*WASM, _call("airdrop", '{"claim":{"stage":"1","amount":"<n>"}}')),
    "bond": (*WASM, _call(lending.BOND_HUB, '{"bond":{"validator":"user4"}}', ',"coins":' + _coins("uluna"))),
    "borrow": (*WASM, _call(lending.MARKET, '{"borrow_stable":{"borrow_amount":"<n>"}}')),
    "burn": (*WASM, _call("tokA", '{"send":{"contract":"' + lending.BOND_HUB + '","amount":"<n>","msg":{"unbond":{}}}}')),
    "deposit": (*WASM, _call(lending.MARKET, '{"deposit_stable":{}}', USD_COINS)),
    "redeem": (*WASM, _call(lending.DEPOSIT_TOKEN, '{"send":{"contract":"' + lending.MARKET + '","amount":"<n>"}}')),
    "repay": (*WASM, _call(lending.MARKET, '{"repay_stable":{}}', USD_COINS)),
    "collateral": (*WASM, _call(lending.MARKET, '{"withdraw_collateral":{}}')),
    "pool_swap": (*WASM, _call("pool1", '{"swap":{}}')),
    "provide": (*WASM, _call("pool1", '{"provide_liquidity":{}}')),
    "stake_lp": (*WASM, _call("tokLP", '{"send":{}}')),
    "liquidate": (*WASM, _call("queue", '{"submit_bid":{"collateral_token":"uusd","premium_rate":"3"}}')),
    "gov_stake": (
        *WASM, _call(lending.GOVERNANCE_TOKEN, '{"send":{"contract":"' + lending.GOVERNANCE + '","amount":"<n>","msg":{"stake_voting_tokens":{}}}}'),
    ),
    "gov_unstake": (*WASM, _call(lending.GOVERNANCE, '{"withdraw_voting_tokens":{"amount":"<n>"}}')),
    "poll": (
        *WASM,
        _call(
            lending.GOVERNANCE_TOKEN,
            '{"send":{"contract":"' + lending.GOVERNANCE + '","amount":"<n>","msg":{"create_poll":{"title":"T<id>","link":"L",'
            '"description":"D","execute_msg":{"msg":"m"}}}}}',
        ),
    ),
    "cast": (*WASM, _call(lending.GOVERNANCE, '{"cast_vote":{"poll_id":"<id>","vote":"yes","amount":"<n>"}}')),
    "rewards": (*WASM, _call(lending.MARKET, '{"claim_rewards":{}}')),
    "lp_rewards": (*WASM, _call(lending.LP_REWARDS, '{"withdraw":{}}')),
    "instantiate": ("wasm", "wasm/MsgInstantiateContract", '{"init_msg":{"decimals":6,"name":"N<id>","symbol":"S<id>"}}'),
    "pair": (*WASM, _call("factory", '{"create_pair":{}}')),
    "feed": (*WASM, _call("feeder", '{"feed_price":{"prices":[["tokA","1.5"],["tokB","2.5"],["' + classic_dex.EIGHT_DECIMAL_SWAP_TOKEN + '","3"]]}}')),
    "auto_stake": (*WASM, _call("farm", '{"auto_stake":{}}')),
    "astro_pair": (*WASM, _call(classic_dex.ASTRO_FACTORY, '{"create_pair":{}}')),
    "astro_swap": (*WASM, _call("astro<k>", '{"swap":{}}')),
    "astro_provide": (*WASM, _call("astro<k>", '{"provide_liquidity":{}}')),
    "withdraw_lp": (*WASM, _call("lp1", '{"send":{"contract":"pool1","amount":"<id>"}}')),
    "unstake_lp": (*WASM, _call("farm", '{"unbond":{}}')),
    "reinvest": (*WASM, _call(classic_dex.MIRROR_FARM, '{"re_invest":{"asset_token":"tokA"}}')),
    "zap_out": (*WASM, _call(classic_dex.STRATEGY_CONTRACTS[0], '{"zap_out_of_strategy":{"strategy_id":"1","amount":"<n>"}}')),
    "zap_in": (*WASM, _call(classic_dex.STRATEGY_CONTRACTS[1], '{"zap_into_strategy":{"strategy_id":"2"}}')),
    "bridge_deposit": (*WASM, _call("bridge", _BRIDGED)),
    "bridge_borrow": (*WASM, _call("bridge", _BRIDGED)),
    "bridge_redeem": (*WASM, _call("bridge", _BRIDGED)),
    "vault_redeem": (*WASM, _call("vault", '{"exit":{}}')),
    "bridge_repay": (*WASM, _call("bridge", _BRIDGED)),
    "bridge_collateral": (*WASM, _call("bridge", _BRIDGED)),
    "collateral_in": (*WASM, _call("tokA", '{"send":{"contract":"' + lending.COLLATERAL_CONTRACTS[0] + '","amount":"<n>"}}')),
    "multi_claim": (*WASM, _call(lending.LP_REWARDS, '{"withdraw":{}}')),
    "set_up": (*WASM, _call("council", '{"execute":{"proposal_id":"<id>"}}')),
    "whitelist": (*WASM, _call(classic_silver.MIRROR_FACTORY, '{"whitelist":{}}')),
    "relist": (*WASM, _call("council", '{"execute_poll":{"poll_id":"<id>"}}')),
}
# the second message of the kinds that have two
SECOND: dict[str, tuple[str, str, str]] = {
    "collateral_in": (*WASM, _call("overseer", '{"lock_collateral":{}}')),
    "multi_claim": (*WASM, _call(lending.MARKET, '{"claim_rewards":{}}')),
}
KINDS = list(MESSAGES)


def _redeemed(holder: str) -> str:
    """Actions of a redemption whose deposit tokens ``holder`` sent to the market."""
    return (
        '{"0_a":{"contract_address":"' + lending.DEPOSIT_TOKEN + '","action_log":{"action":"send","from":"' + holder + '","to":"' + lending.MARKET + '"}},'
        '"1_a":{"contract_address":"' + lending.MARKET + '","action_log":{"action":"redeem_stable","redeem_amount":"<n>"}}}'
    )


_TO = '"0_sender":"<u>","0_recipient":"<v>","0_amount":'
# kind -> events as (type, attributes, actions)
EVENTS: dict[str, list[tuple[str, str, str]]] = {
    "send": [("transfer", "{" + _TO + _coins("uusd") + "}", ""), ("message", '{"sender":"<u>","module":"bank"}', "")],
    "token": [("from_contract", '{"0_action":"transfer","0_from":"<u>","0_to":"<v>","0_contract_address":"tokA","0_amount":"<n>"}', "")],
    "wrapped": [
        ("from_contract", '{"0_action":"complete_transfer_wrapped","0_contract_address":"' + WORMHOLE + '","0_amount":"<n>","recipient":"<v>","contract":"tokB"}', ""),
        ("message", '{"sender":"relay","contract":"tokB"}', ""),
    ],
    "native": [
        ("from_contract", '{"action":"complete_transfer_terra_native","contract_address":"' + WORMHOLE + '"}', ""),
        ("transfer", '{"0_sender":"bridge","0_recipient":"<v>","0_amount":' + _coins("uluna") + "}", ""),
    ],
    "reward": [("withdraw_rewards", '{"validator":"user2","amount":[{"denom":"uluna","amount":"<n>"},{"denom":"uusd","amount":"<k>"}]}', "")],
    "commission": [("coin_received", '{"receiver":"<u>","amount":' + _coins("uluna") + "}", "")],
    "proposal": [("proposal_deposit", '{"proposal_id":"<id>"}', "")],
    "swap": [
        ("transfer", "{" + _TO + _coins("uusd") + ',"1_sender":"<v>","1_recipient":"<u>","1_amount":' + _coins("ukrw", "<k>") + "}", ""),
        ("swap", '{"swap_fee":' + _coins("uusd", "<k>") + "}", ""),
    ],
    "bond": [("from_contract", '{"exchange_rate":"1"}', "")],
    "borrow": [("wasm", "{}", '{"0_a":{"contract_address":"' + lending.MARKET + '","action_log":{"action":"borrow_stable","borrower":"<u>","borrow_amount":"<n>"}}}')],
    "burn": [("from_contract", '{"burnt_amount":"<n>"}', "")],
    "deposit": [
        (
            "from_contract", '{"0_action":"deposit_stable","mint_amount":"<k>","1_contract_address":"' + lending.DEPOSIT_TOKEN + '"}',
            '{"0_a":{"contract_address":"' + lending.MARKET + '","action_log":{"action":"deposit_stable","depositor":"<u>","deposit_amount":"<n>","mint_amount":"<k>"}},'
            '"1_a":{"contract_address":"' + lending.DEPOSIT_TOKEN + '","action_log":{"action":"mint","to":"<u>","amount":"<k>"}}}',
        ),
    ],
    "redeem": [("from_contract", '{"redeem_amount":"<n>"}', "")],
    "repay": [("wasm", "{}", '{"0_a":{"contract_address":"' + lending.MARKET + '","action_log":{"method":"repay_stable","borrower":"<u>","repay_amount":"<n>"}}}')],
    "collateral": [("from_contract", '{"collaterals":[{"denom":"tokA","amount":"<n>"}]}', "")],
    "pool_swap": [
        (
            "wasm", "{}",
            '{"2_a":{"contract_address":"pool1","action_log":{"action":"swap","sender":"x","offer_asset":"uusd","offer_amount":"<n>",'
            '"ask_asset":"ukrw","return_amount":"<k>"}}}',
        ),
    ],
    "provide": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"pool1","action_log":{"action":"provide_liquidity","sender":"<u>","assets":"<n>uusd, <k>ukrw","share":"<id>"}},'
            '"1_a":{"contract_address":"lp1","action_log":{"action":"mint","amount":"<id>"}}}',
        ),
    ],
    "stake_lp": [("wasm", "{}", '{"0_a":{"contract_address":"farm","action_log":{"action":"bond","owner":"<u>","amount":"<n>"}}}')],
    "liquidate": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"custody","action_log":{"action":"liquidate_collateral","borrower":"<v>","liquidator":"<u>","amount":"<n>"}},'
            '"1_a":{"contract_address":"queue","action_log":{"action":"execute_bid","bid_fee":"<k>","collateral_amount":"<n>","collateral_token":"uusd"}}}',
        ),
    ],
    "gov_stake": [("from_contract", '{"share":"<k>"}', "")],
    "poll": [("from_contract", '{"poll_id":"<id>","end_height":"<k>"}', "")],
    "rewards": [("from_contract", '{"0_action":"claim_rewards","claim_amount":"<n>","2_contract_address":"' + lending.GOVERNANCE_TOKEN + '"}', "")],
    "lp_rewards": [("from_contract", '{"0_action":"withdraw","0_amount":"<n>","1_contract_address":"' + lending.GOVERNANCE_TOKEN + '"}', "")],
    "instantiate": [("instantiate_contract", '{"contract_address":"terra1c<id>","owner":"<u>"}', "")],
    "pair": [
        (
            "wasm",
            '{"action":"create_pair","0_contract_address":"user5","pair_contract_addr":"pool<id>","liquidity_token_addr":"lp<id>","pair":"uusd-terra1c<id>"}',
            "",
        ),
    ],
    "auto_stake": [("from_contract", '{"0_action":"auto_stake","5_action":"mint","5_contract_address":"tokLP","share":"<n>"}', "")],
    "astro_pair": [("from_contract", '{"pair_contract_addr":"astro<k>"}', "")],
    "astro_swap": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"astro<k>","action_log":{"action":"swap","sender":"x","offer_asset":"' + classic_dex.EIGHT_DECIMAL_SWAP_TOKEN
            + '","offer_amount":"<n>","ask_asset":"uusd","return_amount":"<k>","maker_fee_amount":"1"}}}',
        ),
    ],
    "astro_provide": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"astro<k>","action_log":{"action":"provide_liquidity","sender":"<u>","assets":"<n>uusd, <k>ukrw","share":"<id>"}},'
            '"1_a":{"contract_address":"lp2","action_log":{"action":"mint","amount":"<id>"}}}',
        ),
    ],
    "withdraw_lp": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"pool1","action_log":{"action":"withdraw_liquidity","refund_assets":"<n>uusd, <k>ukrw","withdrawn_share":"<id>"}},'
            '"1_a":{"contract_address":"lp1","action_log":{"action":"burn","amount":"<id>"}}}',
        ),
    ],
    "unstake_lp": [
        ("wasm", "{}", '{"0_a":{"contract_address":"farm","action_log":{"action":"unbond","staker_addr":"<v>","amount":"<n>","asset_token":"tokLP"}}}'),
    ],
    "reinvest": [("from_contract", '{"share":"<n>","staking_token":"tokLP"}', "")],
    "zap_out": [("from_contract", '{"staking_token":"tokLP"}', "")],
    "zap_in": [("from_contract", '{"share":"<n>","lp_token":"tokLP"}', "")],
    "bridge_deposit": [
        (
            "wasm", "{}",
            '{"0_a":{"contract_address":"' + lending.MARKET + '","action_log":{"action":"deposit_stable","depositor":"<v>","deposit_amount":"<n>","mint_amount":"<k>"}},'
            '"1_a":{"contract_address":"' + lending.DEPOSIT_TOKEN + '","action_log":{"action":"mint","to":"<v>","amount":"<k>"}}}',
        ),
    ],
    "bridge_borrow": [("wasm", "{}", '{"0_a":{"contract_address":"' + lending.MARKET + '","action_log":{"action":"borrow_stable","borrower":"<v>","borrow_amount":"<n>"}}}')],
    "bridge_redeem": [("wasm", "{}", _redeemed("<v>"))],
    "vault_redeem": [("wasm", "{}", _redeemed("vault"))],
    "bridge_repay": [("wasm", "{}", '{"0_a":{"contract_address":"custody","action_log":{"action":"repay_stable","withdraw_amount_ust":"<n>"}}}')],
    "bridge_collateral": [
        (
            "from_contract", '{"collaterals":[{"denom":"' + lending.EIGHT_DECIMAL_COLLATERAL + '","amount":"<n>"}]}',
            '{"0_a":{"contract_address":"custody","action_log":{"action":"lock_collateral","borrower":"<u>","amount":"<n>"}},'
            '"1_a":{"contract_address":"overseer","action_log":{"action":"lock_collateral","borrower":"<u>"}},'
            '"2_a":{"contract_address":"custody","action_log":{"action":"withdraw_collateral","borrower":"<v>","amount":"<k>"}}}',
        ),
    ],
    "set_up": [("instantiate_contract", '{"0_contract_address":"terra1a<id>","1_contract_address":"terra1b<id>","0_code_id":"7"}', "")],
    "whitelist": [("from_contract", '{"0_asset_token":"terra1w<id>"}', "")],
    "relist": [("from_contract", '{"1_action":"whitelist","1_contract_address":"' + classic_silver.MIRROR_FACTORY + '","1_asset_token":"terra1r<id>"}', "")],
    "multi_claim": [("from_contract", '{"0_action":"withdraw","0_amount":"<k>","1_contract_address":"' + lending.GOVERNANCE_TOKEN + '"}', "")],
}
SECOND_EVENTS = {
    "collateral_in": [("wasm", "{}", "")],
    "multi_claim": [("from_contract", '{"0_action":"claim_rewards","claim_amount":"<n>","2_contract_address":"' + lending.GOVERNANCE_TOKEN + '"}', "")],
}


def orders(spark, sf) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.element_at(kinds, (F.col("o_orderkey") % len(KINDS) + 1).cast("int")).alias("kind"),
        F.concat(F.lit("user"), (F.col("o_custkey") % 40).cast("string")).alias("u"),
        F.concat(F.lit("peer"), (F.col("o_orderkey") % 5).cast("string")).alias("v"),
        cents("o_totalprice").cast("string").alias("n"),
        F.col("o_custkey").cast("string").alias("k"),
        F.md5(F.col("o_orderkey").cast("string")).alias("hash"),
        F.to_date("o_orderdate").alias("day"),
        F.date_diff(F.to_date("o_orderdate"), F.lit(FIRST_DAY).cast("date")).alias("d"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "columbus-4").otherwise("columbus-5").alias("chain"),
    )


def _lookup(pairs: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), F.col("kind"))


def _filled(template: Column) -> Column:
    for name in ("u", "v", "n", "k", "id"):
        template = F.replace(template, F.lit(f"<{name}>"), F.col(name))
    return template


def _copies(rows: DataFrame) -> DataFrame:
    """copy 0: a re-org'd block; 1: the record that counts; 2: an older record of the same row."""
    return rows.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn(
        "block", F.col("d") - F.when(F.col("copy") == 0, 1).otherwise(0)
    )


def _payload(value: Column) -> Column:
    return F.when(F.col("copy") == 1, value).otherwise("{}")


def _result(*fields: tuple[str, Column]) -> Column:
    """Text of one ``results`` entry up to its last fields, which are JSON already; no value needs an escape."""
    text = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
    number = lambda name, value: F.concat(F.lit(f'"{name}":'), value.cast("string"))
    return F.concat(
        F.lit("{"), F.concat_ws(
            ",", F.lit('"blockchain":"terra"'), number("block_id", F.col("block")),
            text("block_timestamp", F.concat(F.col("day").cast("string"), F.lit(" 00:00:00"))), text("chain_id", F.col("chain")),
            text("txhash", F.col("hash")), text("tx_status", F.col("status")), F.lit('"tx_module":"m","tx_type":"t"'),
            number("msg_index", F.col("msg_index")), text("msg_module", F.col("module")), text("msg_type", F.col("type")),
            *[number(name, value) if name.endswith("index") else text(name, value) for name, value in fields],
        ),
    )


def _record(model: str, result: Column) -> Column:
    content = F.concat(F.lit('{"model":{"name":"' + model + '","blockchain":"columbus"},"results":['), result, F.lit("]}"))
    created = F.when(F.col("copy") == 1, 2000).otherwise(1000)
    metadata = F.concat(F.lit('{"CreateTime":'), created.cast("string"), F.lit("}"))
    record = F.struct(
        F.parse_json(metadata).alias("record_metadata"), F.parse_json(content).alias("record_content"),
        F.col("day").cast("timestamp_ntz").alias("_inserted_timestamp"),
    )
    # a generator is a boundary that the filters of a stream do not cross, so a record is made and parsed once
    return F.inline(F.array(record))


def message_log(spark, sf) -> DataFrame:
    return _messages(spark, sf, MESSAGES, 0).unionByName(_messages(spark, sf, SECOND, 1))


def event_log(spark, sf) -> DataFrame:
    return _events(spark, sf, MESSAGES, EVENTS, 0).unionByName(_events(spark, sf, SECOND, SECOND_EVENTS, 1))


def _sent(spark, sf, messages: dict, index: int) -> DataFrame:
    """Records of the messages with this index, without their payload."""
    rows = _copies(orders(spark, sf).where(F.col("kind").isin(list(messages))))
    return rows.withColumns(
        {"module": _lookup({k: m[0] for k, m in messages.items()}), "type": _lookup({k: m[1] for k, m in messages.items()}), "msg_index": F.lit(index)}
    )


def _messages(spark, sf, messages: dict, index: int) -> DataFrame:
    value = _payload(_filled(_lookup({k: m[2] for k, m in messages.items()})))
    result = F.concat(_result(), F.lit(',"msg_value":'), value, F.lit("}"))
    return _sent(spark, sf, messages, index).select(_record("terra-5_msg_model", result))


def _events(spark, sf, messages: dict, events: dict, index: int) -> DataFrame:
    most = max(len(e) for e in events.values())
    rows = _sent(spark, sf, messages, index)
    slots = []
    for i in range(most):
        own = {k: e[i] for k, e in events.items() if len(e) > i}
        slots.append(
            F.struct(
                F.lit(i).alias("i"), _lookup({k: e[0] for k, e in own.items()}).alias("event"),
                _lookup({k: e[1] for k, e in own.items()}).alias("attributes"),
                F.nullif(_lookup({k: e[2] for k, e in own.items()}), F.lit("")).alias("actions"),
            )
        )
    flat = rows.withColumn("e", F.explode(F.array(*slots))).where(F.col("e.event").isNotNull())
    head = _result(("event_type", F.col("e.event")), ("event_index", F.col("e.i")))
    actions = F.coalesce(
        F.concat(F.lit(',"event_attributes_actions":'), _payload(_filled(F.col("e.actions")))), F.lit("")
    )
    result = F.concat(head, F.lit(',"event_attributes":'), _payload(_filled(F.col("e.attributes"))), actions, F.lit("}"))
    return flat.select(_record("terra-5_msg_event_model", result))


def days(spark, sf) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(day.alias("day")).distinct().withColumn(
        "d", F.date_diff("day", F.lit(FIRST_DAY).cast("date"))
    )


def legacy_prices(spark, sf) -> DataFrame:
    """Market prices per day; the native coin has none on every third day."""
    quote = lambda symbol, price, asset: F.struct(
        F.lit(symbol).alias("symbol"), price.cast("double").alias("price"), F.lit(asset).alias("asset_id")
    )
    quotes = F.array(
        quote("LUNA", F.when(F.col("d") % 3 != 0, F.col("d") % 10 + 1), "4172"), quote("MIR", F.lit(2), "7857"),
        quote("ANC", F.lit(4), "8857"), quote("MINE", F.lit(0.5), "10767"),
    )
    rows = days(spark, sf).select(F.col("day").cast("timestamp_ntz").alias("recorded_at"), F.inline(quotes))
    return rows.where(F.col("price").isNotNull()).withColumn("provider", F.lit("feed"))


def transition_log(spark, sf) -> DataFrame:
    entry = lambda denom, rate, i: (
        '{"blockchain":"terra","block_id":<d>,"block_timestamp":"<day>","chain_id":"columbus-5","event":"exchange_rate_update",'
        f'"index":{i},"transition_type":"end","attributes":' + '{"denom":"' + denom + '","exchange_rate":"' + rate + '"}}'
    )
    body = '{"model":{"name":"terra-5_transition_model"},"results":[' + entry("uusd", "2", 0) + "," + entry("ukrw", "4", 1) + "]}"
    text = F.replace(
        F.replace(F.lit(body), F.lit("<d>"), F.col("d").cast("string")), F.lit("<day>"),
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" 00:00:00")),
    )
    return days(spark, sf).select(
        F.parse_json(F.lit('{"CreateTime":1000}')).alias("record_metadata"), F.parse_json(text).alias("record_content"),
        F.col("day").cast("timestamp_ntz").alias("_inserted_timestamp"),
    )


def label_log(spark, sf) -> DataFrame:
    """Labels for user0..user24 and the market contract, and one deletion on another chain.

    From nation 20 on the label is a validator's: the user is its delegator, ``vp<n>`` its voting-power address.
    """
    key, validator = F.col("n_nationkey"), F.col("n_nationkey") >= 20
    number = key.cast("string")

    def entry(address: Column, name: Column) -> Column:
        project = F.when(validator, F.concat(F.lit("val"), number)).otherwise(
            F.concat(F.lit("project"), F.col("n_regionkey").cast("string"))
        )
        return F.struct(
            address.alias("address"), F.lit("curator").alias("creator"), F.lit("operator").alias("l1_label"),
            F.lit("sub").alias("l2_label"), name.alias("address_name"), project.alias("project_name"),
        )

    user = entry(
        F.concat(F.lit("USER"), number), F.when(validator, F.lit("delegator_address")).otherwise(F.col("n_name"))
    )
    power = entry(F.concat(F.lit("VP"), number), F.lit("vp_address"))
    body = F.to_json(F.when(validator, F.array(user, power)).otherwise(F.array(user)))
    nations = table(spark, sf, "nation").select(F.lit('"labels-terra-1650000000"').alias("key"), body.alias("body"))
    region = table(spark, sf, "region").where(F.col("r_regionkey") == 0)
    market = F.struct(
        F.lit(lending.MARKET).alias("address"), F.lit("curator").alias("creator"), F.lit("defi").alias("l1_label"),
        F.lit("pool").alias("l2_label"), F.col("r_name").alias("address_name"), F.lit("market").alias("project_name"),
    )
    gone = F.struct(F.lit("USER7").alias("address"), F.lit("true").alias("delete"))
    more = region.select(F.lit('"labels-terra-1650000001"').alias("key"), F.to_json(F.array(market)).alias("body")).unionByName(
        region.select(F.lit('"labels-osmosis-1650000002"').alias("key"), F.to_json(F.array(gone)).alias("body"))
    )
    metadata = F.to_json(F.struct("key", F.lit(1000).alias("CreateTime")))
    return nations.unionByName(more).select(
        F.parse_json(metadata).alias("record_metadata"), F.parse_json("body").alias("record_content")
    )


def balance_log(spark, sf) -> DataFrame:
    """Staked balances: one log record per delegation order, a few seconds into its day."""
    entry = F.struct(
        F.col("u").alias("address"), F.col("n").alias("balance"), F.lit("staked").alias("balance_type"),
        F.col("id").alias("block_id"),
        F.concat(
            F.date_format("day", "yyyy-MM-dd"), F.lit(" "),
            F.date_format(F.timestamp_seconds(F.col("id").cast("bigint") % 86400), "HH:mm:ss"),
        ).alias("block_timestamp"),
        F.lit("terra-5").alias("blockchain"), F.lit("LUNA").alias("currency"),
    )
    content = F.struct(
        F.struct(F.lit("terra.balances.models.Terra5BalancesModel").alias("class")).alias("model"),
        F.array(entry).alias("results"),
    )
    rows = orders(spark, sf).where(F.col("kind") == "delegate")
    return rows.select(
        F.parse_json(F.lit('{"CreateTime":1000}')).alias("record_metadata"),
        F.parse_json(F.to_json(content)).alias("record_content"),
        F.col("day").cast("timestamp_ntz").alias("_inserted_timestamp"),
    )


def voting_power(spark, sf) -> DataFrame:
    """Validators' power per day: the day number times a thousand plus the validator's number."""
    validators = F.explode(F.sequence(F.lit(20), F.lit(24)))
    return days(spark, sf).withColumn("val", validators).select(
        F.col("d").cast("bigint").alias("block_number"), F.col("day").cast("timestamp_ntz").alias("block_timestamp"),
        F.lit("terra").alias("blockchain"), F.concat(F.lit("vp"), F.col("val").cast("string")).alias("address"),
        (F.col("d") * 1000 + F.col("val")).cast("bigint").alias("voting_power"),
    )


def small_log(spark, sf, model: str, result: Column, rows: DataFrame, extra: str = "") -> DataFrame:
    """A log of one entry per row for the smaller streams, each record sent twice, the second time later."""
    content = F.concat(F.lit('{"model":{"name":"' + model + '"' + extra + '},"results":['), result, F.lit("]}"))
    sent = rows.withColumn("created", F.explode(F.array(F.lit(1000), F.lit(2000))))
    return sent.select(
        F.parse_json(F.concat(F.lit('{"CreateTime":'), F.col("created").cast("string"), F.lit("}"))).alias("record_metadata"),
        F.parse_json(content).alias("record_content"),
        F.col("day").cast("timestamp_ntz").alias("_inserted_timestamp"),
    )


def block_log(spark, sf) -> DataFrame:
    """One block a day with its number of transactions; the first record of a block does not know it yet."""
    rows = orders(spark, sf).groupBy("day", "d").agg(F.count(F.lit(1)).alias("n"))
    result = F.to_json(
        F.struct(
            F.col("d").alias("block_id"), F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("block_timestamp"),
            F.lit("terra").alias("blockchain"), F.concat(F.lit("prop"), (F.col("d") % 5).cast("string")).alias("proposer_address"),
            F.when(F.col("created") == 2000, F.col("n")).otherwise(0).alias("num_txs"),
        )
    )
    return small_log(spark, sf, "terra_block_model", result, rows, ',"blockchain":"columbus"')


def transaction_log(spark, sf) -> DataFrame:
    result = F.to_json(
        F.struct(
            F.col("d").alias("block_id"), F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("block_timestamp"),
            F.col("chain").alias("chain_id"), F.col("hash").alias("tx_id"), F.array("u").alias("tx_from"), F.col("status").alias("tx_status"),
            F.array(F.struct(F.col("k").alias("amount"))).alias("fee"),
            F.when(F.col("created") == 2000, F.col("n")).otherwise("0").alias("gas_used"),
        )
    )
    return small_log(spark, sf, "terra_tx_model", result, orders(spark, sf), ',"run_id":"v2022.03.02.0"')


def contract_details(spark, sf) -> DataFrame:
    """Details of contracts from the endpoint: of one contract of each set-up, of listed assets, and others under the names of known ones."""
    first = F.element_at(F.create_map(*[F.lit(x) for x in ("set_up", "a", "whitelist", "w", "relist", "r", "instantiate", "c")]), F.col("kind"))
    rows = orders(spark, sf).where(F.col("kind").isin("set_up", "whitelist", "relist", "instantiate")).withColumn("first", first)
    details = F.struct(F.lit(8).alias("decimals"), F.concat(F.lit("Name "), "first", "id").alias("name"), F.concat("first", "id").alias("symbol"))
    own = rows.select(F.concat(F.lit("terra1"), "first", "id").alias("address"), F.parse_json(F.to_json(details)).alias("init_msg"))
    other = rows.where(F.col("kind") == "whitelist").select(
        F.lit(classic_silver.DECODED_ELSEWHERE[0]).alias("address"), F.parse_json(F.lit('{"name":"known elsewhere"}')).alias("init_msg")
    )
    return own.unionByName(other)


class _Classic(Stage):
    """Silver tables of the derived log; a table that a query reads several times is written once."""

    @cached_property
    def bronze_msgs(self) -> DataFrame:
        return self.settle(classic_bronze.classic_msgs(message_log(self.spark, self.sf)), "bronze")

    @cached_property
    def msgs(self) -> DataFrame:
        return self.settle(classic_silver.msgs(self.bronze_msgs), "msgs")

    @cached_property
    def bronze_events(self) -> DataFrame:
        """Typed events with their actions; both silver tables read it, so the log is parsed once."""
        return self.settle(classic_bronze.classic_msg_events_actions(event_log(self.spark, self.sf), all_events=True), "bronze")

    @cached_property
    def events(self) -> DataFrame:
        return self.settle(classic_silver.msg_events(self.bronze_events.drop("event_attributes_actions")), "events")

    @cached_property
    def actions(self) -> DataFrame:
        with_actions = self.bronze_events.where(F.col("event_attributes_actions").isNotNull())
        return self.settle(classic_silver.event_actions(with_actions), "actions")

    @cached_property
    def all_labels(self) -> DataFrame:
        return self.settle(classic_silver.address_labels(label_log(self.spark, self.sf)), "labels")

    @cached_property
    def labels(self) -> DataFrame:
        return published_labels(self.all_labels, RUN.label_creator)

    @cached_property
    def transitions(self) -> DataFrame:
        return classic_silver.transitions(classic_bronze.classic_transitions(transition_log(self.spark, self.sf)))

    @cached_property
    def prices(self) -> DataFrame:
        return self.settle(
            classic_prices.dim_oracle_prices(legacy_prices(self.spark, self.sf), self.transitions, self.msgs, self.labels), "prices"
        )

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly_prices(self.prices)

    @cached_property
    def metadata(self) -> DataFrame:
        return classic_silver.contract_metadata(self.events, self.msgs, contract_details(self.spark, self.sf))

    @cached_property
    def dex(self) -> DataFrame:
        return self.settle(classic_silver.dex_contracts(self.events, self.labels, self.metadata), "dex")

    @cached_property
    def no_history(self) -> DataFrame:
        return self.spark.createDataFrame(
            [],
            "address string, balance double, balance_type string, block_number bigint, block_timestamp timestamp_ntz, "
            "blockchain string, currency string",
        )

    @cached_property
    def balances(self) -> DataFrame:
        return classic_silver.balances(classic_bronze.classic_balances(balance_log(self.spark, self.sf)), self.no_history)

    @cached_property
    def daily(self) -> DataFrame:
        return classic_silver.daily_balances(self.balances, RUN)


def Classic(spark, sf) -> _Classic:  # noqa: N802
    return stage(_Classic, spark, sf)
