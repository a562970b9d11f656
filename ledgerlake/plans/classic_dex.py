"""Pool swaps, liquidity and liquidity staking of the predecessor chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedupe import tombstoned
from ledgerlake.operators.enrich import labelled, priced
from ledgerlake.operators.joins import lookup, semi
from ledgerlake.plans.classic_calls import (
    PLACE, act, act_has, act_tokens, attr, attr_tokens, msg, msg_has, msg_tokens, ok, with_message,
)

# Factories, farms and strategy contracts; the token with eight decimals; the pool token name.
ASTRO_FACTORY = "terra1fnywlw4edny3vw44x04xd67uzkdqluymgreu7g"
EIGHT_DECIMAL_SWAP_TOKEN = "terra1mddcdx0ujx89f38gu7zspk2r2ffdl5enyz2u03"
MIRROR_FARM = "terra1kehar0l76kzuvrrcwj5um72u3pjq2uvp62aruf"
STRATEGY_CONTRACTS = [
    "terra1g7jjjkt5uvkjeyhp8ecdz4e4hvtn83sud3tmh2", "terra1leadedadm2fguezmd4e445h6fe337yzq8n2dxf",
]
ASTRO_LP_NAME = "astroport LP token"
NATIVE_POOL_SIDES = ["uluna", "uusd"]

SWAP_COLUMNS = [
    "blockchain", "chain_id", "block_id", "msg_index", "tx_index", "block_timestamp", "tx_id", "sender", "offer_amount",
    "offer_amount_usd", "offer_currency", "return_amount", "return_amount_usd", "return_currency", "pool_address",
    "pool_name",
]


def astro_pairs(messages: DataFrame, events: DataFrame) -> DataFrame:
    """Pool contracts created through one factory."""
    made = messages.where(msg_has("execute_msg.create_pair") & (msg("contract") == ASTRO_FACTORY))
    pairs = semi(events.where(F.col("event_type") == "from_contract"), made, "tx_id")
    return pairs.select(attr("pair_contract_addr").alias("pool_address"))


def _swaps(
    actions: DataFrame, messages: DataFrame, hourly: DataFrame, labels: DataFrame, dex: DataFrame, decimals: Column
) -> DataFrame:
    """Swap actions, priced and named; ``decimals`` maps a currency column to its number of decimals."""
    both = with_message(actions.where(F.col("action_method") == "swap"), messages)

    def amount(name: str, asset: str) -> Column:
        raw = act_tokens(name, 0)
        return F.when(act(asset) == EIGHT_DECIMAL_SWAP_TOKEN, raw / decimals).otherwise(raw / 1e6)

    rows = both.select(
        *PLACE, "msg_index", F.col("action_index").alias("tx_index"),
        F.coalesce(msg("sender"), act("sender")).alias("sender"),
        amount("offer_amount", "offer_asset").alias("offer_amount"), act("offer_asset").alias("offer_currency"),
        amount("return_amount", "ask_asset").alias("return_amount"), act("ask_asset").alias("return_currency"),
        F.col("action_contract_address").alias("pool_address"),
    ).where(F.col("offer_amount").isNotNull() & F.col("offer_currency").isNotNull())
    df = priced(rows, hourly, F.col("offer_currency"), {"price": "offer_price"})
    df = priced(df, hourly, F.col("return_currency"), {"price": "return_price"})
    df = labelled(df, labels, F.col("pool_address"), {"address_name": "label_name"})
    df = lookup(df, dex, {"contract_address": F.col("pool_address")}, {"symbol": "pair_symbol"})

    def usd(side: str) -> Column:
        value = F.col(f"{side}_amount") * F.col(f"{side}_price")
        odd = F.col(f"{side}_currency") == EIGHT_DECIMAL_SWAP_TOKEN
        return F.when(odd, value * (decimals / 1e6)).otherwise(value)

    return df.withColumns(
        {
            "offer_amount_usd": usd("offer"), "return_amount_usd": usd("return"),
            "pool_name": F.coalesce("label_name", "pair_symbol"),
        }
    ).select(*SWAP_COLUMNS).distinct()


def ez_astroport_swaps(
    actions: DataFrame, messages: DataFrame, hourly: DataFrame, labels: DataFrame, dex: DataFrame
) -> DataFrame:
    """Swaps that report a maker fee; one token has eight decimals."""
    own = actions.where(act_has("maker_fee_amount"))
    return _swaps(own, messages, hourly, labels, dex, F.lit(1e8))


def ez_terraswap_swaps(
    actions: DataFrame, messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame, dex: DataFrame
) -> DataFrame:
    """Swaps of all pools that the other factory did not create; every token counts six decimals."""
    swaps = actions.where(F.col("action_method") == "swap").withColumn("pool_address", F.col("action_contract_address"))
    own = tombstoned(swaps, astro_pairs(messages, events), "pool_address").drop("pool_address")
    return _swaps(own, messages, hourly, labels, dex, F.lit(1e6))


def _asset(text: Column, part: int) -> tuple[Column, Column]:
    """(tokens, currency) of one side of ``12uusd, 34terra1...``."""
    side = F.split_part(text, F.lit(","), F.lit(part))
    amount = F.regexp_substr(side, F.lit("[0-9]+")).try_cast("double") / 1e6
    return amount, F.regexp_substr(side, F.lit("(u|t)[a-z0-9]+"))


def ez_terraswap_lp_actions(
    actions: DataFrame, messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    """Liquidity provided and withdrawn, with the pool token minted or burnt for the same share.

    The share is matched on the raw integer, not on the scaled double.
    """

    def side(method: str, token_method: str, assets: str, share: str, sender: Column) -> DataFrame:
        amount0, currency0 = _asset(act(assets), 1)
        amount1, currency1 = _asset(act(assets), 2)
        rows = with_message(actions.where(F.col("action_method") == method), messages).select(
            *PLACE, "msg_index", F.lit(method).alias("event_type"), sender.alias("sender"),
            amount0.alias("token_0_amount"), currency0.alias("token_0_currency"),
            amount1.alias("token_1_amount"), currency1.alias("token_1_currency"),
            act_tokens(share).alias("lp_share_amount"), act(share).try_cast("decimal(38,0)").alias("_raw"),
            F.col("action_contract_address").alias("pool_address"),
        )
        tokens = actions.where(F.col("action_method") == token_method).select(
            "tx_id", "msg_index", act("amount").try_cast("decimal(38,0)").alias("_raw"),
            F.col("action_contract_address").alias("lp_pool_address"),
        )
        return rows.join(tokens, ["tx_id", "msg_index", "_raw"], "left")

    given = side(
        "provide_liquidity", "mint", "assets", "share", F.coalesce(act("sender"), msg("sender"))
    )
    taken = side("withdraw_liquidity", "burn", "refund_assets", "withdrawn_share", msg("sender"))
    rows = given.unionByName(taken).where(
        F.col("token_0_currency").isNotNull() & F.col("token_1_currency").isNotNull() & F.col("sender").isNotNull()
    )
    df = tombstoned(rows, astro_pairs(messages, events), "pool_address")
    df = priced(df, hourly, F.col("token_0_currency"), {"price": "price_0"})
    df = priced(df, hourly, F.col("token_1_currency"), {"price": "price_1"})
    df = labelled(df, labels, F.col("pool_address"), {"address_name": "pool_name"})
    df = labelled(df, labels, F.col("lp_pool_address"), {"address_name": "lp_pool_name"})
    usd = lambda i: (F.col(f"token_{i}_amount") * F.col(f"price_{i}")).alias(f"token_{i}_amount_usd")
    return df.select(
        *PLACE, "event_type", "sender", "token_0_amount", usd(0), "token_0_currency", "token_1_amount", usd(1),
        "token_1_currency", "pool_address", "pool_name", "lp_share_amount", "lp_pool_address", "lp_pool_name",
    ).distinct()


def ez_terraswap_lp_stake(
    actions: DataFrame, messages: DataFrame, events: DataFrame, labels: DataFrame, dex: DataFrame
) -> DataFrame:
    """Pool tokens staked and unstaked through six kinds of calls, without the other exchange's pool tokens."""
    foreign = dex.where(F.col("contract_name") == ASTRO_LP_NAME).select("contract_address")

    def shaped(df: DataFrame, kind: str, sender: Column, amount: Column, contract: Column) -> DataFrame:
        return df.select(
            *PLACE, F.lit(kind).alias("event_type"), sender.alias("sender"), amount.alias("amount"),
            contract.alias("contract_address"),
        )

    from_contract = events.where(F.col("event_type") == "from_contract")
    values = ok(messages).select(*PLACE, "msg_index", "msg_value")

    def around(calls: DataFrame, *keys: str) -> DataFrame:
        return calls.join(from_contract.select(*keys, "event_attributes"), list(keys))

    unbond = shaped(
        with_message(actions.where(F.col("action_method") == "unbond"), messages), "unstake_lp",
        F.coalesce(act("staker_addr"), msg("sender")), act_tokens("amount"), act("asset_token"),
    )
    bond = shaped(
        with_message(actions.where(F.col("action_method") == "bond"), messages), "stake_lp",
        F.coalesce(act("owner"), msg("sender")), act_tokens("amount"), msg("contract"),
    )
    reinvest_calls = values.where(
        (msg("contract") == MIRROR_FARM) & msg_has("execute_msg.re_invest.asset_token")
    )
    reinvest = shaped(
        around(reinvest_calls, "tx_id", "msg_index"), "stake_lp", msg("sender"), attr_tokens("share"),
        attr("staking_token"),
    )
    strategy = values.where(msg("contract").isin(STRATEGY_CONTRACTS))
    zap_out = shaped(
        around(strategy.where(msg_has("execute_msg.zap_out_of_strategy.strategy_id")), "tx_id", "msg_index"),
        "unstake_lp", msg("sender"), msg_tokens("execute_msg.zap_out_of_strategy.amount"), attr("staking_token"),
    )
    auto_events = ok(from_contract).where((attr("0_action") == "auto_stake") & (attr("5_action") == "mint"))
    auto = shaped(
        auto_events.join(messages.select("tx_id", "msg_index", "msg_value"), ["tx_id", "msg_index"], "left"),
        "stake_lp", msg("sender"), attr_tokens("share"), attr("5_contract_address"),
    )
    zap_in = shaped(
        around(strategy.where(msg_has("execute_msg.zap_into_strategy.strategy_id")), "tx_id"),
        "stake_lp", msg("sender"), attr_tokens("share"), attr("lp_token"),
    )
    rows = unbond
    for part in (bond, reinvest, zap_out, auto, zap_in):
        rows = rows.unionByName(part)
    rows = rows.where(
        F.col("sender").isNotNull() & F.col("amount").isNotNull() & ~F.col("contract_address").isin(NATIVE_POOL_SIDES)
    )
    kept = tombstoned(rows, foreign, "contract_address")
    named = labelled(kept, labels, F.col("contract_address"), {"address_name": "contract_label"})
    return named.select(*PLACE, "event_type", "sender", "amount", "contract_address", "contract_label").distinct()


