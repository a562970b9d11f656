"""Published facts, dimensions, transfers, staking and governance of the predecessor chain.

``labels`` is the label table after ``published_labels``; ``hourly`` is ``hourly_prices`` of the oracle prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import vdec, vdouble, vstr, vvar
from ledgerlake.operators.dedupe import latest_by, tombstoned
from ledgerlake.operators.enrich import label_columns, labelled, priced
from ledgerlake.operators.flatten import flatten_array, flatten_object
from ledgerlake.operators.joins import lookup, semi
from ledgerlake.operators.ordered import carry_forward
from ledgerlake.plans.classic_silver import SUCCEEDED, WORMHOLE


def _ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("tx_status") == SUCCEEDED)


def _unquoted(path: str) -> Column:
    return F.replace(vstr("msg_value", path), F.lit('"'), F.lit(""))


# ---------------------------------------------------------------- facts and plain dimensions


def fact_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.select("block_id", "block_timestamp", "blockchain", "chain_id", "proposer_address", "tx_count")


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "tx_from", "tx_to", "tx_type", "tx_status",
        "tx_status_msg", "tx_code", "tx_module", "codespace", "fee", "gas_used", "gas_wanted",
    )


def fact_messages(messages: DataFrame) -> DataFrame:
    return messages.select(
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "tx_status", "tx_module", "tx_type",
        "tx_memo", "msg_index", "msg_module", "msg_type", "msg_value",
    )


def fact_message_events(events: DataFrame) -> DataFrame:
    return events.select(
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "tx_status", "tx_module", "tx_type",
        "msg_index", "msg_module", "msg_type", "event_index", "event_type", "event_attributes",
    )


def fact_transitions(transitions: DataFrame) -> DataFrame:
    return transitions.select(
        "block_id", "block_timestamp", "blockchain", "chain_id", "transition_type", "index", "event", "event_attributes"
    )


def dim_labels(labels: DataFrame, blockchain: str = "terra") -> DataFrame:
    return labels.where(F.col("blockchain") == blockchain).select(
        "blockchain", "address", "creator", F.col("l1_label").alias("label_type"),
        F.col("l2_label").alias("label_subtype"), F.col("project_name").alias("label"), "address_name",
    )


def dim_nft_metadata(nfts: DataFrame, blockchain: str = "terra") -> DataFrame:
    return nfts.where(F.col("blockchain") == blockchain).select(
        "blockchain", "contract_address", "contract_name", "created_at_timestamp", "created_at_tx_id",
        "creator_address", "creator_name", "image_url", "project_name", "token_id", "token_metadata",
        "token_metadata_uri", "token_name",
    )


def dim_tax_rate(rates: DataFrame) -> DataFrame:
    return rates.select(F.col("chain_id").alias("blockchain"), "block_timestamp", "block_number", "tax_rate")


def dim_pool_reserves(reserves: DataFrame) -> DataFrame:
    """Both pool tables publish amounts in tokens."""
    millionth = lambda name: (F.col(name).cast("double") / 1e6).alias(name)
    return reserves.select(
        F.lit("terra").alias("blockchain"), "chain_id", "block_id", "block_timestamp", "contract_address",
        millionth("total_share"), "token_0_currency", millionth("token_0_amount"), "token_1_currency",
        millionth("token_1_amount"),
    )


def dim_contract_metadata(metadata: DataFrame, dex: DataFrame) -> DataFrame:
    """Token contracts that are no pool contracts, and the pool contracts.

    The pool addresses are tested with null-aware rules: a null among them removes all token rows.
    """
    columns = ["block_timestamp", "tx_id", "contract_address", "decimals", "contract_name", "symbol", "is_wormhole"]
    pools = dex.select(
        "block_timestamp", "tx_id", "contract_address", F.col("decimals").cast("decimal(38,0)").alias("decimals"),
        "contract_name", "symbol", F.lit(False).alias("is_wormhole"),
    )
    return tombstoned(metadata.select(*columns), pools, "contract_address").unionByName(pools)


def dim_validator_labels(labels: DataFrame, blockchain: str = "terra") -> DataFrame:
    """One row per operator with the addresses of its three roles."""
    roles = ["operator_address", "delegator_address", "vp_address"]
    own = labels.where((F.col("blockchain") == blockchain) & (F.col("l1_label") == "operator"))
    out = own.groupBy(F.col("project_name").alias("label")).agg(
        *[F.max(F.when(F.col("address_name") == r, F.col("address"))).alias(r) for r in roles]
    )
    return out.where(F.coalesce(*roles).isNotNull())


def dim_validator_voting_power(power: DataFrame) -> DataFrame:
    rows = power.select(F.col("block_number").alias("block_id"), "block_timestamp", "blockchain", "address", "voting_power")
    return latest_by(rows, ["block_id", "address"], [F.desc("block_timestamp")])


def dim_daily_balances(
    daily: DataFrame, synthetic: DataFrame, prices: DataFrame, dim_label_rows: DataFrame, labels: DataFrame
) -> DataFrame:
    """Daily balances in USD. Native currencies are matched to a symbol; contract balances reuse the last price."""
    named = lookup(prices, dim_label_rows, {"address": F.col("symbol")}, {"address_name": "label_name"})
    by_day = named.groupBy("symbol", "label_name", F.to_date("block_timestamp").alias("day")).agg(
        F.avg("price_usd").alias("price")
    )
    currency = F.col("currency")
    symbol = (
        F.when(currency == "USD", "UST")
        .when(F.length(currency) == 3, F.upper(F.concat(F.substring(currency, 1, 2), F.lit("T"))))
        .when(F.substring(currency, 1, 1) == "U", F.upper(F.concat(F.substring(currency, 2, 2), F.lit("T"))))
        .otherwise(currency)
    )
    label = {
        "l1_label": "address_label_type", "l2_label": "address_label_subtype", "project_name": "address_label",
        "address_name": "address_name",
    }

    def shaped(df: DataFrame, price: Column) -> DataFrame:
        return labelled(df, labels, F.col("address"), label).select(
            "date", "address", *label.values(), "balance", (F.col("balance") * price).alias("balance_usd"),
            "balance_type", "is_native", "currency",
        )

    native = daily.where(~F.lower(currency).like("ibc%") & (currency != "UNOK"))
    native = lookup(native, by_day, {"symbol": symbol, "day": F.col("date")}, {"price": "price"})
    contract = lookup(synthetic, by_day, {"symbol": currency, "day": F.col("date")}, {"price": "price"})
    # All rows of a currency and day carry the same price, so the last known price is a fact about (currency, day).
    quotes = contract.groupBy("currency", "date").agg(F.max("price").alias("quote"))
    known = carry_forward(quotes, ["currency"], ["date"], F.trunc("date", "year"), F.col("quote"), "last_price")
    contract = contract.join(known.select("currency", "date", "last_price"), ["currency", "date"], "left")
    usd = F.coalesce("price", "last_price")
    return shaped(native, F.col("price")).unionByName(shaped(contract, usd)).distinct()


# ---------------------------------------------------------------- actions and transfers


def ez_event_actions(actions: DataFrame, labels: DataFrame) -> DataFrame:
    named = labelled(actions, labels, F.col("action_contract_address"), {"address_name": "contract_label"})
    return named.select(
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "action_index", "msg_index",
        "action_contract_address", "contract_label", "action_method", "action_log",
    )


def latest_symbols(prices: DataFrame) -> DataFrame:
    """The newest symbol of each currency."""
    return latest_by(
        prices.select("currency", "symbol", "block_timestamp"), ["currency"], [F.desc("block_timestamp"), F.asc("symbol")]
    ).select("currency", "symbol")


def ez_transfer_events(transfers: DataFrame, prices: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    df = priced(transfers, hourly, F.col("denom"), {"price": "price_usd"})
    df = lookup(df, latest_symbols(prices), {"currency": F.col("denom")}, {"symbol": "symbol"})
    df = labelled(df, labels, F.col("sender"), label_columns("sender"))
    df = labelled(df, labels, F.col("recipient"), label_columns("recipient", "recipient_label"))
    df = labelled(df, labels, F.col("contract_address"), {"address_name": "contract_label"})
    return df.select(
        "block_timestamp", "tx_id", "msg_index", F.col("action_index").cast("bigint").alias("action_index"),
        "initial_action", "current_action",
        "sender", *label_columns("sender").values(),
        "recipient", *label_columns("recipient", "recipient_label").values(),
        "amount", (F.col("amount") * F.col("price_usd")).alias("amount_usd"),
        F.coalesce("symbol", "denom").alias("currency"), "msg_sender", "contract_address", "contract_label",
    )


TRANSFER_COLUMNS = [
    "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type", "event_from", "event_to",
    "event_amount", "event_currency",
]


def _multi_sends(messages: DataFrame) -> DataFrame:
    """Input i of a multi-send is paired with output i of the same transaction."""
    multi = _ok(messages).where((F.col("msg_module") == "bank") & (F.col("msg_type") == "bank/MsgMultiSend"))
    base = ["blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type"]
    inputs = flatten_array(multi, vvar("msg_value", "inputs"), "part", "i").select(
        *base, "i", vstr("part", "address").alias("event_from"),
        (vdouble("part", "coins[0].amount") / 1e6).alias("event_amount"),
        vstr("part", "coins[0].denom").alias("event_currency"),
    )
    outputs = flatten_array(multi, vvar("msg_value", "outputs"), "part", "i").select(
        "tx_id", "i", vstr("part", "address").alias("event_to")
    )
    return inputs.join(outputs, ["tx_id", "i"]).select(*TRANSFER_COLUMNS)


def _native_arrivals(events: DataFrame) -> DataFrame:
    """Native coins released by the bridge: fields of one transfer event, pivoted by their leading index."""
    released = _ok(events).where(
        (F.col("event_type") == "from_contract")
        & (vstr("event_attributes", "action") == "complete_transfer_terra_native")
        & (vstr("event_attributes", "contract_address") == WORMHOLE)
    )
    moved = semi(_ok(events).where(F.col("event_type") == "transfer"), released, "tx_id")
    flat = flatten_object(moved, F.col("event_attributes"), "key", "value")
    base = ["blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type"]
    index = F.coalesce(F.regexp_substr("key", F.lit("^[0-9]+")), F.lit("0"))
    ends = lambda word: F.col("key").rlike(f"^(?:.*{word})$")
    return (
        flat.groupBy(*base, index.alias("index"))
        .agg(
            F.max(F.when(ends("sender"), vstr("value"))).alias("event_from"),
            F.max(F.when(ends("recipient"), vstr("value"))).alias("event_to"),
            F.max(F.when(ends("amount"), vstr("value", "[0].denom"))).alias("event_currency"),
            (F.max(F.when(ends("amount"), vdec("value", "[0].amount"))).cast("double") / 1e6).alias("event_amount"),
        )
        .select(*TRANSFER_COLUMNS)
    )


def ez_transfers(
    messages: DataFrame, events: DataFrame, prices: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    """Five transfer origins, without exact repeats, priced and labelled."""
    base = [c for c in TRANSFER_COLUMNS if not c.startswith("event_")]
    v = "msg_value"

    def shaped(df: DataFrame, sender: Column, receiver: Column, amount: Column, currency: Column) -> DataFrame:
        return df.select(
            *base, sender.alias("event_from"), receiver.alias("event_to"), (amount / 1e6).alias("event_amount"),
            currency.alias("event_currency"),
        )

    sends = shaped(
        _ok(messages).where((F.col("msg_module") == "bank") & (F.col("msg_type") == "bank/MsgSend")),
        vstr(v, "from_address"), vstr(v, "to_address"), vdouble(v, "amount[0].amount"), vstr(v, "amount[0].denom"),
    )
    tokens = shaped(
        _ok(messages).where(vvar(v, "execute_msg.transfer").isNotNull()),
        vstr(v, "sender"), vstr(v, "execute_msg.transfer.recipient"), vdouble(v, "execute_msg.transfer.amount"),
        vstr(v, "contract"),
    )
    a = "event_attributes"
    wrapped = shaped(
        _ok(events).where(
            (F.col("event_type") == "from_contract") & (vstr(a, "0_action") == "complete_transfer_wrapped")
            & (vstr(a, "0_contract_address") == WORMHOLE)
        ),
        vstr(a, "0_contract_address"), vstr(a, "recipient"), vdouble(a, "0_amount"), vstr(a, "contract"),
    )
    found = _multi_sends(messages)
    for part in (sends, tokens, _native_arrivals(events), wrapped):
        found = found.unionByName(part)
    df = priced(found.distinct(), hourly, F.col("event_currency"), {"price": "price_usd"})
    df = lookup(df, latest_symbols(prices), {"currency": F.col("event_currency")}, {"symbol": "symbol"})
    df = labelled(df, labels, F.col("event_from"), label_columns("event_from"))
    df = labelled(df, labels, F.col("event_to"), label_columns("event_to"))
    return df.select(
        *base, "event_from", *label_columns("event_from").values(), "event_to", *label_columns("event_to").values(),
        "event_amount", (F.col("event_amount") * F.col("price_usd")).alias("event_amount_usd"),
        F.coalesce("symbol", "event_currency").alias("event_currency"),
    )


# ---------------------------------------------------------------- staking and rewards

STAKING_KINDS = {
    "staking/MsgDelegate": ("delegate", "validator_address"),
    "staking/MsgUndelegate": ("undelegate", "validator_address"),
    "staking/MsgBeginRedelegate": ("redelegate", "validator_dst_address"),
}


def ez_staking(messages: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    """Three staking kinds in one pass; ``*_address_name`` holds the address, as published."""
    action, validator = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (name, field) in STAKING_KINDS.items():
        action = F.when(F.col("msg_type") == kind, name).otherwise(action)
        validator = F.when(F.col("msg_type") == kind, vstr("msg_value", field)).otherwise(validator)
    rows = _ok(messages).where((F.col("msg_module") == "staking") & F.col("msg_type").isin(list(STAKING_KINDS))).select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "msg_index", "tx_id",
        action.alias("action"),
        vstr("msg_value", "delegator_address").alias("delegator_address"),
        validator.alias("validator_address"),
        (vdouble("msg_value", "amount.amount") / 1e6).alias("event_amount"),
        vstr("msg_value", "amount.denom").alias("denom"),
    )
    df = priced(rows, hourly, F.col("denom"), {"price": "price_usd", "symbol": "currency"})
    df = labelled(df, labels, F.col("delegator_address"), label_columns("delegator", name_from="address"))
    df = labelled(df, labels, F.col("validator_address"), label_columns("validator", name_from="address"))
    return df.select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "msg_index", "tx_id", "action",
        "delegator_address", *label_columns("delegator").values(),
        "validator_address", *label_columns("validator").values(),
        "event_amount", "price_usd", (F.col("event_amount") * F.col("price_usd")).alias("event_amount_usd"), "currency",
    )


def ez_reward(rewards: DataFrame, commission: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    base = [
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_index",
        "event_attributes_amount_index", "action",
    ]
    who = [F.col("validator_address").alias("validator"), F.col("delegator_address").alias("delegator")]
    one = rewards.select(
        *base, F.col("event_rewards_amount").alias("event_amount"), F.col("event_rewards_currency").alias("denom"), *who
    )
    two = commission.select(*base, F.col("amount").alias("event_amount"), F.col("currency").alias("denom"), *who)
    df = priced(one.unionByName(two), hourly, F.col("denom"), {"price": "price_usd", "symbol": "currency"})
    df = labelled(df, labels, F.col("delegator"), label_columns("delegator"))
    df = labelled(df, labels, F.col("validator"), label_columns("validator"))
    return df.select(
        *base, "validator", *label_columns("validator").values(), "delegator", *label_columns("delegator").values(),
        "event_amount", "price_usd", (F.col("event_amount") * F.col("price_usd")).alias("event_amount_usd"), "currency",
    )


def ez_airdrop_claims(messages: DataFrame, labels: DataFrame) -> DataFrame:
    claims = _ok(messages).where(vvar("msg_value", "execute_msg.claim.amount").isNotNull())
    named = labelled(claims, labels, vstr("msg_value", "contract"), {"address_name": "contract_label"})
    return named.select(
        "blockchain", "chain_id", "block_id", "block_timestamp", "tx_id",
        vstr("msg_value", "execute_msg.claim.stage").alias("airdrop_id"),
        vstr("msg_value", "sender").alias("claimer"),
        (vdouble("msg_value", "execute_msg.claim.amount") / 1e6).alias("amount"),
        vstr("msg_value", "contract").alias("contract_address"),
        "contract_label",
    )


# ---------------------------------------------------------------- governance


def ez_gov_submit_proposal(messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    is_submit = (F.col("msg_module") == "gov") & (F.col("msg_type") == "gov/MsgSubmitProposal")
    ids = _ok(events).where(is_submit & (F.col("event_type") == "proposal_deposit")).select(
        "tx_id", vstr("event_attributes", "proposal_id").alias("proposal_id")
    )
    rows = _ok(messages).where(is_submit).select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type",
        _unquoted("proposer").alias("proposer"),
        F.coalesce(vstr("msg_value", "content.type"), vstr("msg_value", "content.@type")).alias("proposal_type"),
        F.coalesce(vstr("msg_value", "content.value.description"), vstr("msg_value", "content.description")).alias(
            "description"
        ),
        F.coalesce(vstr("msg_value", "content.value.title"), vstr("msg_value", "content.title")).alias("title"),
        (vdouble("msg_value", "initial_deposit[0].amount") / 1e6).alias("deposit_amount"),
        vstr("msg_value", "initial_deposit[0].denom").alias("deposit_currency"),
    )
    df = priced(rows, hourly, F.col("deposit_currency"), {"price": "price_usd"})
    df = labelled(df, labels, F.col("proposer"), label_columns("proposer", name_from="address"))
    return df.join(ids, "tx_id", "left").select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type", "proposer",
        *label_columns("proposer").values(), "proposal_id", "proposal_type", "description", "title", "deposit_amount",
        (F.col("deposit_amount") * F.col("price_usd")).alias("deposit_amount_usd"), "deposit_currency",
    )


def ez_gov_vote(
    messages: DataFrame, daily: DataFrame, power: DataFrame, validators: DataFrame, labels: DataFrame
) -> DataFrame:
    """Votes with the voter's weight that day: validator voting power, else the staked balance."""
    votes = _ok(messages).where((F.col("msg_module") == "gov") & (F.col("msg_type") == "gov/MsgVote")).select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type",
        vstr("msg_value", "voter").alias("voter"),
        _unquoted("proposal_id").alias("proposal_id"),
        _unquoted("option").alias("option"),
        F.to_date("block_timestamp").alias("_day"),
    )
    staked = daily.where(F.col("balance_type") == "staked").select(
        F.to_date("date").alias("_day"), F.col("address").alias("voter"), F.col("balance").alias("staked")
    )
    last_power = latest_by(
        power.select("block_timestamp", "address", "voting_power", F.to_date("block_timestamp").alias("_day")),
        ["_day", "address"], [F.desc("block_timestamp")],
    )
    delegates = lookup(
        last_power, validators, {"vp_address": F.col("address")}, {"delegator_address": "voter"}
    ).where(F.col("voter").isNotNull()).select("_day", "voter", "voting_power", F.lit(True).alias("is_validator"))
    df = labelled(votes, labels, F.col("voter"), label_columns("voter", name_from="address"))
    df = df.join(staked, ["_day", "voter"], "left").join(delegates, ["_day", "voter"], "left")
    weight = F.when(F.col("is_validator"), F.col("voting_power").cast("double")).otherwise(F.col("staked"))
    return df.select(
        "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type",
        F.replace("voter", F.lit('"'), F.lit("")).alias("voter"), *label_columns("voter").values(), "proposal_id",
        "option", weight.alias("voting_power"),
    )


# ---------------------------------------------------------------- native market swaps


def ez_swaps(messages: DataFrame, events: DataFrame, hourly: DataFrame) -> DataFrame:
    """Native swaps with both transfer legs and the fee, each priced at its hour."""
    swap = F.col("msg_type") == "market/MsgSwap"
    rows = _ok(messages).where((F.col("msg_module") == "market") & swap).select(
        "blockchain", "chain_id", "block_id", "block_timestamp", "tx_status", "tx_id", "msg_index",
        vstr("msg_value", "trader").alias("trader"),
        vstr("msg_value", "ask_denom").alias("ask_denom"),
        (vdouble("msg_value", "offer_coin.amount") / 1e6).alias("offer_amount"),
        vstr("msg_value", "offer_coin.denom").alias("offer_denom"),
    )
    a = "event_attributes"
    legs = events.where(swap & (F.col("event_type") == "transfer")).select(
        "tx_id", "msg_index",
        *[(vdouble(a, f"{i}_amount[0].amount") / 1e6).alias(f"token_{i}_amount") for i in (0, 1)],
        *[vstr(a, f"{i}_amount[0].denom").alias(f"denom_{i}") for i in (0, 1)],
    )
    fees = events.where(swap & (F.col("event_type") == "swap")).select(
        "tx_id", "msg_index", (vdouble(a, "swap_fee[0].amount") / 1e6).alias("swap_fee_amount"),
        vstr(a, "swap_fee[0].denom").alias("fee_denom"),
    )
    df = rows.join(legs, ["tx_id", "msg_index"], "left").join(fees, ["tx_id", "msg_index"], "left")
    for denom, price, symbol in [
        ("denom_0", "price0_usd", "token_0_currency"), ("denom_1", "price1_usd", "token_1_currency"),
        ("fee_denom", "fee_price", "swap_fee_currency"), ("offer_denom", "offer_price", "offer_currency"),
        ("ask_denom", "ask_price", "ask_currency"),
    ]:
        df = priced(df, hourly, F.col(denom), {"price": price, "symbol": symbol})
    usd = lambda amount, price, out: (F.col(amount) * F.col(price)).alias(out)
    return df.select(
        "blockchain", "chain_id", "block_id", "block_timestamp", "tx_status", "tx_id", "msg_index", "swap_fee_amount",
        usd("swap_fee_amount", "fee_price", "swap_fee_amount_usd"), "swap_fee_currency", "trader", "ask_currency",
        "offer_amount", usd("offer_amount", "offer_price", "offer_amount_usd"), "offer_currency",
        "token_0_amount", usd("token_0_amount", "price0_usd", "token_0_amount_usd"), "token_0_currency",
        "token_1_amount", usd("token_1_amount", "price1_usd", "token_1_amount_usd"), "token_1_currency",
        "price0_usd", "price1_usd",
        F.concat("token_0_currency", F.lit(" to "), "token_1_currency").alias("swap_pair"),
    )
