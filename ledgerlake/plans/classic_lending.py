"""Lending protocol tables of the predecessor chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import vdouble, vvar
from ledgerlake.operators.enrich import labelled, priced
from ledgerlake.operators.joins import semi
from ledgerlake.plans.classic_calls import (
    PLACE, act, act_has, act_tokens, attr, attr_has, attr_tokens, msg, msg_has, msg_tokens, ok, with_message,
)

# Protocol contracts and tokens.
MARKET = "terra1sepfj7s0aeg5967uxnfk4thzlerrsktkpelm5s"
BOND_HUB = "terra1mtwph2juhj0rvjz7dy92gvl6xvukaxu8rfv8ts"
DEPOSIT_TOKEN = "terra1hzh9vpxhsk8253se0vv5jj6etdvxu3nv8z07zu"
GOVERNANCE = "terra1f32xyep306hhcxxxf7mlyh0ucggc00rm2s9da5"
GOVERNANCE_TOKEN = "terra14z56l0fp2lsf86zy3hty2z47ezkhnthtr9yq76"
LP_REWARDS = "terra1897an2xux840p9lrh6py3ryankc6mspw49xse3"
EIGHT_DECIMAL_COLLATERAL = "terra1z3e2e4jpk4n0xzzwlkgcfvc95pc5ldq0xcny58"
COLLATERAL_CONTRACTS = [
    "terra1ptjp2vfjrwh0j0faj9r6katm640kgjxnwwq9kn",
    "terra10cxuzggyvvv44magvrh3thpdnk9cmlgk93gmx2",
    "terra1zdxlrtyu74gf6pvjkg9t22hentflmfcs86llva",
]
STABLE = "uusd"
STAKE_VOTING_TOKENS = "eyJzdGFrZV92b3RpbmdfdG9rZW5zIjp7fX0="

BRIDGED = "execute_msg.process_anchor_message"


def _usd(df: DataFrame, hourly: DataFrame, currency: Column, amount: str = "amount", out: str = "amount_usd"):
    quoted = priced(df, hourly, currency, {"price": "_price"})
    return quoted.withColumn(out, F.col(amount) * F.col("_price")).drop("_price")


def _named(df: DataFrame, labels: DataFrame, address: Column | None = None, out: str = "contract_label") -> DataFrame:
    return labelled(df, labels, F.col("contract_address") if address is None else address, {"address_name": out})


def _named_or_empty(df: DataFrame, labels: DataFrame) -> DataFrame:
    return _named(df, labels).withColumn("contract_label", F.coalesce("contract_label", F.lit("")))


def _source() -> Column:
    return F.when(msg_has(BRIDGED), "Wormhole").otherwise("Terra").alias("source")


def _token_amount(raw: Column, currency: Column) -> Column:
    return raw / F.when(currency == EIGHT_DECIMAL_COLLATERAL, F.lit(1e8)).otherwise(F.lit(1e6))


# ---------------------------------------------------------------- bonds, burns


def ez_anchor_bonds(messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    """Bond calls of transactions that also have a successful event; the event adds no column."""
    calls = ok(messages).where(msg_has("execute_msg.bond")).select(
        *PLACE, "msg_index",
        msg("sender").alias("sender"), msg_tokens("coins[0].amount").alias("bonded_amount"),
        msg("coins[0].denom").alias("bonded_currency"), msg("execute_msg.bond.validator").alias("validator"),
        msg("contract").alias("contract_address"),
    )
    df = _usd(calls, hourly, F.col("bonded_currency"), "bonded_amount", "bonded_amount_usd")
    df = semi(_named_or_empty(df, labels), ok(events), "tx_id")
    return df.select(
        *PLACE, "sender", "bonded_amount", "bonded_amount_usd", "bonded_currency", "msg_index", "validator",
        F.coalesce("contract_address", F.lit("")).alias("contract_address"), "contract_label",
    ).distinct()


def ez_anchor_burns(messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    """Burns: read from the message in one version of the chain, from the event in the next."""
    base = [
        *PLACE, msg("sender").alias("sender"), msg("contract").alias("currency"),
        msg("execute_msg.send.contract").alias("contract_address"),
    ]
    old = ok(messages).where(msg_has("execute_msg.send.msg.unbond") & (F.col("chain_id") == "columbus-4")).select(
        *base, msg_tokens("execute_msg.send.amount").alias("amount")
    )
    burnt = events.where((F.col("event_type") == "from_contract") & attr_has("burnt_amount")).select(
        "tx_id", attr_tokens("burnt_amount").alias("amount")
    )
    new = (
        ok(messages)
        .where((msg("execute_msg.send.contract") == BOND_HUB) & (F.col("chain_id") == "columbus-5"))
        .select(*base)
        .join(burnt, "tx_id")
    )
    df = _usd(old.unionByName(new), hourly, F.col("currency"))
    return _named_or_empty(df, labels).select(
        *PLACE, "sender", "amount", "amount_usd", "currency", "contract_address", "contract_label"
    )


# ---------------------------------------------------------------- deposits, redemptions


def ez_anchor_deposits(
    messages: DataFrame, events: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    columns = [
        *PLACE, "sender", "deposit_amount", "deposit_amount_usd", "deposit_currency", "mint_amount", "mint_amount_usd",
        "mint_currency", "contract_address", "contract_label", "source",
    ]
    calls = ok(messages).where(msg_has("execute_msg.deposit_stable") & (msg("contract") == MARKET)).select(
        *PLACE, msg("sender").alias("sender"), msg_tokens("coins[0].amount").alias("deposit_amount"),
        msg("coins[0].denom").alias("deposit_currency"), msg("contract").alias("contract_address"),
        F.lit("Terra").alias("source"),
    )
    minted = ok(events).where(
        (F.col("event_type") == "from_contract") & (attr("0_action") == "deposit_stable")
    ).select(
        "tx_id", "block_timestamp", attr_tokens("mint_amount").alias("mint_amount"),
        attr("1_contract_address").alias("mint_currency"),
    )
    minted = _usd(minted, hourly, F.col("mint_currency"), "mint_amount", "mint_amount_usd").drop("block_timestamp")
    direct = _usd(calls, hourly, F.col("deposit_currency"), "deposit_amount", "deposit_amount_usd")
    direct = _named(direct, labels).join(minted, "tx_id").select(*columns)

    deposits = with_message(actions.where(F.col("action_method") == "deposit_stable"), messages).select(
        *PLACE, "msg_index", act("depositor").alias("sender"), act_tokens("deposit_amount").alias("deposit_amount"),
        act_tokens("mint_amount").alias("mint_amount"),
        F.coalesce(msg("coins[0].denom"), F.lit(STABLE)).alias("deposit_currency"),
        F.col("action_contract_address").alias("contract_address"), _source(),
    )
    mints = actions.where(
        (F.col("action_method") == "mint") & (F.col("action_contract_address") == DEPOSIT_TOKEN)
    ).select("tx_id", "msg_index", act("to").alias("sender"), F.col("action_contract_address").alias("mint_currency"))
    through = deposits.join(mints, ["tx_id", "msg_index", "sender"])
    through = _usd(through, hourly, F.col("deposit_currency"), "deposit_amount", "deposit_amount_usd")
    through = _usd(through, hourly, F.col("mint_currency"), "mint_amount", "mint_amount_usd")
    return direct.unionByName(_named(through, labels).select(*columns)).distinct()


def ez_anchor_redeem(
    messages: DataFrame, events: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    """Redemptions seen by an event, through the bridge, or only as an action."""
    columns = [*PLACE, "sender", "amount", "amount_usd", "currency", "contract_address", "contract_label", "source"]
    token_calls = messages.where(msg("contract") == DEPOSIT_TOKEN)
    redeemed = semi(
        ok(events).where((F.col("event_type") == "from_contract") & attr_has("redeem_amount")), token_calls, "tx_id"
    )
    direct = redeemed.select(*PLACE, "msg_index", attr_tokens("redeem_amount").alias("amount")).join(
        messages.select("tx_id", "msg_index", "msg_value"), ["tx_id", "msg_index"]
    ).select(
        *PLACE, msg("sender").alias("sender"), "amount", msg("contract").alias("currency"),
        F.coalesce(msg("execute_msg.send.contract"), F.lit("")).alias("contract_address"),
        F.lit("Terra").alias("source"),
    )
    redeems = actions.where(F.col("action_method") == "redeem_stable")
    sends = actions.where((F.col("action_method") == "send") & (act("to") == MARKET)).select(
        "tx_id", act("from").alias("_from"), F.col("action_contract_address").alias("currency")
    )
    amount = act_tokens("redeem_amount").alias("amount")
    contract = F.col("action_contract_address").alias("contract_address")
    bridged = semi(redeems, messages.where(msg_has(BRIDGED)), "tx_id").select(*PLACE, amount, contract)
    bridged = bridged.join(sends, "tx_id").withColumnRenamed("_from", "sender").withColumn("source", F.lit("Wormhole"))
    others = (
        with_message(redeems, messages)
        .where(F.col("has_msg") & ~msg_has(BRIDGED))
        # The event's transaction id is part of its key and never null, so a plain anti join is exact.
        .join(redeemed.select("tx_id").where(F.col("tx_id").isNotNull()), "tx_id", "left_anti")
        .select(*PLACE, msg("sender").alias("_sender"), amount, contract)
        .join(sends, "tx_id")
        .withColumn("sender", F.coalesce("_sender", "_from"))
        .drop("_sender", "_from")
        .withColumn("source", F.lit("Terra"))
    )
    rows = direct.unionByName(bridged).unionByName(others)
    return _named_or_empty(_usd(rows, hourly, F.col("currency")), labels).select(*columns).distinct()


# ---------------------------------------------------------------- borrows, repayments, collateral


def ez_anchor_borrows(messages: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    seen = with_message(
        actions.where((F.col("action_method") == "borrow_stable") & (F.col("action_contract_address") == MARKET)), messages
    ).select(
        *PLACE, act("borrower").alias("sender"), act_tokens("borrow_amount").alias("amount"),
        F.col("action_contract_address").alias("contract_address"), _source(),
    )
    asked = ok(messages).where(msg_has("execute_msg.borrow_stable") & (msg("contract") == MARKET)).select(
        *PLACE, msg("sender").alias("sender"), msg_tokens("execute_msg.borrow_stable.borrow_amount").alias("amount"),
        msg("contract").alias("contract_address"), F.lit("Terra").alias("source"),
    )
    rows = seen.unionByName(asked).withColumn("currency", F.lit(STABLE))
    return _named(_usd(rows, hourly, F.col("currency")), labels).select(
        *PLACE, "sender", "amount", "amount_usd", "currency", "contract_address", "contract_label", "source"
    ).distinct()


def ez_anchor_repay(messages: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    paid = (F.col("action_method") == "repay_stable") & (act_has("repay_amount") | act_has("withdraw_amount_ust"))
    rows = with_message(actions.where(paid), messages).where(F.col("has_msg")).select(
        *PLACE, msg("sender").alias("sender"),
        F.coalesce(act("borrower"), F.col("action_contract_address")).alias("borrower"),
        F.coalesce(act_tokens("repay_amount"), act_tokens("withdraw_amount_ust")).alias("amount"),
        F.coalesce(msg("coins[0].denom"), F.lit(STABLE)).alias("currency"),
        F.col("action_contract_address").alias("contract_address"), _source(),
    )
    return _named(_usd(rows, hourly, F.col("currency")), labels).select(
        *PLACE, "sender", "borrower", "amount", "amount_usd", "currency", "contract_address", "contract_label", "source"
    )


def ez_anchor_collateral(
    messages: DataFrame, events: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    """Collateral provided and withdrawn, directly or through the bridge."""
    columns = [
        *PLACE, "event_type", "sender", "amount", "amount_usd", "currency", "contract_address", "contract_label", "source"
    ]
    first = "collaterals[0]"
    denom = attr(f"{first}.denom")
    target = F.coalesce(msg("execute_msg.send.contract"), msg("contract")).alias("contract_address")
    freed = ok(events).where((F.col("event_type") == "from_contract") & attr_has("collaterals")).select(
        "tx_id",
        _token_amount(vdouble("event_attributes", f"{first}.amount"), denom).alias("amount"),
        denom.alias("currency"),
    )
    withdrawn = ok(messages).where(msg_has("execute_msg.withdraw_collateral")).select(
        *PLACE, F.lit("withdraw").alias("event_type"), msg("sender").alias("sender"), target,
        F.lit("Terra").alias("source"),
    ).join(freed, "tx_id")
    locks = messages.where(msg_has("execute_msg.lock_collateral"))
    provided = semi(
        ok(messages).where(msg("execute_msg.send.contract").isin(COLLATERAL_CONTRACTS)), locks, "tx_id"
    ).select(
        *PLACE, F.lit("provide").alias("event_type"), msg("sender").alias("sender"), target,
        F.lit("Terra").alias("source"),
        _token_amount(vdouble("msg_value", "execute_msg.send.amount"), msg("contract")).alias("amount"),
        msg("contract").alias("currency"),
    )
    bridged = semi(actions, ok(messages).where(msg_has(BRIDGED)), "tx_id").where(
        ((F.col("action_method") == "lock_collateral") & act_has("amount"))
        | (F.col("action_method") == "withdraw_collateral")
    )
    seen = events.where(F.col("event_type") == "from_contract").select("tx_id", "msg_index", "event_attributes")
    bridged = bridged.join(seen, ["tx_id", "msg_index"]).select(
        *PLACE,
        F.when(F.col("action_method") == "lock_collateral", "provide").otherwise("withdraw").alias("event_type"),
        act("borrower").alias("sender"), F.col("action_contract_address").alias("contract_address"),
        F.lit("Wormhole").alias("source"), _token_amount(act_tokens("amount", 0), denom).alias("amount"),
        denom.alias("currency"),
    )
    rows = withdrawn.unionByName(provided).unionByName(bridged)
    return _named_or_empty(_usd(rows, hourly, F.col("currency")), labels).select(*columns).distinct()


def ez_anchor_liquidations(messages: DataFrame, actions: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    """Liquidations with the bid that took the same raw amount in the same message."""
    rows = actions.where(F.col("action_method") == "liquidate_collateral").select(
        *PLACE, "msg_index", act("borrower").alias("borrower"), act("liquidator").alias("liquidator"),
        act_tokens("amount").alias("liquidated_amount"), act("amount").try_cast("decimal(38,0)").alias("_raw"),
        F.col("action_contract_address").alias("contract_address"),
    )
    bids = actions.where(F.col("action_method") == "execute_bid").select(
        "tx_id", "msg_index", act("collateral_amount").try_cast("decimal(38,0)").alias("_raw"),
        act_tokens("bid_fee").alias("bid_fee"), act("collateral_token").alias("liquidated_currency"),
    )
    rates = ok(messages).where(msg_has("execute_msg.submit_bid.premium_rate")).select(
        "tx_id", msg("execute_msg.submit_bid.collateral_token").alias("liquidated_currency"),
        msg("execute_msg.submit_bid.premium_rate").alias("premium_rate"),
    )
    df = rows.join(bids, ["tx_id", "msg_index", "_raw"], "left").join(rates, ["tx_id", "liquidated_currency"], "left")
    df = _usd(df, hourly, F.col("liquidated_currency"), "liquidated_amount", "liquidated_amount_usd")
    return _named_or_empty(df, labels).select(
        *PLACE, "bid_fee", "premium_rate", "borrower", "liquidator", "liquidated_amount", "liquidated_amount_usd",
        "liquidated_currency", "contract_address", "contract_label",
    ).distinct()


# ---------------------------------------------------------------- governance and rewards


def ez_anchor_gov_staking(messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame) -> DataFrame:
    columns = [
        *PLACE, "msg_index", "event_type", "sender", "amount", "amount_usd", "currency", "shares", "contract_address",
        "contract_label",
    ]
    sent = "execute_msg.send"
    stakes = ok(messages).where(
        (msg_has(f"{sent}.msg.stake_voting_tokens") & (msg(f"{sent}.contract") == GOVERNANCE))
        | (msg(f"{sent}.msg") == STAKE_VOTING_TOKENS)
    ).select(
        *PLACE, F.lit("stake").alias("event_type"), msg("sender").alias("sender"),
        msg_tokens(f"{sent}.amount").alias("amount"), msg("contract").alias("currency"),
        msg(f"{sent}.contract").alias("contract_address"),
    )
    shares = events.where((F.col("event_type") == "from_contract") & attr_has("share")).select(
        "tx_id", "msg_index", attr("share").alias("shares")
    )
    unstakes = ok(messages).where(
        msg_has("execute_msg.withdraw_voting_tokens") & (msg("contract") == GOVERNANCE)
    ).select(
        *PLACE, F.lit(None).cast("bigint").alias("msg_index"), F.lit("unstake").alias("event_type"),
        msg("sender").alias("sender"), msg_tokens("execute_msg.withdraw_voting_tokens.amount").alias("amount"),
        F.lit(GOVERNANCE_TOKEN).alias("currency"), F.lit(None).cast("string").alias("shares"),
        msg("contract").alias("contract_address"),
    )
    rows = stakes.join(shares, "tx_id").unionByName(unstakes)
    return _named(_usd(rows, hourly, F.col("currency")), labels).select(*columns).distinct()


def ez_anchor_gov_submit_proposal(messages: DataFrame, events: DataFrame, labels: DataFrame) -> DataFrame:
    poll = "execute_msg.send.msg.create_poll"
    calls = ok(messages).where(msg_has(poll) & (msg("execute_msg.send.contract") == GOVERNANCE)).select(
        *PLACE, msg("sender").alias("creator"), msg_tokens("execute_msg.send.amount").alias("amount"),
        msg(f"{poll}.title").alias("title"), msg(f"{poll}.link").alias("link"),
        msg(f"{poll}.description").alias("description"), vvar("msg_value", f"{poll}.execute_msg.msg").alias("msg"),
        msg("execute_msg.send.contract").alias("contract_address"),
    )
    end = F.timestamp_seconds(attr("end_time").try_cast("bigint")).cast("timestamp_ntz").cast("string")
    opened = events.where(F.col("event_type") == "from_contract").select(
        "tx_id", F.coalesce(end, attr("end_height")).alias("end_time"), attr("poll_id").alias("poll_id")
    )
    return _named(calls.join(opened, "tx_id"), labels).select(
        *PLACE, "poll_id", "end_time", "creator", "amount", "title", "link", "description", "msg", "contract_address",
        "contract_label",
    )


def ez_anchor_gov_vote(messages: DataFrame, labels: DataFrame) -> DataFrame:
    votes = ok(messages).where((msg("contract") == GOVERNANCE) & msg_has("execute_msg.cast_vote")).select(
        *PLACE, msg("sender").alias("voter"), msg("execute_msg.cast_vote.poll_id").alias("poll_id"),
        msg("execute_msg.cast_vote.vote").alias("vote"), msg_tokens("execute_msg.cast_vote.amount").alias("balance"),
        msg("contract").alias("contract_address"),
    )
    return _named(votes, labels).select(
        *PLACE, "voter", "poll_id", "vote", "balance", "contract_address", "contract_label"
    )


def ez_anchor_reward_claims(
    messages: DataFrame, events: DataFrame, hourly: DataFrame, labels: DataFrame
) -> DataFrame:
    """Reward claims: borrower rewards (claim 1), pool rewards (claim 0), or both in one transaction."""
    claims = ok(messages).where(msg_has("execute_msg.claim_rewards") & (msg("contract") == MARKET))
    withdraws = ok(messages).where(msg_has("execute_msg.withdraw") & (msg("contract") == LP_REWARDS))
    key = ["tx_id", "msg_index"]
    from_contract = ok(events).where(F.col("event_type") == "from_contract")
    claimed = from_contract.where(attr("0_action") == "claim_rewards").select(
        *PLACE, "msg_index", attr_tokens("claim_amount").alias("claim_1_amount"),
        attr("2_contract_address").alias("claim_1_currency"),
    )
    withdrawn = from_contract.where(attr("0_action") == "withdraw").select(
        *key, attr_tokens("0_amount").alias("claim_0_amount"), attr("1_contract_address").alias("claim_0_currency")
    )
    sender = msg("sender").alias("sender")
    both_ids = claims.where(F.col("msg_index") == 1).select("tx_id").distinct()

    def by_claim(calls: DataFrame) -> DataFrame:
        named = calls.select(*key, sender, msg("contract").alias("claim_1_contract"))
        return claimed.join(named, key)

    first = withdraws.where(F.col("msg_index") == 0).select(*key, msg("contract").alias("claim_0_contract"))
    pool_side = withdrawn.join(first, key).drop("msg_index")
    multi = by_claim(claims.where(F.col("msg_index") == 1)).join(pool_side, "tx_id")
    # Transaction ids are never null in these tables, so an anti join equals NOT IN.
    single = by_claim(claims.join(both_ids, "tx_id", "left_anti")).withColumns(
        {
            "claim_0_amount": F.lit(0.0), "claim_0_currency": F.lit(GOVERNANCE_TOKEN),
            "claim_0_contract": F.lit(LP_REWARDS),
        }
    )
    alone = withdraws.join(both_ids, "tx_id", "left_anti").select(
        *PLACE, "msg_index", sender, msg("contract").alias("claim_0_contract")
    )
    pool_only = alone.join(withdrawn, key).withColumns(
        {
            "claim_1_amount": F.lit(0.0), "claim_1_currency": F.lit(GOVERNANCE_TOKEN), "claim_1_contract": F.lit(MARKET),
        }
    )
    base = [
        *PLACE, "sender", "claim_0_amount", "claim_0_currency", "claim_0_contract", "claim_1_amount",
        "claim_1_currency", "claim_1_contract",
    ]
    df = multi.select(*base).unionByName(single.select(*base)).unionByName(pool_only.select(*base)).distinct()
    for i in (0, 1):
        df = _named(df, labels, F.col(f"claim_{i}_contract"), f"claim_{i}_contract_label")
        df = _usd(df, hourly, F.col(f"claim_{i}_currency"), f"claim_{i}_amount", f"claim_{i}_amount_usd")
    return df.select(
        *PLACE, "sender",
        *[f"claim_{i}_{c}" for i in (0, 1) for c in ("amount", "amount_usd", "currency", "contract", "contract_label")],
    )
