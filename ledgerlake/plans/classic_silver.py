"""Deduplicated tables of the predecessor chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions import joined_key, varray, vdec, vdouble, vlong, vmap, vstr, vvar
from ledgerlake.incremental.intervals import IntervalTable
from ledgerlake.operators.dedupe import keep_max_ties, latest_by, tombstoned
from ledgerlake.operators.flatten import flatten_array, flatten_object, prefix_regroup
from ledgerlake.operators.joins import semi, sorted_side
from ledgerlake.operators.ordered import dense_ranks, id_chunk
from ledgerlake.operators.pivot import object_delete
from ledgerlake.plans.classic_bronze import tax_rate_rows
from ledgerlake.run import Run

# Contracts and statuses the tables select by.
WORMHOLE = "terra10nmmwe8r3g99a9newtqa7a75xfgs2e8z87r2sf"
MIRROR_FACTORY = "terra1mzj9nsxx0lxlaxnekleqdy8xnyw2qrh3uz6h8p"
SUCCEEDED = "SUCCEEDED"
DECODED_ELSEWHERE = [
    "terra1kc87mu460fwkqte29rquh4hc20m54fxwtsx7gp",
    "terra17wgmccdu57lx09yzhnnev39srqj7msg9ky2j76",
    "terra1dzhzukyezv0etz22ud940z7adyv7xgcjkahuun",
    "terra1xj49zyqrwpv5k928jwfpfy2ha668nwdgkwlrg3",
    "terra12yvwzt5ayh396hgmyd0rwnamgg4g3mxrdgg7c6",
    "terra12897djskt9rge8dtmm86w654g7kzckkd698608",
]
WHOLE_UNIT_CURRENCIES = ["LUNA", "UST", "KRT", "MNT", "SDT", "krw", "mnt", "sdr"]


def _latest(df: DataFrame, *keys: str) -> DataFrame:
    return latest_by(df, keys, [F.desc("system_created_at")])


# ---------------------------------------------------------------- blocks, transactions, messages, events


def blocks(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "chain_id", "block_id")


def transactions(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "chain_id", "block_id", "tx_id")


def transitions(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "chain_id", "block_id", "index", "transition_type", "event")


def msgs(bronze: DataFrame) -> DataFrame:
    """Rows of a transaction's last block only (re-orgs), then the latest copy of each message."""
    return _latest(keep_max_ties(bronze, ["tx_id"], "block_id"), "chain_id", "block_id", "tx_id", "msg_index")


def msg_events(bronze: DataFrame) -> DataFrame:
    kept = keep_max_ties(bronze, ["tx_id"], "block_id")
    return _latest(kept, "chain_id", "block_id", "tx_id", "msg_index", "event_index", "event_type")


def event_actions(bronze: DataFrame) -> DataFrame:
    """One row per contract action; the log of an action loses its own name."""
    kept = keep_max_ties(bronze, ["tx_id"], "block_id")
    flat = flatten_object(kept, F.col("event_attributes_actions"), "key", "action")
    log = vmap("action", "action_log")
    rows = flat.select(
        "system_created_at", "_inserted_timestamp", "blockchain", "block_id", "block_timestamp", "chain_id", "tx_id",
        F.split_part("key", F.lit("_"), F.lit(1)).try_cast("bigint").alias("action_index"),
        "msg_index",
        vstr("action", "contract_address").alias("action_contract_address"),
        F.coalesce(vstr("action", "action_log.action"), vstr("action", "action_log.method")).alias("action_method"),
        object_delete(log, "action", "method").alias("action_log"),
    )
    latest = _latest(
        rows, "chain_id", "block_id", "tx_id", "msg_index", "action_index", "action_contract_address", "action_method"
    )
    return latest.drop("system_created_at")


# ---------------------------------------------------------------- transfer events

EVENT_COLUMNS = [
    "block_timestamp", "tx_id", "tx_status", "msg_index", "msg_type", "event_type", "event_attributes",
]


def transfer_events(events: DataFrame, messages: DataFrame) -> DataFrame:
    """Four kinds of transfers, with the sender and the action of their message.

    Fields such as ``3_sender`` are regrouped by their index inside the event row, so the only shuffles left are the
    distinct of the transfers and the joins on the transaction id.
    """
    grouped = events.select(*EVENT_COLUMNS, prefix_regroup(vmap("event_attributes")).alias("parts"))
    exploded = grouped.withColumn("part", F.explode("parts"))
    f = lambda name, kind=vstr, path="": kind(F.try_element_at(F.col("part.fields"), F.lit(name)), path)
    succeeded = F.col("tx_status") == SUCCEEDED

    def rows(df: DataFrame, index: Column, sender: Column, recipient: Column, denom: Column, amount: Column):
        return df.select(
            "block_timestamp", "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "event_type",
            index.alias("array_index"), sender.alias("sender"), recipient.alias("recipient"),
            denom.alias("denom"), (amount / 1e6).alias("amount"),
        )

    index = F.col("part.array_index")
    is_transfer = F.col("event_type") == "transfer"
    is_reward = F.col("msg_type") == "distribution/MsgWithdrawDelegatorReward"
    plain = rows(
        exploded.where(
            is_transfer & succeeded & ~is_reward & F.try_variant_get(
                F.try_element_at(F.col("part.fields"), F.lit("amount")), "$[0].amount", "variant"
            ).isNotNull()
        ),
        index, f("sender"), f("recipient"), f("amount", vstr, "[0].denom"), f("amount", vdouble, "[0].amount"),
    )
    first = grouped.where(is_transfer & is_reward & succeeded).withColumn("part", F.try_element_at("parts", F.lit(1)))
    coins = first.withColumn("coin", F.explode(varray(F.try_element_at(F.col("part.fields"), F.lit("amount")))))
    rewards = rows(coins, index, f("sender"), f("recipient"), vstr("coin", "denom"), vdouble("coin", "amount"))
    contract = exploded.where((F.col("event_type") == "from_contract") & succeeded)
    wrapped = rows(
        contract.where(
            (f("action") == "complete_transfer_wrapped") & (vstr("event_attributes", "0_contract_address") == WORMHOLE)
        ),
        index, f("sender"), f("recipient"), f("contract"), f("amount", vdouble),
    )
    tokens = rows(
        contract.where(
            (index == "0") & f("action").isin("send", "transfer")
            & F.try_element_at(F.col("part.fields"), F.lit("amount")).isNotNull()
        ),
        index, f("from"), f("to"), f("contract_address"), f("amount", vdouble),
    )
    found = plain.unionByName(rewards).unionByName(wrapped).unionByName(tokens).distinct()

    named = exploded.where(F.col("event_type") == "message").select(
        "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), index.alias("array_index"),
        f("sender").alias("msg_sender"), f("contract").alias("msg_contract"),
    )
    callers = semi(named, found, "tx_id").distinct()
    executes = semi(messages.where(F.col("tx_status") == SUCCEEDED), found, "tx_id").select(
        "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"),
        vstr("msg_value", "contract").alias("call_contract"),
        F.explode(F.map_keys(vmap("msg_value", "execute_msg"))).alias("label"),
    )
    first_call = sorted_side(executes.where(F.col("msg_index") == 0).select("tx_id", F.col("label").alias("initial_action")))
    this_call = sorted_side(executes.select("tx_id", "msg_index", F.col("label").alias("current_action"), "call_contract"))
    joined = (
        found.join(callers, ["tx_id", "msg_index", "array_index"], "left")
        .join(first_call, "tx_id", "left")
        .join(this_call, ["tx_id", "msg_index"], "left")
    )
    return joined.select(
        "block_timestamp", "tx_id", "msg_index", F.col("array_index").alias("action_index"), "initial_action",
        "current_action", F.coalesce("sender", "msg_sender").alias("sender"), "recipient", "denom", "amount",
        "msg_sender", F.coalesce("msg_contract", "call_contract").alias("contract_address"),
    )


# ---------------------------------------------------------------- balances

BALANCE_KEY = ["address", "currency", "balance_type"]


def balance_rows(bronze: DataFrame, history: DataFrame) -> DataFrame:
    """Logged balances and the stored history, whose chain version follows from height and time."""
    era = (
        F.when(
            (F.col("block_number") <= 3820000)
            & (F.col("block_timestamp") < F.lit("2020-10-03 15:56:10").cast("timestamp_ntz")),
            "columbus-3",
        )
        .when(F.col("blockchain") == "terra-5", "columbus-5")
        .otherwise("columbus-4")
    )
    old = F.lit("2000-01-01").cast("timestamp_ntz")
    columns = [
        "address", "balance", "balance_type", "block_number", "block_timestamp", "blockchain", "currency",
        "system_created_at", "_inserted_timestamp",
    ]
    stored = history.where(F.col("balance") != 0).withColumns(
        {"blockchain": era, "system_created_at": old, "_inserted_timestamp": old}
    )
    both = bronze.select(*columns).unionByName(stored.select(*columns))
    return latest_by(
        both, ["address", "balance_type", "blockchain", "block_number", "currency"], [F.desc("_inserted_timestamp")]
    )


def balance_chain(rows: DataFrame, width: int = 100_000) -> DataFrame:
    """Each balance after its predecessor in (address, currency, type), by dense rank of the block number.

    Joining rank n with rank n + 1 gives every row once per row of the rank before it. So a row is repeated by the
    number of rows of the previous rank, and the join reduces to that count: one small row per rank travels instead
    of a second copy of the table. The row that would close a balance with 0 is always removed by the last rule of
    the table, so no such row is made.
    """
    kept = rows.where(F.col("currency").isNotNull())
    ranked = dense_ranks(kept, BALANCE_KEY, "block_number", id_chunk(F.col("block_number"), width), "rn")
    sizes = ranked.groupBy(*BALANCE_KEY, "rn").agg(F.count(F.lit(1)).alias("copies"))
    before = sizes.select(*BALANCE_KEY, (F.col("rn") + 1).alias("rn"), "copies")
    joined = ranked.join(before, [*BALANCE_KEY, "rn"], "left")
    times = F.coalesce(F.col("copies"), F.lit(1)).cast("int")
    repeated = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return repeated.drop("_copy", "copies", "rn")


def balances(bronze: DataFrame, history: DataFrame) -> DataFrame:
    return balance_chain(balance_rows(bronze, history)).select(
        "address", "balance", "balance_type", "currency", "blockchain", "block_number", "block_timestamp",
        "_inserted_timestamp", "system_created_at",
    )


def daily_locf(rows: DataFrame, keys: list[str], run: Run, value: str = "balance") -> DataFrame:
    """One row per entity and day from its first day up to today, with the last value known on that day.

    Only days with a change are shuffled: each holds until the day before the next change, and the days in between
    are generated last. An entity has at most one row per day at that point, so its window is bounded by the length
    of the calendar.
    """
    dated = rows.withColumn("date", F.to_date("block_timestamp")).where(F.col("date") <= run.today)
    changes = latest_by(dated, [*keys, "date"], [F.desc("block_timestamp")]).select(*keys, "date", value)
    entity = Window.partitionBy(*keys).orderBy("date")
    known = changes.withColumn("_n", F.row_number().over(entity)).where(F.col(value).isNotNull() | (F.col("_n") == 1))
    until = F.coalesce(F.date_sub(F.lead("date").over(entity), 1), run.today)
    held = known.withColumn("_until", until)
    return held.withColumn("date", F.explode(F.sequence("date", "_until"))).drop("_n", "_until")


def balance_changes(silver_balances: DataFrame) -> DataFrame:
    """Balances by the time of their change; most currencies are stored in millionths."""
    rows = silver_balances.where(F.col("address").isNotNull()).select(
        *BALANCE_KEY, F.lit("terra").alias("blockchain"), "block_timestamp", "balance"
    )
    unit = F.when(F.col("currency").isin(WHOLE_UNIT_CURRENCIES), F.col("balance")).otherwise(F.col("balance") / 1e6)
    return rows.withColumn("balance", unit)


def balance_intervals(spark: SparkSession, path: str, unit: str = "month") -> IntervalTable:
    """The stored intervals that ``balance_changes`` of one batch after the other enter; ``daily`` publishes their days."""
    return IntervalTable(spark, path, [*BALANCE_KEY, "blockchain"], "balance", unit)


def daily_balances(silver_balances: DataFrame, run: Run) -> DataFrame:
    """Balances per address, currency, type and day."""
    filled = daily_locf(balance_changes(silver_balances), [*BALANCE_KEY, "blockchain"], run)
    return filled.select(
        "date", "address", "currency", "balance_type", "blockchain", F.lit(True).alias("is_native"), "balance"
    )


def block_synthetic_balances(bronze: DataFrame, run: Run) -> DataFrame:
    """The same for balances read from contracts; the wallet is part of the call's input text."""
    flat = flatten_array(
        bronze.select("inputs", "block_timestamp", vvar("value_obj", "balances").alias("coins")), F.col("coins"), "b", "i"
    )
    rows = flat.select(
        F.substring("inputs", 25, 44).alias("address"),
        vstr("b", "denom").alias("currency"),
        F.lit("liquid").alias("balance_type"),
        F.lit("terra").alias("blockchain"),
        "block_timestamp",
        vdouble("b", "amount").alias("balance"),
    )
    filled = daily_locf(rows.where(F.col("address").isNotNull()), [*BALANCE_KEY, "blockchain"], run)
    return filled.select(
        "date", "address", "currency", "balance_type", "blockchain", F.lit(False).alias("is_native"), "balance"
    )


# ---------------------------------------------------------------- labels

CASE_SENSITIVE_CHAINS = ["algorand", "solana"]


def address_labels(log: DataFrame, blockchain: str = "terra") -> DataFrame:
    """Latest label per chain, address and curator, without addresses that any chain ever flagged for deletion.

    The record key reads ``"labels-<chain>-<epoch seconds>"``, quotes included.
    """
    bare = F.substring(vstr("record_metadata", "key"), F.lit(2), F.length(vstr("record_metadata", "key")) - 2)
    keyed = log.withColumn("parts", F.split(bare, "-")).where(
        (F.size("parts") == 3) & (F.col("parts")[0] == "labels")
    )
    rows = flatten_array(
        keyed.select(
            F.timestamp_millis(vlong("record_metadata", "CreateTime")).cast("timestamp_ntz").alias("system_created_at"),
            F.timestamp_seconds(F.col("parts")[2].cast("bigint")).cast("timestamp_ntz").alias("insert_date"),
            F.col("parts")[1].alias("blockchain"),
            "record_content",
        ),
        F.col("record_content"), "t", "i",
    ).select(
        "system_created_at", "insert_date", "blockchain",
        F.when(F.col("blockchain").isin(CASE_SENSITIVE_CHAINS), vstr("t", "address"))
        .otherwise(F.lower(vstr("t", "address")))
        .alias("address"),
        vstr("t", "creator").alias("creator"),
        vstr("t", "l1_label").alias("l1_label"),
        vstr("t", "l2_label").alias("l2_label"),
        vstr("t", "address_name").alias("address_name"),
        vstr("t", "project_name").alias("project_name"),
        vstr("t", "delete").alias("delete_flag"),
    )
    latest = latest_by(rows, ["blockchain", "address", "creator"], [F.desc("insert_date")])
    published = latest.where(
        F.col("project_name").isNotNull()
        & F.col("address_name").isNotNull()
        & (F.col("l1_label") != "project")
        & (F.col("blockchain") == blockchain)
    )
    return tombstoned(published, rows.where(F.col("delete_flag") == "true"), "address")


# ---------------------------------------------------------------- contracts


def contract_info(api: DataFrame, run: Run) -> DataFrame:
    """Contract details from the bulk endpoint; the first answer per contract stays."""
    bulk = api.where(vstr("data", "request_meta.path") == "/bulk_get_contract_info")
    flat = flatten_array(bulk.withColumn("_at", F.col("_inserted_timestamp")), vvar("data", "response_data"), "c", "i")
    rows = flat.select(
        joined_key(
            "-", vstr("data", "name"), vstr("data", "request_meta.path"), vstr("c", "contract_info.address")
        ).alias("_uk"),
        vstr("data", "name").alias("source"),
        vstr("data", "request_meta.path").alias("route"),
        vstr("c", "contract_info.address").alias("address"),
        vstr("c", "contract_info.admin").alias("admin"),
        vlong("c", "contract_info.code_id").alias("code_id"),
        vstr("c", "contract_info.creator").alias("creator"),
        vvar("c", "contract_info.init_msg").alias("init_msg"),
        "_at",
    )
    first = latest_by(rows, ["_uk"], [F.asc("_at")]).drop("_at")
    return first.withColumn("_inserted_timestamp", run.clock)


def _wormhole_events(events: DataFrame) -> DataFrame:
    return events.where(
        (vstr("event_attributes", "creator") == WORMHOLE)
        & (F.col("block_timestamp") > F.lit("2021-06-01").cast("timestamp_ntz"))
    )


def token_contracts(events: DataFrame, run: Run) -> DataFrame:
    return _wormhole_events(events).select(
        vstr("event_attributes", "contract_address").alias("token_contract"),
        F.lit("WORMHOLE").alias("description"),
        run.clock.alias("_inserted_timestamp"),
    )


def contract_metadata(events: DataFrame, messages: DataFrame, info: DataFrame) -> DataFrame:
    """Token name, symbol and decimals from instantiation messages and from the contract endpoint."""
    created = events.where(F.col("event_type") == "instantiate_contract")
    single = created.where(vvar("event_attributes", "contract_address").isNotNull()).select(
        "tx_id", "msg_index", vstr("event_attributes", "contract_address").alias("contract_address")
    )
    several = flatten_object(created, F.col("event_attributes"), "key", "value").where(
        F.col("key").like("%_contract_address")
    ).select("tx_id", "msg_index", vstr("value").alias("contract_address"))
    contracts = single.unionByName(several).distinct()
    sets_up = vvar("msg_value", "execute_msg.execute.proposal_id").isNotNull() | vvar("msg_value", "init_msg").isNotNull()
    from_msgs = (
        messages.where(
            F.col("msg_type").isin("wasm/MsgInstantiateContract", "wasm/MsgExecuteContract") & sets_up
        )
        .join(contracts, ["tx_id", "msg_index"])
        .select(
            "block_timestamp", "tx_id", "contract_address",
            vdec("msg_value", "init_msg.decimals").alias("decimals"),
            vstr("msg_value", "init_msg.name").alias("contract_name"),
            vstr("msg_value", "init_msg.symbol").alias("symbol"),
        )
    )
    wormhole = _wormhole_events(events).select(
        "block_timestamp", "tx_id", vstr("event_attributes", "contract_address").alias("contract_address"),
        F.lit(True).alias("is_wormhole"),
    )
    decoded = (
        info.where(~F.col("address").isin(DECODED_ELSEWHERE))
        .select(
            F.col("address").alias("contract_address"),
            vdec("init_msg", "decimals").alias("decimals"),
            vstr("init_msg", "name").alias("contract_name"),
            vstr("init_msg", "symbol").alias("symbol"),
        )
        .join(wormhole, "contract_address", "left")
    )
    whitelists = messages.where(
        (vstr("msg_value", "contract") == MIRROR_FACTORY) & vvar("msg_value", "execute_msg.whitelist").isNotNull()
    ).select("tx_id", "msg_index", "block_timestamp")
    listed = whitelists.join(
        events.where(F.col("event_type") == "from_contract").select(
            "tx_id", "msg_index", vstr("event_attributes", "0_asset_token").alias("contract_address")
        ),
        ["tx_id", "msg_index"],
    ).select("block_timestamp", "tx_id", "contract_address")
    relisted = events.where(
        (vstr("event_attributes", "1_action") == "whitelist")
        & (vstr("event_attributes", "1_contract_address") == MIRROR_FACTORY)
    ).select("block_timestamp", "tx_id", vstr("event_attributes", "1_asset_token").alias("contract_address"))
    assets = listed.unionByName(relisted).select(
        "contract_address", F.col("block_timestamp").alias("asset_time"), F.col("tx_id").alias("asset_tx")
    )
    known = decoded.select(
        "contract_address", F.col("decimals").alias("d"), F.col("contract_name").alias("n"), F.col("symbol").alias("s")
    )
    named = from_msgs.join(known, "contract_address", "left").select(
        "block_timestamp", "tx_id", "contract_address",
        F.coalesce("decimals", "d").alias("decimals"),
        F.coalesce("contract_name", "n").alias("contract_name"),
        F.coalesce("symbol", "s").alias("symbol"),
        F.lit(False).alias("is_wormhole"),
    )
    rest = decoded.join(assets, "contract_address", "left").select(
        F.coalesce("block_timestamp", "asset_time").alias("block_timestamp"),
        F.coalesce("tx_id", "asset_tx").alias("tx_id"),
        "contract_address", "decimals", "contract_name", "symbol",
        F.coalesce("is_wormhole", F.lit(False)).alias("is_wormhole"),
    )
    return named.unionByName(rest).where(F.col("tx_id").isNotNull()).distinct()


def dex_contracts(events: DataFrame, labels: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pool and liquidity-token contracts of every pair creation, named after the pair."""
    a = lambda path: vstr("event_attributes", path)
    created = events.where(
        (F.col("event_type") == "wasm") & ((a("action") == "create_pair") | (a("0_action") == "create_pair"))
    ).select(
        "tx_id", "block_timestamp",
        a("0_contract_address").alias("address"),
        a("pair_contract_addr").alias("pool_address"),
        F.coalesce(a("liquidity_token_addr"), a("0_liquidity_token_addr")).alias("lp_token"),
        F.split_part(a("pair"), F.lit("-"), F.lit(1)).alias("token1"),
        F.split_part(a("pair"), F.lit("-"), F.lit(2)).alias("token2"),
    )
    pairs = created.join(labels.select("address", F.col("project_name").alias("dex_name")), "address")
    symbols = metadata.select("contract_address", "symbol")
    pairs = pairs.join(symbols.toDF("token1", "symbol1"), "token1", "left").join(
        symbols.toDF("token2", "symbol2"), "token2", "left"
    )
    # A token address starts with the chain's prefix; anything else is a native denom.
    symbol = F.when(
        F.substring("token1", 1, 5) == "terra", F.concat("symbol1", F.lit("/"), "token2")
    ).otherwise(F.concat("token1", F.lit("/"), "symbol2"))

    def side(address: str, decimals: Column, suffix: str) -> DataFrame:
        return pairs.select(
            "tx_id", "block_timestamp", F.col(address).alias("contract_address"), decimals.alias("decimals"),
            F.concat("dex_name", F.lit(suffix)).alias("contract_name"), symbol.alias("symbol"),
        )

    pools = side("pool_address", F.lit(None).cast("int"), " LP pool")
    tokens = side("lp_token", F.lit(6), " LP token").where(F.col("contract_address").isNotNull())
    return pools.unionByName(tokens).distinct()


def nft_metadata(bronze: DataFrame) -> DataFrame:
    complete = bronze.where(
        F.col("contract_name").isNotNull() & F.col("token_name").isNotNull()
        & F.col("image_url").isNotNull() & F.col("token_metadata").isNotNull()
    )
    return _latest(complete, "blockchain", "contract_address", "token_id")


# ---------------------------------------------------------------- small tables


def tax_rate(log: DataFrame, since=None) -> DataFrame:
    """Latest rate per chain and block. The dedupe sees all rows; the load filter comes after it."""
    latest = _latest(tax_rate_rows(log), "chain_id", "block_number")
    return latest if since is None else latest.where(F.col("_inserted_timestamp") >= F.lit(since))


def pool_reserves(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "block_id", "contract_address")


REWARD_COLUMNS = [
    "blockchain", "chain_id", "tx_status", "block_id", "block_timestamp", "tx_id", "msg_type", "msg_index",
    "event_attributes_amount_index",
]


def _paid_out(events: DataFrame, msg_type: str, event_type: str) -> DataFrame:
    """One row per coin of the chosen payout events."""
    chosen = events.where(
        (F.col("msg_module") == "distribution") & (F.col("msg_type") == msg_type)
        & (F.col("event_type") == event_type) & (F.col("tx_status") == SUCCEEDED)
    )
    return flatten_array(chosen, vvar("event_attributes", "amount"), "coin", "event_attributes_amount_index")


def _reward_msgs(messages: DataFrame, msg_type: str) -> DataFrame:
    return messages.where(
        (F.col("msg_module") == "distribution") & (F.col("msg_type") == msg_type) & (F.col("tx_status") == SUCCEEDED)
    )


def withdraw_delegator_rewards(events: DataFrame, messages: DataFrame) -> DataFrame:
    kind = "distribution/MsgWithdrawDelegationReward"
    paid = _paid_out(events, kind, "withdraw_rewards").select(
        *REWARD_COLUMNS,
        (vdouble("coin", "amount") / 1e6).alias("event_rewards_amount"),
        vstr("coin", "denom").alias("event_rewards_currency"),
        vstr("event_attributes", "validator").alias("validator_address"),
    ).distinct()
    asked = _reward_msgs(messages, kind).select(
        "tx_id", vstr("msg_value", "validator_address").alias("validator_address"),
        vstr("msg_value", "delegator_address").alias("delegator_address"),
    ).distinct()
    return paid.join(asked, ["tx_id", "validator_address"], "left").select(
        *REWARD_COLUMNS, "event_rewards_amount", "event_rewards_currency",
        F.lit("withdraw_delegator_rewards").alias("action"), "validator_address", "delegator_address",
    ).distinct()


def withdraw_validator_commission(events: DataFrame, messages: DataFrame) -> DataFrame:
    kind = "distribution/MsgWithdrawValidatorCommission"
    paid = _paid_out(events, kind, "coin_received").select(
        *REWARD_COLUMNS,
        (vdouble("coin", "amount") / 1e6).alias("amount"),
        vstr("coin", "denom").alias("currency"),
        vstr("event_attributes", "receiver").alias("delegator_address"),
    ).distinct()
    asked = _reward_msgs(messages, kind).select(
        "tx_id", vstr("msg_value", "validator_address").alias("validator_address")
    ).distinct()
    return paid.join(asked, "tx_id", "left").select(
        *REWARD_COLUMNS, "amount", "currency",
        F.lit("withdraw_validator_commission").alias("action"), F.lit("distribution").alias("module"),
        "validator_address", "delegator_address",
    ).distinct()
