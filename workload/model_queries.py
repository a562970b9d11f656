"""Declared models brought up to date in batches, against full builds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.incremental.distinct import HourlyDistinct
from ledgerlake.incremental.models import Model, ModelSet
from ledgerlake.plans import catalogue, chain_bronze, chain_silver, chain_stats, classic_bronze, classic_silver, observability
from ledgerlake.run import Run
from ledgerlake.session import new_folder, settle
from workload import ORACLES, chainlike, classiclike, query, table
from workload.chain_queries import O, _metas
from workload.chainlike import Chain
from workload.classic_queries import DAILY, C
from workload.classiclike import Classic

AUDIT = ["inserted_timestamp", "modified_timestamp", "_invocation_id"]
# Three batches; both cuts fall between the two landings of a day's answers.
ENDS = [datetime(1995, 3, 2, 1, 30), datetime(1997, 9, 12, 1, 30), datetime(2100, 1, 1)]


def chain_sources(spark, sf) -> dict[str, DataFrame]:
    none = chainlike.no_responses(spark)
    return {
        "bronze_blocks": chain_bronze.blocks(chainlike.legacy_blocks(spark, sf), none),
        "bronze_transactions": chain_bronze.transactions(chainlike.legacy_transactions(spark, sf), none),
        "block_responses": settle(chainlike.block_responses(spark, sf), "responses"), "tx_responses": settle(chainlike.tx_responses(spark, sf), "responses"),
    }


def classic_sources(spark, sf) -> dict[str, DataFrame]:
    k, bronze = Classic(spark, sf), classic_bronze
    return {
        "bronze_blocks": bronze.classic_blocks(classiclike.block_log(spark, sf)),
        "bronze_transactions": bronze.classic_transactions(classiclike.transaction_log(spark, sf)),
        "bronze_transitions": bronze.classic_transitions(classiclike.transition_log(spark, sf)),
        "bronze_msgs": k.bronze_msgs, "bronze_msg_events": k.bronze_events.drop("event_attributes_actions"),
        "bronze_event_actions": k.bronze_events.where(F.col("event_attributes_actions").isNotNull()),
    }


def landed(sources: dict[str, DataFrame], end: datetime) -> dict[str, DataFrame]:
    """What had landed by then; a run finds its own start."""
    return {name: rows.where(F.col("_inserted_timestamp") < F.lit(end)) for name, rows in sources.items()}


def in_batches(spark, models: list[Model], sources: dict[str, DataFrame], run: Run, ends=ENDS) -> ModelSet:
    built = ModelSet(spark, new_folder(spark, "models"), models)
    for end in ends:
        built.update(landed(sources, end), run)
    return built


def compared(built: ModelSet, full: dict[str, DataFrame]) -> DataFrame:
    """(model, rows, differing): rows of each table, and rows that only one of both builds holds, as often as they occur."""
    out = None
    for name, want in full.items():
        have = built.table(name).read()
        columns = [c for c in want.columns if c not in AUDIT]
        text = F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
        # one row for each different row: how often it is in one build and in the other
        sides = have.select(text.alias("row"), F.lit(1).alias("side")).unionByName(want.select(text.alias("row"), F.lit(-1).alias("side")))
        rows = sides.groupBy(F.sha2("row", 256).alias("row")).agg(F.sum("side").alias("more"), F.count_if(F.col("side") == 1).alias("n"))
        one = rows.agg(F.sum("n").alias("rows"), F.sum(F.abs("more")).alias("differing")).select(
            F.lit(name).alias("model"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("differing", F.lit(0)).alias("differing")
        )
        out = one if out is None else out.unionByName(one)
    return out


def _counted(parts: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{name}' AS model, count(*) AS rows, 0 AS differing FROM ({sql})" for name, sql in parts.items())


CHAIN_SQL = {
    "blocks": "blocks_roundtrip", "transactions": "transactions_roundtrip", "transactions_total_count": "transactions_total_count",
    "msgs_2": "message_groups", "msg_attributes_2": "message_attributes", "msgs": "log_messages", "msg_attributes": "log_attributes",
    "transfers_ibc_packets": "packets_roundtrip", "staking": "staking_roundtrip", "dex_swaps": "dex_swaps_roundtrip",
    "transfers": "chain_in_batches", "core_metrics_hourly": "hourly_chain_metrics",
}


@query(_counted(
    {name: ORACLES[key] for name, key in CHAIN_SQL.items()} | {
        "blocks_val_array": "SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders",
        "messages": "SELECT unnest([0, 1]) FROM orders WHERE o_orderstatus <> 'P'",
        "core_metrics_block_hourly": "SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders",
    }
))
def models_chain(spark, sf):
    """Fifteen tables of the current chain in three batches equal their full builds, row for row."""
    run, chain = chainlike.RUN, Chain(spark, sf)
    sources = chain_sources(spark, sf)
    built = in_batches(spark, catalogue.chain_models("year", 1000), sources, run)
    c = chain_silver
    full = {
        "blocks_val_array": c.blocks_val_array(sources["bronze_blocks"], sources["block_responses"], run), "blocks": chain.blocks,
        "transactions": chain.transactions, "transactions_total_count": c.transactions_total_count(sources["tx_responses"], run),
        "msgs_2": chain.msgs_2, "msg_attributes_2": chain.attributes, "msgs": c.msgs(chain.transactions, chain.block_times, run),
        "msg_attributes": c.msg_attributes(chain.transactions, chain.block_times, run), "messages": chain.messages,
        "transfers": chain.transfers, "transfers_ibc_packets": chain.packets, "staking": chain.staking,
        "dex_swaps": c.dex_swaps(chain.messages, chain.transactions),
        "core_metrics_block_hourly": chain_stats.core_metrics_block_hourly(chain.blocks, run),
        "core_metrics_hourly": chain_stats.core_metrics_hourly(chain.transactions, chain.attributes, run),
    }
    return compared(built, full)


CLASSIC_SQL = {
    "blocks": "classic_blocks", "transactions": "classic_transactions", "transitions": "classic_transitions", "msgs": "classic_messages",
    "msg_events": "classic_message_events", "event_actions": "classic_event_actions", "transfer_events": "classic_transfer_events",
}


@query(_counted(
    {name: ORACLES[key] for name, key in CLASSIC_SQL.items()} | {
        f"withdraw_{kind}": f"SELECT * FROM ({ORACLES['classic_rewards']}) WHERE action = 'withdraw_{kind}'"
        for kind in ("delegator_rewards", "validator_commission")
    }
))
def models_classic(spark, sf):
    """Nine tables of the predecessor chain in three batches equal their full builds, row for row."""
    k, c = Classic(spark, sf), classic_silver
    sources = classic_sources(spark, sf)
    built = in_batches(spark, catalogue.classic_models("year"), sources, classiclike.RUN)
    full = {
        "blocks": c.blocks(sources["bronze_blocks"]), "transactions": c.transactions(sources["bronze_transactions"]),
        "transitions": k.transitions, "msgs": k.msgs, "msg_events": k.events, "event_actions": k.actions,
        "transfer_events": c.transfer_events(k.events, k.msgs), "withdraw_delegator_rewards": c.withdraw_delegator_rewards(k.events, k.msgs),
        "withdraw_validator_commission": c.withdraw_validator_commission(k.events, k.msgs),
    }
    return compared(built, full)


@query(f"""
WITH {C}, {DAILY}
SELECT u AS address, strftime(d, '%Y-%m-%d') AS day, n AS balance
FROM (SELECT u, n, unnest(generate_series(day, until - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM iv)
""")
def balance_intervals(spark, sf):
    """Balances of every day, from intervals that three batches out of order brought up to date."""
    changes = classic_silver.balance_changes(Classic(spark, sf).balances)
    table = classic_silver.balance_intervals(spark, new_folder(spark, "intervals"), "year")
    third = F.pmod(F.dayofyear("block_timestamp"), F.lit(3))
    for turn in (1, 0, 2):
        table.apply(changes.where(third == turn), "block_timestamp")
    days = table.daily(datetime(1990, 1, 1).date(), classiclike.RUN.now.date())
    return days.select("address", F.date_format("date", "yyyy-MM-dd").alias("day"), "balance")


def counted_in_batches(spark, sf) -> ModelSet:
    """The stored state of landed transactions after three batches."""
    sources = {"tx_responses": settle(chainlike.tx_responses(spark, sf), "responses")}
    return in_batches(spark, [observability.landed_model(1000)], sources, chainlike.RUN)


@query(ORACLES["impacted_transaction_rows"])
def impacted_from_state(spark, sf):
    """The same report from counts that three batches of responses kept up to date; no payload is read for it."""
    declared = chain_silver.blockchain(_metas(spark, sf), chainlike.RUN)
    counts = observability.block_counts(counted_in_batches(spark, sf), Chain(spark, sf).blocks, declared, chainlike.RUN)
    rows = observability.impacted_transactions(counts, chainlike.RUN)
    return rows.select("block_id", F.col("diff").cast("int").alias("diff"), "blockchain_num_txs", "bronze_num_txs")


@query(f"""
WITH {O} SELECT block AS block_id, -1 AS diff, n + 1 AS blockchain_num_txs, n AS bronze_num_txs FROM days
WHERE n % 5 = 0 AND strftime(day, '%Y-%m-%d') || ' 00:00:00.000000' BETWEEN
  (SELECT min(ts) FROM days WHERE block >= (SELECT max(block) - 40 FROM days)) AND (SELECT max(ts) FROM days)
""")
def impacted_since(spark, sf):
    """A later run checks what the last report flagged or saw in its last hours; it reads the state of these blocks alone."""
    blocks, declared = Chain(spark, sf).blocks, chain_silver.blockchain(_metas(spark, sf), chainlike.RUN)
    newest = blocks.agg(F.max("block_id").alias("b"), F.max("block_timestamp").alias("t")).first()
    log = spark.createDataFrame(
        [(newest.t, newest.b - 39, chainlike.RUN.now)], "max_block_timestamp timestamp_ntz, first_impacted_block long, test_timestamp timestamp_ntz"
    )
    counts = observability.block_counts(counted_in_batches(spark, sf), blocks, declared, chainlike.RUN, log=log)
    rows = observability.impacted_transactions(counts, chainlike.RUN)
    return rows.select("block_id", F.col("diff").cast("int").alias("diff"), "blockchain_num_txs", "bronze_num_txs")


@query(f"""
WITH {O} SELECT strftime(day, '%Y-%m-%d') AS hour, count(DISTINCT o_custkey) AS senders FROM o GROUP BY 1
""")
def hourly_senders_from_state(spark, sf):
    """Senders of each hour from bitmaps, after batches out of order that come twice in part; no hour is computed again."""
    chain = Chain(spark, sf)
    paid = settle(chain_stats.paid_transactions(chain.transactions, chain.attributes, chainlike.RUN), "paid")
    kept = HourlyDistinct(spark, new_folder(spark, "senders"), "block_timestamp", ["tx_from"], part="year")
    third = F.pmod(F.xxhash64("tx_id"), F.lit(3))
    for turns in ((1, 2), (0,), (2,)):
        kept.add(paid.where(third.isin(list(turns))))
    return kept.counts().select(F.date_format("hour", "yyyy-MM-dd").alias("hour"), F.col("tx_from").alias("senders"))


@query("""
SELECT 'hour' AS unit, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS start, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds,
  count(DISTINCT event_id) AS events FROM events GROUP BY 2
UNION ALL
SELECT 'day', strftime(date_trunc('day', ts), '%Y-%m-%d %H'), count(DISTINCT user_id), count(DISTINCT event_type), count(DISTINCT event_id) FROM events GROUP BY 2
""")
def distinct_state(spark, sf):
    """Exact distinct counts of hours and days from one state, kept up to date by batches in any order."""
    events = table(spark, sf, "events").select("ts", F.col("user_id").alias("users"), F.col("event_type").alias("kinds"), F.col("event_id").alias("events"))
    kept = HourlyDistinct(spark, new_folder(spark, "distinct"), "ts", ["users", "kinds", "events"], part="month")
    late = F.pmod(F.col("events"), F.lit(5)) == 0
    for batch in (events.where(~late), events.where(late)):
        kept.add(batch)
    each = [kept.counts(unit).select(F.lit(unit).alias("unit"), F.date_format(unit, "yyyy-MM-dd HH").alias("start"), "users", "kinds", "events") for unit in ("hour", "day")]
    return each[0].unionByName(each[1])
