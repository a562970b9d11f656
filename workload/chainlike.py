"""Chain-shaped payloads made from the orders table by Spark, row by row.

An order is a transaction, an order date is a block. The order's priority decides which events it carries, its
status whether attributes are base64-coded (F) and whether it failed (P). No order is grouped with another, so the
payloads stay small whatever the size or skew of the table.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans import chain_bronze, chain_silver
from ledgerlake.quality import quarantined
from ledgerlake.run import Run
from ledgerlake.session import new_folder
from workload import table
from workload.relational import cents
from workload.shared import Stage, spread, stage

RUN = Run(datetime(2010, 1, 1))
FIRST_DAY = "1992-01-01"
FIRST_BLOCK = 4710578
LEGACY_DAYS = 1150

URGENT, HIGH, MEDIUM, PLAIN, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"
ACTIONS = {
    URGENT: "/cosmos.authz.v1beta1.MsgExec",
    HIGH: "/ibc.applications.transfer.v1.MsgTransfer",
    MEDIUM: "/ibc.core.channel.v1.MsgAcknowledgement",
    PLAIN: "/cosmos.staking.v1beta1.MsgDelegate",
    LOW: "/ibc.core.channel.v1.MsgRecvPacket",
}


def day_number(column: str = "o_orderdate") -> Column:
    return F.date_diff(F.to_date(column), F.lit(FIRST_DAY).cast("date"))


def orders(spark, sf) -> DataFrame:
    """Narrow order rows, spread over all cores before each of them grows into a payload a hundred times its size."""
    status = F.col("o_orderstatus")
    return spread(table(spark, sf, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderdate",
        status.alias("status"), F.col("o_orderpriority").alias("priority"),
        (day_number() + FIRST_BLOCK).cast("bigint").alias("block"),
        cents("o_totalprice").cast("string").alias("cents"),
        F.concat(F.lit("addr"), F.col("o_custkey").cast("string")).alias("cust"),
        F.concat(F.lit("peer"), status).alias("peer"),
        F.md5(F.col("o_orderkey").cast("string")).alias("hash"),
    )


def _event(kind: str | Column, *pairs: tuple[str | Column, str | Column], coded: bool = False) -> Column:
    """``coded``: keys and values in base64, each in one piece (the function itself breaks long output into lines)."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    code = lambda x: F.replace(F.base64(lit(x).cast("binary")), F.lit("\r\n"), F.lit("")) if coded else lit(x)
    attributes = F.array(*[F.struct(code(k).alias("key"), code(v).alias("value")) for k, v in pairs])
    return F.struct(lit(kind).alias("type"), attributes.alias("attributes"))


def result_events() -> Column:
    return F.when(F.col("status") == "F", _result_events(True)).otherwise(_result_events(False))


def _result_events(coded: bool) -> Column:
    c, event = F.col, partial(_event, coded=coded)
    coin = lambda denom: F.concat(c("cents"), F.lit(denom))
    first_key = F.when(c("status") == "F", "spender").when(c("status") == "O", "fee").otherwise("granter")
    sequence = F.concat_ws("/", c("cust"), c("o_orderkey").cast("string"))
    fee = F.concat(c("o_custkey").cast("string"), F.lit("uluna"))
    head = [event("coin_spent", (first_key, c("cust"))), event("tx", ("acc_seq", sequence), ("fee", fee))]
    packet = [("packet_sequence", F.concat(F.lit("#"), c("o_custkey").cast("string"))), ("packet_src_channel", "channel-1"), ("packet_dst_channel", "channel-2")]
    data = F.to_json(
        F.struct(
            c("cents").alias("amount"), F.lit("uluna").alias("denom"), c("peer").alias("receiver"),
            F.concat(F.lit("far"), c("cust")).alias("sender"),
        )
    )
    kind = F.when(c("status") == "F", "redelegate").when(c("status") == "O", "delegate").otherwise("unbond")
    first_validator = F.when(c("status") == "F", "destination_validator").otherwise("validator")
    extra = F.when(c("status") == "F", "source_validator").when(c("status") == "O", "note").otherwise("completion_time")
    extra_value = F.when(c("status") == "P", "2001-02-03T04:05:06Z").otherwise("valold")
    transfer = lambda to, sender, amount: event("transfer", ("recipient", to), ("sender", sender), ("amount", amount))
    tails = {
        URGENT: [
            event("message", ("module", "bank")), transfer(c("peer"), c("cust"), coin("uluna")),
            event("message", ("module", "bank")), transfer(c("peer"), c("cust"), coin("ibc/AB")),
        ],
        HIGH: [
            transfer("escrow", c("cust"), coin("uluna")), event("ibc_transfer", ("sender", c("cust")), ("receiver", c("peer"))),
            event("send_packet", *packet), event("message", ("module", "transfer")),
        ],
        MEDIUM: [event("acknowledge_packet", *packet), event("message", ("module", "ibc"))],
        PLAIN: [
            event(kind, (first_validator, "val1"), ("amount", coin("uluna,7ibc/CD")), (extra, extra_value)),
            event("message", ("module", "staking"), ("sender", c("cust"))), event("tx", ("fee_payer", c("cust"))),
        ],
        LOW: [
            event("write_acknowledgement", ("packet_data", data)), transfer(c("peer"), "escrow", coin("uluna")),
            event("message", ("module", "ibc")),
        ],
    }
    out = None
    for priority, tail in tails.items():
        events = F.array(*head, event("message", ("action", ACTIONS[priority])), *tail)
        out = F.when(c("priority") == priority, events) if out is None else out.when(c("priority") == priority, events)
    return out


def action() -> Column:
    table_ = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    return F.try_element_at(table_, F.col("priority"))


def log_text() -> Column:
    """The log of a transaction: JSON text, or an error message where it failed.

    Urgent orders have a third entry whose two events share a field; open urgent ones swap twice in one event.
    """
    c = F.col
    entry = lambda i, *events: F.struct(F.lit(i).alias("msg_index"), F.array(*events).alias("events"))
    zero = entry(
        0, _event("message", ("action", action())),
        _event("transfer", ("recipient", c("peer")), ("sender", c("cust")), ("amount", F.concat(c("cents"), F.lit("uluna"))), ("amount", "5ibc/AB")),
    )
    swap = [
        ("_contract_address", c("peer")), ("action", "swap"), ("offer_asset", "uluna"), ("offer_amount", c("cents")),
        ("ask_asset", "uusd"), ("return_amount", c("o_custkey")),
    ]
    again = [
        ("_contract_address", "pool2"), ("action", "swap"), ("offer_asset", "uusd"), ("offer_amount", c("o_custkey")),
        ("ask_asset", "ukrw"), ("return_amount", "11"),
    ]
    urgent = c("priority") == URGENT
    one = F.when(urgent & (c("status") == "O"), entry(1, _event("message", ("module", "bank")), _event("wasm", *swap, *again))).otherwise(
        entry(1, _event("message", ("module", "bank")), _event("wasm", *swap))
    )
    two = entry(2, _event("message", ("module", "wasm")), _event("message", ("module", "bank")))
    entries = F.when(urgent, F.array(zero, one, two)).otherwise(F.array(zero, one))
    return F.when(c("status") == "P", F.lit("failed to execute message; out of gas")).otherwise(F.to_json(entries))


def tx_responses(spark, sf) -> DataFrame:
    """One search response per order; every response lands twice, the second time with its final gas."""
    c = F.col
    executes = F.struct(
        F.lit("/cosmwasm.wasm.v1.MsgExecuteContract").alias("@type"), F.lit(None).cast("string").alias("grantee"),
        F.struct(F.struct(F.lit("1").alias("belief_price")).alias("swap")).alias("msg"),
    )
    sends = F.struct(
        F.lit("/cosmos.bank.v1beta1.MsgSend").alias("@type"),
        F.when(c("status") == "O", F.concat(F.lit("grantee"), c("o_custkey").cast("string"))).alias("grantee"),
        F.lit(None).cast("struct<swap:struct<belief_price:string>>").alias("msg"),
    )
    messages = F.when(c("priority") == URGENT, F.array(executes, executes)).otherwise(F.array(sends, sends))
    tx = F.struct(
        c("hash"), c("block").cast("string").alias("height"),
        F.struct(
            F.when(c("status") == "P", 5).otherwise(0).alias("code"),
            F.when(c("status") == "P", F.lit("sdk")).otherwise("").alias("codespace"),
            F.when(c("o_custkey").isNotNull(), "").alias("gasUsed"),
            log_text().alias("log"), result_events().alias("events"),
        ).alias("tx_result"),
        F.struct(
            F.array(
                F.struct(
                    F.struct(F.struct(F.lit("SIGN_MODE_DIRECT").alias("mode")).alias("single")).alias("mode_info"),
                    F.struct(c("hash").alias("key")).alias("public_key"),
                )
            ).alias("signer_infos"),
            F.struct(
                F.array(F.struct(c("cents").alias("amount"), F.lit("uluna").alias("denom"))).alias("amount"),
                c("o_orderkey").cast("string").alias("gas_limit"), F.lit("").alias("granter"),
                F.when(c("status") == "P", F.concat(F.lit("payer"), c("o_custkey").cast("string"))).alias("payer"),
            ).alias("fee"),
        ).alias("auth_info"),
        F.struct(c("priority").alias("memo"), messages.alias("messages")).alias("body"),
    )
    body = F.struct(F.struct(F.lit("1").alias("total_count"), F.array(tx).alias("txs")).alias("result"))
    request = F.array(F.concat(F.lit("tx.height="), c("block").cast("string")), F.lit("true"), F.lit("1"))
    # the text of an answer is made once; its two landings differ in their gas alone, and no text before it is free
    landed = orders(spark, sf).withColumn("text", F.to_json(body)).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    mark = '"gasUsed":"'
    gas = (c("o_custkey") + c("copy")).cast("string")
    text = F.coalesce(F.overlay("text", gas, F.instr("text", mark) + len(mark), F.lit(0)), "text")
    return landed.select(
        c("block").alias("block_number"), F.parse_json(text).alias("data"),
        F.parse_json(F.to_json(F.struct(F.struct(request.alias("params")).alias("request")))).alias("metadata"),
        (c("o_orderdate") + F.make_interval(hours=c("copy") + 1)).cast("timestamp_ntz").alias("_inserted_timestamp"),
    )


def _days(spark, sf) -> DataFrame:
    """One row per order date; counts are combined on the map side."""
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.withColumn("d", F.date_diff("day", F.lit(FIRST_DAY).cast("date"))).withColumn(
        "block", (F.col("d") + FIRST_BLOCK).cast("bigint")
    )


def _header(copy: Column, commit: Column) -> Column:
    c = F.col
    block = c("block").cast("string")
    return F.struct(
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00.123456789Z")).alias("time"),
        block.alias("height"), F.lit("phoenix-1").alias("chain_id"),
        F.concat(F.lit("app"), block, F.lit("-"), copy.cast("string")).alias("app_hash"),
        F.lit("consensus").alias("consensus_hash"), F.lit("data").alias("data_hash"), F.lit("ev").alias("evidence_hash"),
        F.struct(F.lit("id").alias("hash")).alias("last_block_id"), F.lit("commit").alias("last_commit_hash"),
        F.lit("results").alias("last_results_hash"), F.lit("next").alias("next_validators_hash"),
        F.concat(F.lit("prop"), (c("d") % 5).cast("string")).alias("proposer_address"), F.lit("vals").alias("validators_hash"),
        F.when(c("block") <= chain_bronze.LAST_OLD_BLOCK, commit).alias("last_commit"),
    )


def _commit() -> Column:
    signer = lambda k: F.struct(F.concat(F.lit("VAL"), (F.col("d") % k).cast("string")).alias("validator_address"))
    return F.struct(
        (F.col("block") - 1).cast("string").alias("height"), F.array(signer(7), signer(3), signer(7)).alias("signatures")
    )


def block_responses(spark, sf) -> DataFrame:
    """One block response per order date from day LEGACY_DAYS on, landed twice; a block lists up to four txs."""
    c = F.col
    days = _days(spark, sf).where(c("d") >= LEGACY_DAYS).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    txs = F.array_repeat(F.lit("tx"), (c("n") % 5).cast("int"))
    block = F.struct(
        _header(c("copy"), _commit()).alias("header"), F.struct(txs.alias("txs")).alias("data"),
        F.when(c("block") > chain_bronze.LAST_OLD_BLOCK, _commit()).alias("last_commit"),
    )
    body = F.struct(F.struct(block.alias("block")).alias("result"))
    landed = (c("day").cast("timestamp_ntz") + F.make_interval(hours=c("copy") + 1)).cast("timestamp_ntz")
    return days.select(
        c("block").alias("block_number"), F.parse_json(F.to_json(body)).alias("data"), landed.alias("_inserted_timestamp")
    )


def legacy_blocks(spark, sf) -> DataFrame:
    c = F.col
    days = _days(spark, sf).where(c("d") < LEGACY_DAYS)
    at = c("day").cast("timestamp_ntz")
    return days.select(
        F.lit("legacy").alias("record_id"), c("block").alias("offset_id"), c("block").alias("block_id"),
        at.alias("block_timestamp"), F.lit("mainnet").alias("network"), F.lit("terra2").alias("chain_id"),
        (c("n") % 5).alias("tx_count"), F.parse_json(F.to_json(_header(F.lit(1), _commit()))).alias("header"),
        at.alias("ingested_at"), at.alias("_inserted_timestamp"),
    )


def legacy_transactions(spark, sf) -> DataFrame:
    """The legacy transaction table, empty here: every order arrives as a response."""
    schema = (
        "record_id string, tx_id string, tx_block_index bigint, offset_id bigint, block_id bigint, "
        "block_timestamp timestamp_ntz, network string, chain_id string, tx variant, ingested_at timestamp_ntz, "
        "_inserted_timestamp timestamp_ntz"
    )
    return spark.createDataFrame([], schema)


def no_responses(spark) -> DataFrame:
    return spark.createDataFrame([], "block_number bigint, data variant, _inserted_timestamp timestamp_ntz")


class _Chain(Stage):
    """The silver tables of the derived chain, built by the library's own functions.

    As in a real build, a table that several others read is written once and read back.
    """

    @cached_property
    def blocks(self) -> DataFrame:
        bronze = chain_bronze.blocks(legacy_blocks(self.spark, self.sf), no_responses(self.spark))
        responses = block_responses(self.spark, self.sf)
        validators = chain_silver.blocks_val_array(bronze, responses, RUN)
        return self.settle(chain_silver.blocks(bronze, responses, validators, RUN), "blocks")

    @cached_property
    def block_times(self) -> DataFrame:
        """Blocks without their validators, for tables that need times and chain ids only."""
        return self.blocks.select("block_id", "block_timestamp", "chain_id")

    def responses(self) -> DataFrame:
        return tx_responses(self.spark, self.sf)

    @cached_property
    def transactions(self) -> DataFrame:
        bronze = chain_bronze.transactions(legacy_transactions(self.spark, self.sf), no_responses(self.spark))
        silver = chain_silver.transactions(bronze, self.responses(), self.block_times, RUN)
        return self.settle(silver, "transactions")

    @cached_property
    def msgs_2(self) -> DataFrame:
        return self.settle(chain_silver.msgs_2(self.transactions, RUN), "events")

    @cached_property
    def attributes(self) -> DataFrame:
        return self.settle(chain_silver.msg_attributes_2(self.msgs_2, RUN), "attributes")

    @cached_property
    def packets(self) -> DataFrame:
        return chain_silver.transfers_ibc_packets(self.msgs_2, RUN)

    @cached_property
    def transfers(self) -> DataFrame:
        return chain_silver.transfers(self.msgs_2, RUN)

    @cached_property
    def transfers_ibc(self) -> DataFrame:
        return chain_silver.transfers_ibc(self.msgs_2, self.packets, RUN)

    @cached_property
    def staking(self) -> DataFrame:
        return chain_silver.staking(self.msgs_2, RUN)

    @cached_property
    def _messages(self) -> tuple[DataFrame, DataFrame]:
        """Clean messages and those in quarantine, from one pass over the transactions."""
        checked = chain_silver.checked_messages(self.transactions, self.block_times, RUN)
        folder = new_folder(self.spark, "messages")
        both = quarantined(checked, "shared_fields", folder)
        self.paths.append(folder)
        return both

    @property
    def messages(self) -> DataFrame:
        return self._messages[0]

    @property
    def odd_messages(self) -> DataFrame:
        return self._messages[1]


def Chain(spark, sf) -> _Chain:  # noqa: N802
    return stage(_Chain, spark, sf)
