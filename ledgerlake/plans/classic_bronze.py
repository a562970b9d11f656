"""Streams of the predecessor chain's sink log to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import joined_key, varray, vdec, vdouble, vlong, vstr, vtime, vvar
from ledgerlake.operators.flatten import flatten_array
from ledgerlake.sources.sink_log import classed, created_at, named, pinned, stream_results, typed_results

# Stream names, classes and run ids of the sink log.
BLOCK_STREAMS = ["terra_block_model", "terra-5_block_model"]
TX_RUNS = [("terra_tx_model", "v2022.03.02.0"), ("terra-5_tx_model", "v2022.01.14.0")]
MSG_STREAMS = ["terra_msg_model", "terra-5_msg_model"]
EVENT_STREAMS = ["terra_msg_event_model", "terra-5_msg_event_model"]
TRANSITION_STREAMS = ["terra_transition_model", "terra-5_transition_model"]
TAX_STREAMS = ["terra-5_tax_rate"]
BALANCE_CLASSES = [
    "terra.balances.models.Terra5BalancesModel",
    "terra.balances.models.Terra5DelegationsModel",
    "terra.balances.models.TerraBalancesModel",
    "terra.balances.models.TerraDelegationsModel",
]
SYNTHETIC_CLASSES = [
    "terra.balances.terra_synthetic_balances_model.TerraSyntheticBalancesModel",
    "terra.balances.terra_synthetic_balances_model.Terra5SyntheticBalancesModel",
]
ASTROPORT_STREAMS = [
    "terra-5_astroport_pool_reserves", "terra-5_astroport_pool_reserves_bison", "terra-5_astroport_pool_reserves_backfill",
]
TERRASWAP_STREAMS = [
    "terra-5_terraswap_pool_reserves", "terra-5_terraswap_pool_reserves_bison", "terra-5_terraswap_pool_reserves_backfill",
]
FIRST_ASTROPORT_BLOCK = 5840738
PUNK_FEED_KEY = '"testing-1635197180"'
PUNK_PROJECT = "Galactic Punks"

BLOCK_KEY = ("chain_id", "block_id")
TX_KEY = ("chain_id", "block_id", "tx_id")
MSG_KEY = ("chain_id", "block_id", "tx_id", "msg_index")
EVENT_KEY = ("chain_id", "block_id", "tx_id", "msg_index", "event_index")


def _text(*names: str) -> list[Column]:
    return [vstr("t", n).alias(n) for n in names]


def _place() -> list[Column]:
    return [
        F.col("system_created_at"),
        F.col("_inserted_timestamp"),
        vstr("t", "blockchain").alias("blockchain"),
        vlong("t", "block_id").alias("block_id"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        vstr("t", "chain_id").alias("chain_id"),
    ]


def _tx_id() -> Column:
    """The field was renamed between two versions of the chain."""
    return F.coalesce(vstr("t", "txhash"), vstr("t", "tx_id")).alias("tx_id")


def row_key(*parts: str) -> Column:
    return joined_key("-", *parts)


def classic_blocks(log: DataFrame) -> DataFrame:
    return stream_results(log, named(*BLOCK_STREAMS)).select(
        "system_created_at", "_inserted_timestamp",
        vstr("record_content", "model.blockchain").alias("chain_id"),
        vlong("t", "block_id").alias("block_id"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        *_text("blockchain", "proposer_address"),
        vlong("t", "num_txs").alias("tx_count"),
    )


def classic_transactions(log: DataFrame) -> DataFrame:
    return stream_results(log, pinned(TX_RUNS)).select(
        *_place(),
        vstr("t", "codespace").alias("codespace"),
        _tx_id(),
        vvar("t", "tx_from").alias("tx_from"),
        vvar("t", "tx_to").alias("tx_to"),
        *_text("tx_type", "tx_module", "tx_status", "tx_status_msg"),
        vlong("t", "tx_code").alias("tx_code"),
        varray("t", "fee").alias("fee"),
        vdouble("t", "gas_wanted").alias("gas_wanted"),
        vdouble("t", "gas_used").alias("gas_used"),
    )


def _chain_time(column: str) -> Column:
    """As ``vtime``, for a text that is read already."""
    return F.regexp_replace(column, r"Z$", "").try_cast("timestamp_ntz").alias(column)


PLACE_FIELDS = ["blockchain string", "block_id bigint", "block_timestamp string", "chain_id string", "txhash string", "tx_id string"]
MSG_FIELDS = [
    *PLACE_FIELDS, "tx_type string", "tx_status string", "tx_module string", "tx_memo string", "msg_index bigint", "msg_type string",
    "msg_module string", "msg_value variant",
]
EVENT_FIELDS = [
    *PLACE_FIELDS, "tx_module string", "tx_status string", "tx_type string", "msg_index bigint", "msg_type string", "msg_module string",
    "event_type string", "event_index bigint", "event_attributes variant",
]


def _typed(log: DataFrame, streams: list[str], fields: list[str]) -> DataFrame:
    """One column for each field, with the time and the renamed transaction id resolved."""
    rows = typed_results(log, named(*streams), fields)
    names = [f.split(" ")[0] for f in fields[len(PLACE_FIELDS):]]
    return rows.select(
        "system_created_at", "_inserted_timestamp", "blockchain", "block_id", _chain_time("block_timestamp"), "chain_id",
        F.coalesce("txhash", "tx_id").alias("tx_id"), *names,
    )


def classic_msgs(log: DataFrame) -> DataFrame:
    return _typed(log, MSG_STREAMS, MSG_FIELDS)


def classic_msg_events(log: DataFrame) -> DataFrame:
    return _typed(log, EVENT_STREAMS, EVENT_FIELDS)


def classic_msg_events_actions(log: DataFrame, all_events: bool = False) -> DataFrame:
    """Events that carry actions, or all events with their actions so that one pass serves both tables."""
    rows = _typed(log, EVENT_STREAMS, [*EVENT_FIELDS, "event_attributes_actions variant"])
    is_object = F.try_variant_get("event_attributes_actions", "$", "map<string,variant>").isNotNull()
    return rows if all_events else rows.where(is_object)


def classic_transitions(log: DataFrame) -> DataFrame:
    return stream_results(log, named(*TRANSITION_STREAMS)).select(
        *_place(),
        vstr("t", "event").alias("event"),
        vlong("t", "index").alias("index"),
        vstr("t", "transition_type").alias("transition_type"),
        vvar("t", "attributes").alias("event_attributes"),
    )


def classic_balances(log: DataFrame) -> DataFrame:
    return stream_results(log, classed(*BALANCE_CLASSES)).select(
        "system_created_at", "_inserted_timestamp",
        vstr("t", "address").alias("address"),
        vdouble("t", "balance").alias("balance"),
        vstr("t", "balance_type").alias("balance_type"),
        vlong("t", "block_id").alias("block_number"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        *_text("blockchain", "currency"),
    )


def classic_synthetic_balances(log: DataFrame) -> DataFrame:
    return stream_results(log, classed(*SYNTHETIC_CLASSES)).select(
        F.col("system_created_at").alias("_system_created_at"), "_inserted_timestamp",
        vlong("t", "block_id").alias("block_id"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        *_text("chain_id", "function_name", "inputs", "project_id", "project_name"),
        vdec("t", "value_numeric").alias("value_numeric"),
        vvar("t", "value_obj").alias("value_obj"),
    )


def _pool_reserves(log: DataFrame, streams: list[str]) -> DataFrame:
    return stream_results(log, named(*streams)).select(
        "system_created_at",
        vstr("t", "chain_id").alias("chain_id"),
        vlong("t", "block_id").alias("block_id"),
        vstr("t", "blockchain").alias("blockchain"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        vstr("t", "contract_address").alias("contract_address"),
        vdec("t", "value_obj.total_share").alias("total_share"),
        vstr("t", "value_obj.asset_1").alias("token_0_currency"),
        vdec("t", "value_obj.asset_1_value").alias("token_0_amount"),
        vstr("t", "value_obj.asset_2").alias("token_1_currency"),
        vdec("t", "value_obj.asset_2_value").alias("token_1_amount"),
    )


def classic_astroport_pool_reserves(log: DataFrame) -> DataFrame:
    rows = _pool_reserves(log, ASTROPORT_STREAMS)
    return rows.where(F.col("block_id") >= FIRST_ASTROPORT_BLOCK).distinct()


def classic_terraswap_pool_reserves(log: DataFrame) -> DataFrame:
    return _pool_reserves(log, TERRASWAP_STREAMS)


def tax_rate_rows(log: DataFrame) -> DataFrame:
    return stream_results(log, named(*TAX_STREAMS)).select(
        "system_created_at", "_inserted_timestamp",
        F.substring(vstr("record_content", "model.executor.chain_id"), 1, 10).alias("chain_id"),
        vlong("t", "block_number").alias("block_number"),
        vtime("t", "block_timestamp").alias("block_timestamp"),
        vdouble("t", "tax_rate").alias("tax_rate"),
    )


def classic_nft_metadata(uploads: DataFrame, proxy: DataFrame) -> DataFrame:
    """Uploaded metadata and one collection's own feed, whose traits arrive as JSON inside strings."""
    from_sink = uploads.where(
        (F.try_element_at(F.split(vstr("record_content", "model.sinks[0].destination"), r"\."), F.lit(3)) == "nft_metadata")
        & (vstr("record_content", "model.blockchain") == "terra")
    )
    sink_rows = flatten_array(
        from_sink.select(created_at().alias("system_created_at"), vvar("record_content", "results").alias("results")),
        F.col("results"), "t", "i",
    )
    uploaded = sink_rows.select(
        "system_created_at",
        F.lit("terra").alias("blockchain"),
        vdouble("t", "commission_rate").alias("commission_rate"),
        *_text("contract_address", "contract_name"),
        vlong("t", "created_at_block_id").alias("created_at_block_id"),
        vtime("t", "created_at_timestamp").alias("created_at_timestamp"),
        *_text("created_at_tx_id", "creator_address", "creator_name", "image_url", "project_name", "token_id"),
        vvar("t", "token_metadata").alias("token_metadata"),
        *_text("token_metadata_uri", "token_name"),
    )
    feed = proxy.where(vstr("record_metadata", "key") == PUNK_FEED_KEY)
    feed_rows = flatten_array(
        feed.select(created_at().alias("system_created_at"), "record_content"), F.col("record_content"), "t", "i"
    )
    inner = F.split_part(F.split_part(vstr("t", "attributes"), F.lit("["), F.lit(2)), F.lit("]"), F.lit(1))
    metadata = F.parse_json(
        F.concat(
            F.lit('{"traits": '), F.to_json(F.parse_json(inner)),
            F.lit(', "additional_metadata": '), F.to_json(F.parse_json(vstr("t", "additional_metadata"))), F.lit("}"),
        )
    )
    nothing = F.lit(None).cast("string")
    punks = feed_rows.select(
        "system_created_at",
        F.lit("terra").alias("blockchain"),
        F.lit(None).cast("double").alias("commission_rate"),
        vstr("t", "collection_addr").alias("contract_address"),
        F.lit(PUNK_PROJECT).alias("contract_name"),
        F.lit(None).cast("bigint").alias("created_at_block_id"),
        vtime("t", "created_at").alias("created_at_timestamp"),
        nothing.alias("created_at_tx_id"),
        nothing.alias("creator_address"),
        nothing.alias("creator_name"),
        vstr("t", "src").alias("image_url"),
        F.lit(PUNK_PROJECT).alias("project_name"),
        vstr("t", "token_id").alias("token_id"),
        metadata.alias("token_metadata"),
        nothing.alias("token_metadata_uri"),
        vstr("t", "name").alias("token_name"),
    )
    return uploaded.unionByName(punks)
