"""Raw responses of the current chain to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import varray, vlong, vstr, vtime, vvar
from ledgerlake.operators.flatten import flatten_path

# Constants published with every row of the current chain.
NETWORK = "mainnet"
CHAIN_ID = "terra2"
# Fixed value: the last block of the older response layout.
LAST_OLD_BLOCK = 4711778


def response_blocks(responses: DataFrame) -> DataFrame:
    """One row per block response; only headers and counts go on, the transactions of the block stay behind."""
    block = responses.where(vvar("data", "result.block").isNotNull())
    return block.select(
        F.lit(None).cast("string").alias("record_id"),
        F.lit(None).cast("bigint").alias("offset_id"),
        F.col("block_number").alias("block_id"),
        vtime("data", "result.block.header.time").alias("block_timestamp"),
        F.lit(NETWORK).alias("network"),
        F.lit(CHAIN_ID).alias("chain_id"),
        F.coalesce(F.array_size(varray("data", "result.block.data.txs")), F.lit(0)).cast("bigint").alias("tx_count"),
        vvar("data", "result.block.header").alias("header"),
        vvar("data", "result.block.last_commit").alias("last_commit"),
        vvar("data", "result.block.evidence").alias("evidence"),
        F.col("_inserted_timestamp").alias("_ingested_at"),
        "_inserted_timestamp",
    )


def blocks(legacy: DataFrame, responses: DataFrame) -> DataFrame:
    """bronze.blocks: legacy block rows and block responses."""
    old = legacy.select(
        F.col("record_id").cast("string").alias("record_id"),
        F.col("offset_id").cast("bigint").alias("offset_id"),
        "block_id", "block_timestamp", "network", "chain_id",
        F.col("tx_count").cast("bigint").alias("tx_count"),
        "header",
        F.lit(None).cast("variant").alias("last_commit"),
        F.lit(None).cast("variant").alias("evidence"),
        F.col("ingested_at").alias("_ingested_at"),
        "_inserted_timestamp",
    )
    return old.unionByName(response_blocks(responses))


def response_transactions(responses: DataFrame) -> DataFrame:
    """One row per transaction of a search response."""
    # the transactions are copied out of the answer once, not the list before them
    listed = F.posexplode(varray("data", "result.txs")).alias("tx_block_index", "tx")
    flat = responses.select("block_number", "_inserted_timestamp", listed)
    return flat.select(
        F.lit(None).cast("string").alias("record_id"),
        vstr("tx", "hash").alias("tx_id"),
        F.col("tx_block_index").cast("bigint").alias("tx_block_index"),
        F.lit(None).cast("bigint").alias("offset_id"),
        F.col("block_number").alias("block_id"),
        F.lit(None).cast("timestamp_ntz").alias("block_timestamp"),
        F.lit(NETWORK).alias("network"),
        F.lit(CHAIN_ID).alias("chain_id"),
        "tx",
        F.col("_inserted_timestamp").alias("_ingested_at"),
        "_inserted_timestamp",
    )


def transactions(legacy: DataFrame, responses: DataFrame) -> DataFrame:
    """bronze.transactions: legacy transaction rows and search responses."""
    old = legacy.select(
        F.col("record_id").cast("string").alias("record_id"),
        "tx_id",
        F.col("tx_block_index").cast("bigint").alias("tx_block_index"),
        F.col("offset_id").cast("bigint").alias("offset_id"),
        "block_id", "block_timestamp", "network", "chain_id", "tx",
        F.col("ingested_at").alias("_ingested_at"),
        "_inserted_timestamp",
    )
    return old.unionByName(response_transactions(responses))


def block_metas(answers: DataFrame) -> DataFrame:
    """Block-meta entries of the header-range responses (``data[*].result.block_metas[*]``)."""
    flat = flatten_path(answers, F.col("data"), ["data", "result.block_metas"], "meta")
    return flat.select(
        vstr("meta", "header.chain_id").alias("chain_id"),
        vlong("meta", "header.height").alias("block_id"),
        vtime("meta", "header.time").alias("block_timestamp"),
        vlong("meta", "block_size").alias("block_size"),
        vvar("meta", "header").alias("block_header"),
        vvar("meta", "block_id").alias("block_id_object"),
        vlong("meta", "num_txs").alias("num_txs"),
        "_inserted_timestamp",
    )
