"""Coins expected from pool calls, against a table of pool actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import safe_json, vstr, vvar
from ledgerlake.operators.flatten import split_rows
from ledgerlake.quality.checks import differs_from


def expected_coins(labels: DataFrame, messages: DataFrame) -> DataFrame:
    """(tx_id, amount, currency) of both coins and the pool token of every provide and withdraw call.

    ``messages`` is silver.messages; the call of a withdrawal is base64-coded JSON.
    """
    pools = labels.where(F.col("label_subtype") == "pool").select("address", "label").distinct()
    calls = messages.withColumn("address", vstr("message_value", "contract")).join(
        pools.select("address"), "address", "left_semi"
    ).select("tx_id", "message_value", F.col("attributes")["wasm"].alias("logs"))
    sent = F.try_to_binary(vstr("message_value", "msg.send.msg"), F.lit("base64")).cast("string")
    withdraws = calls.where(vvar(safe_json(sent), "withdraw_liquidity").isNotNull())
    provides = calls.where(vvar("message_value", "msg.provide_liquidity").isNotNull())

    def side(df: DataFrame, share: str, assets: str) -> DataFrame:
        pool_token = df.join(pools, df["logs"]["_contract_address_0"] == pools["address"]).select(
            "tx_id", F.col("logs")[share].try_cast("decimal(38,0)").alias("amount"), F.col("label").alias("currency")
        )
        coins = split_rows(df, F.col("logs")[assets], ", ", "coin", "coin_index").select(
            "tx_id",
            F.regexp_substr("coin", F.lit("[0-9]+")).try_cast("decimal(38,0)").alias("amount"),
            F.nullif(F.regexp_extract("coin", r"[0-9]+([^0-9].+)", 1), F.lit("")).alias("currency"),
        )
        return coins.unionByName(pool_token)

    both = side(withdraws, "withdrawn_share", "refund_assets").unionByName(side(provides, "share", "assets"))
    return both.distinct()


def wrong_pairs(actual: DataFrame, labels: DataFrame, messages: DataFrame) -> DataFrame:
    return differs_from(actual.select("tx_id", "amount", "currency"), expected_coins(labels, messages))
