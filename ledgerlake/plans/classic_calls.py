"""Reads that the contract tables share: message paths, action fields, and actions with their message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import vdouble, vstr, vvar
from ledgerlake.plans.classic_silver import SUCCEEDED

PLACE = ["blockchain", "chain_id", "block_id", "block_timestamp", "tx_id"]


def ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("tx_status") == SUCCEEDED)


def msg(path: str) -> Column:
    return vstr("msg_value", path)


def msg_has(path: str) -> Column:
    return vvar("msg_value", path).isNotNull()


def msg_tokens(path: str, decimals: int = 6) -> Column:
    return vdouble("msg_value", path) / float(10**decimals)


def attr(path: str) -> Column:
    return vstr("event_attributes", path)


def attr_has(path: str) -> Column:
    return vvar("event_attributes", path).isNotNull()


def attr_tokens(path: str, decimals: int = 6) -> Column:
    return vdouble("event_attributes", path) / float(10**decimals)


def _field(name: str) -> Column:
    return F.try_element_at("action_log", F.lit(name))


def act(name: str) -> Column:
    return vstr(_field(name))


def act_has(name: str) -> Column:
    return _field(name).isNotNull()


def act_tokens(name: str, decimals: int = 6) -> Column:
    return vdouble(_field(name)) / float(10**decimals)


def with_message(actions: DataFrame, messages: DataFrame) -> DataFrame:
    """Actions with the value of their message; ``has_msg`` tells whether there is one."""
    side = messages.select("tx_id", "msg_index", "msg_value", F.lit(True).alias("has_msg"))
    return actions.join(side, ["tx_id", "msg_index"], "left")
