"""Coin strings such as ``12uluna`` and raw integer amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(coin: Column) -> Column:
    return F.regexp_extract(coin, r"([0-9]+)", 1)


def coin_amount(coin: Column) -> Column:
    """The first run of digits as a whole number; null where there is none."""
    return F.nullif(_digits(coin), F.lit("")).try_cast("decimal(38,0)")


def coin_denom(coin: Column) -> Column:
    """What remains right of as many characters as the amount has; later coins of a list stay in the text."""
    return F.substring(coin, F.length(_digits(coin)) + 1, F.length(coin))


def denom_cut(coin: Column, native: str = "uluna") -> tuple[Column, Column]:
    """(amount, currency) of one coin of a staking amount; pool and ibc denoms are cut at their first letter."""
    at_g, at_i = F.instr(coin, "g"), F.instr(coin, "i")
    is_native, is_pool, is_ibc = coin.endswith(native), coin.contains("pool"), coin.contains("ibc")
    amount = (
        F.when(is_native, F.replace(coin, F.lit(native), F.lit("")))
        .when(is_pool, F.substring(coin, F.lit(1), at_g - 1))
        .when(is_ibc, F.substring(coin, F.lit(1), at_i - 1))
        .otherwise(coin)
    )
    currency = (
        F.when(is_native, F.lit(native))
        .when(is_pool, F.substring(coin, at_g, F.length(coin)))
        .when(is_ibc, F.substring(coin, at_i, F.length(coin)))
        .otherwise(F.lit(native))
    )
    return amount.try_cast("decimal(38,0)"), currency


def scaled(amount: Column, decimals: int = 6) -> Column:
    """Raw units to tokens; the division is in DOUBLE and comes last."""
    return amount.cast("double") / F.lit(float(10**decimals))
