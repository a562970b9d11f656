"""Oracle and market prices of the predecessor chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import varray, vdouble, vstr, vvar
from ledgerlake.operators.enrich import labelled
from ledgerlake.operators.ordered import carry_forward
from ledgerlake.plans.classic_silver import SUCCEEDED

# Market assets, token contracts and the symbol published for each oracle denom.
NATIVE_ASSET = "4172"
TOKEN_ASSETS = ["7857", "8857"]
MINE_ASSETS = ["pylon-protocol", "10767"]
MINE_TOKEN = "terra1kcthelkax4j9x8d3ny6sdag0qmxxynl3qtcrpy"
TOKEN_CONTRACTS = {
    "MIR": "terra15gwkyepfc6xgca5t5zefzwy42uts8l2m4g40k6",
    "ANC": "terra14z56l0fp2lsf86zy3hty2z47ezkhnthtr9yq76",
}
EIGHT_DECIMAL_TOKEN = "terra1z3e2e4jpk4n0xzzwlkgcfvc95pc5ldq0xcny58"
SYMBOLS = {
    "usgd": "SGT", "uusd": "UST", "ukrw": "KRT", "unok": "NOT", "ucny": "CNT", "uinr": "INT", "ueur": "EUT",
    "udkk": "DKT", "uhkd": "HKT", "usek": "SET", "uthb": "THT", "umnt": "MNT", "ucad": "CAT", "ugbp": "GBT",
    "ujpy": "JPT", "usdr": "SDT", "uchf": "CHT", "uaud": "AUT", "uidr": "IDT", "uphp": "PHT", "utwd": "TWT",
    "umyr": "MYT",
}


def symbol_of(currency: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SYMBOLS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, currency), currency)


def _trunc(unit: str, column: str) -> Column:
    return F.date_trunc(unit, F.col(column)).cast("timestamp_ntz")


def _market(legacy: DataFrame, which: Column) -> DataFrame:
    return legacy.where(which).groupBy(
        _trunc("hour", "recorded_at").alias("block_timestamp"), F.col("symbol").alias("currency")
    ).agg(F.avg("price").alias("price"))


def dim_oracle_prices(
    legacy: DataFrame, transitions: DataFrame, messages: DataFrame, labels: DataFrame
) -> DataFrame:
    """Five price origins under one schema; ``labels`` are the published labels.

    An oracle row takes the native price of its hour, or the last one its symbol has seen.
    """
    native = _market(legacy, (F.col("asset_id") == NATIVE_ASSET) & F.col("provider").isNotNull())
    tokens = _market(legacy, F.col("asset_id").isin(TOKEN_ASSETS))
    native_at = native.select(F.col("block_timestamp").alias("_hour"), F.col("price").alias("native_price"))

    def at_hour(df: DataFrame) -> DataFrame:
        return df.withColumn("_hour", _trunc("hour", "block_timestamp")).join(native_at, "_hour", "left")

    def shaped(df: DataFrame, blockchain: Column, symbol: Column, rate: Column, price: Column, source: str) -> DataFrame:
        return df.select(
            blockchain.alias("blockchain"), "block_timestamp", F.col("currency"), symbol.alias("symbol"),
            rate.cast("double").alias("luna_exchange_rate"), price.alias("price_usd"), F.lit(source).alias("source"),
        )

    terra = F.lit("terra")
    rates = transitions.where(F.col("event") == "exchange_rate_update").select(
        "blockchain", "block_timestamp", "block_id",
        F.replace(vstr("event_attributes", "denom"), F.lit('"'), F.lit("")).alias("currency"),
        vdouble("event_attributes", "exchange_rate").alias("rate"),
    ).withColumn("symbol", symbol_of(F.col("currency")))
    quoted = carry_forward(
        at_hour(rates), ["symbol"], ["block_timestamp", "block_id", "currency"], _trunc("day", "block_timestamp"),
        F.col("native_price"), "known_price",
    )
    oracle = shaped(
        quoted, F.col("blockchain"), F.col("symbol"), F.col("rate"), F.try_divide("known_price", "rate"), "oracle"
    )
    own = shaped(
        native.withColumn("currency", F.lit("uluna")), terra, F.lit("LUNA"), F.lit(1.0), F.col("price"), "coinmarketcap"
    )
    contracts = F.create_map(*[F.lit(x) for pair in TOKEN_CONTRACTS.items() for x in pair])
    token_rows = at_hour(tokens).withColumn("ticker", F.col("currency")).withColumn(
        "currency", F.try_element_at(contracts, "currency")
    )
    token = shaped(
        token_rows, terra, F.col("ticker"), F.try_divide("native_price", "price"), F.col("price"), "coinmarketcap"
    )
    feeds = messages.where(
        vvar("msg_value", "execute_msg.feed_price").isNotNull() & (F.col("tx_status") == SUCCEEDED)
    ).select(
        "blockchain", _trunc("hour", "block_timestamp").alias("block_timestamp"),
        F.explode(varray("msg_value", "execute_msg.feed_price.prices")).alias("quote"),
    )
    fed = feeds.groupBy("blockchain", "block_timestamp", vstr("quote", "[0]").alias("currency")).agg(
        F.avg(vdouble("quote", "[1]")).alias("fed_price")
    )
    unit = F.when(F.col("currency") == EIGHT_DECIMAL_TOKEN, F.col("fed_price") * 100.0).otherwise(F.col("fed_price"))
    fed = labelled(at_hour(fed.withColumn("price", unit)), labels, F.col("currency"), {"address_name": "label_name"})
    contract = shaped(
        fed, F.col("blockchain"), F.col("label_name"), F.try_divide("native_price", "price"), F.col("price"), "oracle"
    )
    mined = legacy.where(F.col("asset_id").isin(MINE_ASSETS)).groupBy(
        _trunc("minute", "recorded_at").alias("block_timestamp"), "symbol"
    ).agg(F.avg("price").alias("price"))
    mine = shaped(
        at_hour(mined.withColumn("currency", F.lit(MINE_TOKEN))), terra, F.col("symbol"),
        F.try_divide("native_price", "price"), F.col("price"), "coinmarketcap",
    )
    out = oracle
    for part in (own, token, contract, mine):
        out = out.unionByName(part)
    return out.distinct()
