"""Price and label enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import lookup

# Fixed value: the chain name stored in the label table.
CHAIN = "terra"


def hourly_prices(prices: DataFrame) -> DataFrame:
    """Average price per hour, currency and symbol; two symbols of one currency stay two rows."""
    hour = F.date_trunc("hour", "block_timestamp").cast("timestamp_ntz")
    return prices.groupBy(hour.alias("hour"), "currency", "symbol").agg(F.avg("price_usd").alias("price"))


def priced(df: DataFrame, hourly: DataFrame, currency: Column, take: dict[str, str], ts: str = "block_timestamp"):
    """Left join the hourly price of ``currency`` at the row's hour."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    return lookup(df, hourly, {"hour": hour, "currency": currency}, take)


def published_labels(labels: DataFrame, creator: str | None) -> DataFrame:
    """Labels of this chain, of one curator if a curator is named."""
    own = labels.where(F.col("blockchain") == CHAIN)
    return own if creator is None else own.where(F.col("creator") == creator)


def labelled(df: DataFrame, labels: DataFrame, address: Column, take: dict[str, str]) -> DataFrame:
    """Left join label columns by address; ``labels`` comes from :func:`published_labels`."""
    return lookup(df, labels, {"address": address}, take)


def label_columns(prefix: str, label: str | None = None, name_from: str = "address_name") -> dict[str, str]:
    """The four published label columns of one address role.

    Some tables fill ``*_address_name`` from the address itself (``name_from="address"``).
    """
    return {
        "l1_label": f"{prefix}_label_type",
        "l2_label": f"{prefix}_label_subtype",
        "project_name": label or f"{prefix}_address_label",
        name_from: f"{prefix}_address_name",
    }
