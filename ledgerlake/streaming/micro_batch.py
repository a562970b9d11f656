"""Streams that reuse the batch functions.

New files are found by the stream's checkpoint, each micro-batch goes through the same transformation and the same
upsert as a batch run. A replayed micro-batch changes nothing, because the upsert is keyed; rows whose key holds a null
match nothing and would be inserted again.

``hourly_counts`` and ``matched_packets`` drop rows that come later than their watermark. They are early views: the
batch tables (``chain_stats``, ``chain_silver.transfers_ibc``), rebuilt over a lookback, are the ones that count such rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.incremental.table import KeyedTable


def run_available(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], table: KeyedTable, checkpoint: str,
    strategy: str = "merge", keep: tuple[str, ...] = (),
) -> None:
    """Process everything that has arrived, then stop. Run it on a schedule or in a loop."""

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        rows = transform(batch)
        if strategy == "merge":
            table.merge(rows, keep)
        elif strategy == "delete+insert":
            table.delete_insert(rows)
        else:
            table.append(rows)

    query = (
        source.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def hourly_counts(stream: DataFrame, time: str, late: str = "3 days") -> DataFrame:
    """Rows per closed hour: an hour is emitted once the watermark has passed it, the open hour never.

    Exact distinct counts stay in the batch tables; a stream cannot keep them in bounded state.
    """
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("hour"), "n")
    )


def matched_packets(sent: DataFrame, acknowledged: DataFrame, keys: list[str], time: str, late: str = "2 days"):
    """Send packets with an acknowledgement up to ``late`` after them; state older than that is dropped.

    Both streams carry ``time``. Duplicate acknowledgements inside the bound are dropped before the join.
    """
    left = sent.withWatermark(time, late)
    right = acknowledged.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(time).alias("_ack_time")
    ).withWatermark("_ack_time", late).dropDuplicatesWithinWatermark([f"_{k}" for k in keys])
    same = F.expr(f"_ack_time >= {time} AND _ack_time <= {time} + interval {late}")
    for key in keys:
        same = same & (F.col(key) == F.col(f"_{key}"))
    return left.join(right, same).drop(*[f"_{k}" for k in keys], "_ack_time")
