"""An hourly table that a stream publishes hour by hour, with late rows routed to a repair instead of dropped.

A watermark drops what comes behind it. Here every row lands in a table by its key. An hour is published once the newest
time seen is ``late`` past its end; rows that come after that put their hour on a list, and ``repair`` computes the
listed hours again from all their landed rows. A stream and its repair therefore end in the table of a full build.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.incremental.table import KeyedTable, part_name
from ledgerlake.operators.ordered import time_chunk
from ledgerlake.session import discard, new_folder


_START = {"day": lambda d: d, "month": lambda d: d.replace(day=1), "year": lambda d: d.replace(month=1, day=1)}


class ClosedHours:
    """``aggregate`` turns rows with a column ``hour`` into one row per hour; ``keys`` identify a row, whose ``time`` never changes.

    Rows with equal keys count once (they are taken for exact re-sends); rows without a key or a time are left out. Each
    step can be done again after a lost driver: landing and publishing are keyed, the mark is moved last and hours leave
    the list after their repair. ``run`` and ``repair`` must not overlap. Tables are partitioned by ``part``: day, month or year.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], time: str,
        aggregate: Callable[[DataFrame], DataFrame], late: timedelta, part: str = "day",
    ):
        self.spark, self.path, self.keys, self.time, self.aggregate, self.late, self.part = spark, path, list(keys), time, aggregate, late, part
        self.landed = KeyedTable(spark, f"{path}/landed", self.keys, self._part(time), moves=False)
        self.published = KeyedTable(spark, f"{path}/published", ["hour"], self._part("hour"), moves=False)
        self.listed = KeyedTable(spark, f"{path}/late", ["hour"], self._part("hour"), moves=False)
        self._marks = KeyedTable(spark, f"{path}/mark", ["name"], F.lit("mark"), moves=False)

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take everything that has arrived, then stop."""
        query = (
            source.writeStream.foreachBatch(lambda batch, _batch_id: self.take(batch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def take(self, batch: DataFrame) -> None:
        """Land one batch, list the published hours it touches and publish the hours that it closes.

        The batch is written once in the shared folder, so that its source is read once and the steps run under the
        settings of the table's session (a stream's own session plans without runtime statistics).
        """
        path = new_folder(self.spark, "arrived")
        batch.write.parquet(path)
        try:
            self._take(self.spark.read.schema(batch.schema).parquet(path))
        finally:
            discard(self.spark, path)

    def repair(self) -> None:
        """Compute the listed hours again; the partitions that hold them are read, and nothing else."""
        late = self.listed.read()
        if late is None:
            return
        parts = [part_name(row[0]) for row in late.select(self._part("hour").cast("string")).distinct().collect()]
        if not parts:
            return
        rows = self.landed.read(parts).withColumn("hour", self._hour())
        self.published.delete_insert(self.aggregate(rows.join(late, "hour", "left_semi")))
        self.listed.remove(late)

    def mark(self) -> datetime | None:
        """Hours before this time are published."""
        stored = self._marks.read()
        return None if stored is None else stored.first()["until"]

    # ---- internals

    def _take(self, batch: DataFrame) -> None:
        rows = batch.dropna(subset=[*self.keys, self.time]).dropDuplicates(self.keys)
        newest = rows.agg(F.max(self.time).cast("timestamp_ntz")).first()[0]
        if newest is None:
            return
        old = self.mark()
        if old is not None:
            behind = rows.where(F.col(self.time) < F.lit(old)).select(self._hour().alias("hour")).distinct()
            self.listed.merge(behind)
        self.landed.merge(rows)
        reached = (newest - self.late).replace(minute=0, second=0, microsecond=0)
        if old is None or reached > old:
            self._publish(old, reached)
            self._marks.merge(self.spark.createDataFrame([("published", reached)], "name string, until timestamp_ntz"))

    def _part(self, column: str) -> Column:
        return F.to_date(F.date_trunc(self.part, column))

    def _hour(self) -> Column:
        return time_chunk(F.col(self.time))

    def _publish(self, old: datetime | None, reached: datetime) -> None:
        at = F.col(self.time)
        rows = self.landed.read(first=None if old is None else part_name(_START[self.part](old.date()).isoformat()))
        inside = at < F.lit(reached) if old is None else (at >= F.lit(old)) & (at < F.lit(reached))
        self.published.delete_insert(self.aggregate(rows.where(inside).withColumn("hour", self._hour())))
