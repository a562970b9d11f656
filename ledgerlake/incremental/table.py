"""Keyed Parquet tables with upserts, without a table format.

The table is partitioned by ``_part``. A batch rewrites only the partitions it touches, through Spark's dynamic
partition overwrite: new files are staged and moved in when the job commits, so a lost executor or a failed task
leaves the old files in place. With an event date as partition, a daily batch touches a day or two, whatever the
size of the table.

An upsert is not atomic: partitions move in one by one, and partitions that the batch emptied go last. A driver that is
lost in between leaves some of them old; running the same batch again ends in the same table as a run without failure
(for rows whose keys are not null).

Keys compare as in SQL: a row with a null in its key matches nothing, so it is always inserted.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.joins import sorted_side
from ledgerlake.session import CODEC, discard, new_folder, whole_variants, write_whole

PART = "_part"


def part_name(value: str) -> str:
    """Name of the partition of a value; the leading letter keeps names text, whatever they are made of."""
    return f"p{value}"


@dataclass(frozen=True)
class Upserted:
    """Partitions that an upsert wrote or emptied, and the newest load time of its batch."""

    parts: frozenset[str]
    newest: Any = None


class KeyedTable:
    """``keys`` identify a row; ``part`` is an expression over the row (a date, an id range, a key hash).

    ``moves`` says whether a key's partition may change between batches. Where it never does (a hash of the key, the
    time of a block), an upsert reads the partitions of its batch and nothing else; otherwise it first reads the key
    columns of the whole table to find old versions.

    ``cluster`` names numbers or times by which rows lie together inside a partition, so that a selective read skips row
    groups; several columns are interleaved, so that each of them helps.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], part: Column, moves: bool = True, cluster: Sequence[str] = ()):
        self.spark, self.path, self.keys, self.part, self.moves, self.cluster = spark, path, list(keys), part, moves, list(cluster)

    # ---- reading

    def _stored(self) -> DataFrame | None:
        """None where no partition was ever written; a table that cannot be read is an error."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{PART}=*")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return self.spark.read.option("mergeSchema", "true").parquet(self.path) if found else None

    def read(self, parts: Sequence[str] | None = None, first: str | None = None) -> DataFrame | None:
        """The table, or some of its partitions: those named, or those whose names do not sort before ``first``."""
        stored = self._stored()
        if stored is None:
            return None
        if parts is not None:
            stored = stored.where(F.col(PART).isin(list(parts)))
        if first is not None:
            stored = stored.where(F.col(PART) >= first)
        return stored.drop(PART)

    # ---- writing

    def append(self, batch: DataFrame) -> None:
        self._write(self._placed(batch), "append")

    def overwrite(self, batch: DataFrame) -> None:
        self._write(self._placed(batch), "overwrite", "static")

    def delete_insert(self, batch: DataFrame) -> Upserted:
        """Delete the stored rows whose key is in the batch, then insert the batch; its own duplicates survive."""
        return self.upsert(batch, "delete_insert")

    def merge(self, batch: DataFrame, keep: Sequence[str] = ()) -> Upserted:
        """Update matched rows and insert new ones; columns in ``keep`` hold their first value.

        A key that occurs twice in the batch is an error, as it is in SQL's MERGE.
        """
        return self.upsert(batch, "merge", keep)

    def upsert(self, batch: DataFrame, strategy: str, keep: Sequence[str] = (), loaded: str | None = None) -> Upserted:
        """``merge`` or ``delete_insert``; says which partitions changed and, with ``loaded``, the batch's newest value there."""
        with self._staged(batch) as staged:
            found = staged.groupBy(PART).agg((F.max(loaded) if loaded else F.lit(None)).alias("newest")).collect()
            newest = max((r.newest for r in found if r.newest is not None), default=None)
            if strategy == "merge":
                twice = staged.dropna(subset=self.keys).groupBy(*self.keys).count().where(F.col("count") > 1).take(1)
                if twice:
                    raise ValueError(f"duplicate merge key in batch: {twice[0]}")
            return Upserted(self._upsert(staged, {r[PART] for r in found}, keep if strategy == "merge" else ()), newest)

    def delete_where(self, condition: Column) -> None:
        """Remove rows after an upsert, e.g. soft-deleted ones; only partitions that hold such rows are rewritten."""
        stored = self._stored()
        if stored is None:
            return
        touched = self._parts(stored.where(condition))
        kept = stored.where(F.col(PART).isin(touched)).where(~F.coalesce(condition, F.lit(False)))
        remaining = self._parts(kept)
        if remaining:
            self._write(kept, "overwrite")
        self._remove(set(touched) - set(remaining))

    def remove(self, gone: DataFrame) -> None:
        """Remove the rows whose keys are in ``gone``, each from the partition that its row in ``gone`` belongs to."""
        stored = self._stored()
        if stored is None:
            return
        with self._staged(gone) as staged:
            touched = self._parts(staged)
            inside = stored.where(F.col(PART).isin(touched)).alias("s")
            here = self._same_key("s", "b") & (F.col(f"s.{PART}") == F.col(f"b.{PART}"))
            kept = inside.join(sorted_side(staged.select(*self.keys, PART)).alias("b"), here, "left_anti")
            remaining = self._parts(kept)
            if remaining:
                self._write(kept, "overwrite")
            self._remove(set(touched) - set(remaining))

    # ---- internals

    @contextmanager
    def _staged(self, batch: DataFrame):
        """The batch, written once in the shared folder for the time of its upsert."""
        path = new_folder(self.spark, "batch")
        placed = self._placed(batch)
        write_whole(placed, path)
        try:
            yield self.spark.read.schema(placed.schema).parquet(path)
        finally:
            discard(self.spark, path)

    def _placed(self, batch: DataFrame) -> DataFrame:
        return batch.withColumn(PART, F.concat(F.lit(part_name("")), F.coalesce(self.part.cast("string"), F.lit("-"))))

    def _parts(self, df: DataFrame) -> list[str]:
        """Distinct partition names: dates or buckets, never row keys, so the list stays small."""
        return [row[0] for row in df.select(PART).distinct().collect()]

    def _same_key(self, left: str, right: str) -> Column:
        same = None
        for key in self.keys:
            part = F.col(f"{left}.{key}") == F.col(f"{right}.{key}")
            same = part if same is None else same & part
        return same

    def _upsert(self, staged: DataFrame, new_parts: set[str], keep: Sequence[str] = ()) -> frozenset[str]:
        stored = self._stored()
        if stored is None or not new_parts:
            if new_parts:
                self._write(staged, "overwrite")
            return frozenset(new_parts)
        batch_keys = sorted_side(staged.select(*self.keys))
        old_parts = new_parts
        if self.moves:
            matched = stored.select(*self.keys, PART).alias("s")
            old_parts = set(self._parts(matched.join(batch_keys.alias("b"), self._same_key("s", "b"), "left_semi")))
        old = stored.where(F.col(PART).isin(sorted(old_parts | new_parts)))
        if keep:
            first = stored.where(F.col(PART).isin(sorted(old_parts))).select(*self.keys, *keep, F.lit(True).alias("_met"))
            joined = staged.alias("s").join(sorted_side(first).alias("o"), self._same_key("s", "o"), "left")
            staged = joined.select(
                *[
                    F.when(F.col("o._met"), F.col(f"o.{c}")).otherwise(F.col(f"s.{c}")).alias(c) if c in keep else F.col(f"s.{c}")
                    for c in staged.columns
                ]
            )
        rest = old.alias("s").join(batch_keys.alias("b"), self._same_key("s", "b"), "left_anti")
        left_behind = old_parts - new_parts
        if left_behind:
            left_behind -= set(self._parts(rest.where(F.col(PART).isin(sorted(left_behind)))))
        self._write(rest.unionByName(staged, allowMissingColumns=True), "overwrite")
        self._remove(left_behind)
        return frozenset(old_parts | new_parts)

    def _write(self, rows: DataFrame, mode: str, partitions: str = "dynamic") -> None:
        """A rebalance spreads a heavy partition over several tasks and files; rows are sorted inside each."""
        rows = rows.hint("rebalance", PART)
        if len(self.cluster) == 1:
            rows = rows.sortWithinPartitions(PART, *self.cluster)
        elif self.cluster:
            rows = interleaved(rows, self.cluster)
        writer = rows.write.mode(mode).partitionBy(PART).option("compression", CODEC)
        with whole_variants(rows):
            writer.option("partitionOverwriteMode", partitions).parquet(self.path)

    def _remove(self, parts) -> None:
        """Drop partitions that no longer hold a row (an overwrite leaves partitions without new rows alone)."""
        for part in parts:
            discard(self.spark, f"{self.path}/{PART}={part}")


CLUSTER_BITS = 4


def _number(rows: DataFrame, column: str) -> Column:
    timed = dict(rows.dtypes)[column] in ("timestamp_ntz", "timestamp", "date")
    return (F.unix_micros(F.col(column).cast("timestamp")) if timed else F.col(column)).cast("double")


def interleaved(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` sorted inside each task by a number whose bits come from the columns in turn, so that rows near to each
    other in all of them lie together.

    Each column counts by its place between quantiles of ``rows``, so that a skewed one divides them evenly, too; nulls
    come first.
    """
    shares = [i / (1 << CLUSTER_BITS) for i in range(1, 1 << CLUSTER_BITS)]
    cuts = rows.agg(*[F.percentile_approx(_number(rows, c), shares, 1000).alias(c) for c in columns]).first()
    names = [f"_place_{i}" for i in range(len(columns))]
    places = [sum((F.coalesce(_number(rows, c) >= cut, F.lit(False)).cast("int") for cut in sorted(set(cuts[c] or []))), F.lit(0)) for c in columns]
    placed = rows.withColumns(dict(zip(names, places, strict=True)))
    bits = [F.shiftleft(F.shiftright(n, b).bitwiseAND(1), b * len(names) + i) for i, n in enumerate(names) for b in range(CLUSTER_BITS)]
    return placed.sortWithinPartitions(PART, reduce(lambda a, b: a.bitwiseOR(b), bits), *columns).drop(*names)


def hash_part(buckets: int, *keys: str) -> Column:
    """A partition that depends on the key alone, for tables without a date."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def date_part(column: str) -> Column:
    return F.to_date(column)
