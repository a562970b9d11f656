"""Checks of one table in one scan, with their violations stored.

Row checks are conditions on a row. All of them are evaluated while the table is read once, and a row that fails any is
written to the partition of each check it fails. Checks on groups (uniqueness, gaps) are stored beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECK = "_check"


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, values: Sequence) -> Column:
    """Values that are not in the list; nulls pass."""
    return ~F.col(column).isin(list(values))


def unlike(column: str, pattern: str) -> Column:
    """Values without a match; nulls pass."""
    return ~F.col(column).rlike(pattern)


@dataclass(frozen=True)
class CheckPlan:
    """``rows``: check -> (severity, condition that a violating row meets); ``groups``: check -> (severity, function of the
    table that gives its violations). Where a condition is null the row passes."""

    rows: dict[str, tuple[str, Column]]
    groups: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)

    def violations(self, df: DataFrame) -> DataFrame:
        """Each violating row once for each check it fails, named in ``_check``; one pass over ``df``."""
        failed = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, (_, condition) in self.rows.items()]))
        return df.withColumn("_failed", failed).where(F.size("_failed") > 0).withColumn(CHECK, F.explode("_failed")).drop("_failed")

    def run(self, df: DataFrame, folder: str) -> DataFrame:
        """Stores all violations in ``folder``, in place of those of an earlier run, and gives (check, severity, violations)."""
        if self.rows:
            self.violations(df).hint("rebalance", CHECK).write.mode("overwrite").partitionBy(CHECK).parquet(f"{folder}/rows")
        for name, (_, found) in self.groups.items():
            found(df).write.mode("overwrite").parquet(f"{folder}/groups/{name}")
        spark, counts = df.sparkSession, []
        if self.rows:
            schema = df.withColumn(CHECK, F.lit("")).schema
            counts.append(spark.read.schema(schema).parquet(f"{folder}/rows").groupBy(F.col(CHECK).alias("check")).agg(F.count(F.lit(1)).alias("n")))
        counts += [spark.read.parquet(f"{folder}/groups/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n") for name in self.groups]
        known = spark.createDataFrame([(name, severity) for name, (severity, _) in (self.rows | self.groups).items()], "check string, severity string")
        found = counts[0]
        for more in counts[1:]:
            found = found.unionByName(more)
        return known.join(found, "check", "left").select("check", "severity", F.coalesce("n", F.lit(0)).alias("violations"))

    def stored(self, spark: SparkSession, folder: str, name: str, like: DataFrame) -> DataFrame:
        """The violations of one check as stored, from its own files; ``like`` has the checked table's columns."""
        if name in self.groups:
            return spark.read.parquet(f"{folder}/groups/{name}")
        schema = like.withColumn(CHECK, F.lit("")).schema
        return spark.read.schema(schema).parquet(f"{folder}/rows").where(F.col(CHECK) == name).drop(CHECK)
