"""Connected components of links by alternating stars (large-star, small-star), each a grouped minimum and a join."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import settle


class Roots:
    """Disjoint sets; the smallest member is the root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up.get(x, root)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _stars_of_part(batches):
    """The links of one task as stars: the same components, at most one row for each end."""
    roots = Roots()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            roots.join(a, b)
    ends = [x for x in roots.up if roots.find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array([roots.find(x) for x in ends], pa.int64())], names=["a", "b"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in links (a, b long); component is the smallest id that links reach.

    Repeated and reversed links and self-links are allowed; no links give no rows. Every round ends in a written table,
    so a lost executor costs one round. A hub's links are moved by joins, which Spark can split, never gathered.
    """
    now = settle(links.where("a != b").mapInArrow(_stars_of_part, "a long, b long"), "links")
    mark = None
    while True:
        now = settle(_small_star(_large_star(now)), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    # a star for each component
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
