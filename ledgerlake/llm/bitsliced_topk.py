"""Exact top-k search on a bit-sliced index.

Components are quantised to whole numbers. The rows of a block are stored by component and bit: one bitmap for each of
the highest bits of each component. A query's scores are the sum of its components times the rows' components: bitmaps
shifted by the set bits of the query's component, added by carry-save adders over whole bitmaps (for a negative
component the complement is added). From the most significant slice of the sum downward the best rows are chosen. The
bits that have no slice bound the error, and all rows that it leaves in doubt are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlake.llm.shared import deals, ready, settle

BLOCK, QUERIES = 32_768, 256  # rows of a block of the index; queries that meet it at once
SLICES = 6  # highest bits of a component that have slices
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"

INDEX = "dims int, block long, low long, slices binary, ids binary, rows binary, lows binary"


def _index(batches):
    """One row for each block from rows (dims, block, vec_id, q) that are sorted by block."""
    now, held = None, []

    def done():
        dims, block = now
        ids = np.array([i for i, _ in held], "<i8")
        rows = np.array([q for _, q in held], "<i8").reshape(len(held), dims)
        lows = rows.min(axis=0)
        above = rows - lows
        low = max(0, int(above.max(initial=0)).bit_length() - SLICES)
        width = -(-len(ids) // 64) * 64
        planes = np.zeros((dims, SLICES, width), np.uint8)
        for bit in range(SLICES):
            planes[:, bit, : len(ids)] = ((above >> (low + bit)) & 1).T
        slices = np.packbits(planes, axis=2, bitorder="little")
        values = (dims, block, low, slices.tobytes(), ids.tobytes(), rows.tobytes(), lows.astype("<i8").tobytes())
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[p.split()[0] for p in INDEX.split(", ")])

    for batch in batches:
        for dims, block, vec, q in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (dims, block) != now and held:
                yield done()
                held = []
            now = (dims, block)
            held.append((vec, q))
    if held:
        yield done()


def added(weighted: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum; ``weighted[p]`` are the bitmaps that count 2 ** p."""
    out, at = [], 0
    while at < len(weighted):
        line = weighted[at]
        if at + 1 == len(weighted) and len(line) > 1:
            weighted.append([])
        while len(line) > 1:
            if len(line) > 2:
                a, b, c = line.pop(), line.pop(), line.pop()
                half = a ^ b
                line.insert(0, half ^ c)
                weighted[at + 1].append((a & b) | (half & c))
            else:
                a, b = line.pop(), line.pop()
                line.append(a ^ b)
                weighted[at + 1].append(a & b)
        out.append(line[0] if line else None)
        at += 1
    return out


def kth_value(slices: list[np.ndarray], alive: np.ndarray, k: int) -> int:
    """The k-th largest sum among the rows alive, by halving from the most significant slice; the least, if they are fewer."""
    tied, above, value = alive, 0, 0
    for bit in range(len(slices) - 1, -1, -1):
        ones = tied & slices[bit]
        count = int(np.bitwise_count(ones).sum())
        if above + count >= k:
            tied, value = ones, value | (1 << bit)
        else:
            above += count
            tied = tied & ~slices[bit]
    return value


def at_least(slices: list[np.ndarray], alive: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows alive whose sum is ``value`` or more."""
    if value <= 0:
        return alive
    if value.bit_length() > len(slices):
        return np.zeros_like(alive)
    more, tied = np.zeros_like(alive), alive
    for bit in range(len(slices) - 1, -1, -1):
        if value >> bit & 1:
            tied = tied & slices[bit]
        else:
            more = more | (tied & slices[bit])
            tied = tied & ~slices[bit]
    return more | tied


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, dims: int, low: int, slices: bytes, ids: bytes, rows: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.rows = np.frombuffer(rows, "<i8").reshape(len(self.ids), dims)
        self.maps = np.frombuffer(slices, np.uint8).reshape(dims, SLICES, -(-len(self.ids) // 64) * 8).view(np.uint64)
        self.low = low
        alive = np.zeros(self.maps.shape[2] * 64, np.uint8)
        alive[: len(self.ids)] = 1
        self.alive = np.packbits(alive, bitorder="little").view(np.uint64)

    def search(self, vec: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The block's k best (vec_id, score) for a query, itself left out."""
        pick = np.arange(len(self.ids))
        if len(self.ids) > 4 * k:
            weighted: list[list[np.ndarray]] = [[] for _ in range(SLICES + int(np.abs(q).max(initial=0)).bit_length() + 1)]
            for d, value in enumerate(q.tolist()):
                size, bit = abs(value), 0
                maps = self.maps[d] if value > 0 else ~self.maps[d]
                while size:
                    if size & 1:
                        for s in range(SLICES):
                            weighted[s + bit].append(maps[s])
                    size >>= 1
                    bit += 1
            slices = [np.zeros_like(self.alive) if s is None else s for s in added(weighted)]
            # the unsliced bits of all components add up to less than one unit for each unit of the query
            doubt = int(np.abs(q).sum()) if self.low else 0
            found = at_least(slices, self.alive, kth_value(slices, self.alive, k + 1) - doubt)
            pick = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little", count=len(self.ids)))
        scores = self.rows[pick] @ q
        ids = self.ids[pick]
        order = np.lexsort((ids, -scores))
        best = [(int(ids[i]), int(scores[i])) for i in order[: k + 1]]
        return [b for b in best if b[0] != vec][:k]


MEET = ["place", "turn", "dims", "part", "low", "slices", "ids", "rows", "query_ids", "queries"]


def _searched(k: int):
    """From rows sorted by block: a block (part -1), then the query parts that are dealt to it. One block is held."""

    def run(batches):
        at, block = None, None
        for batch in batches:
            for place, turn, dims, part, low, slices, ids, rows, query_ids, queries in zip(*[batch.column(c).to_pylist() for c in MEET], strict=True):
                if part < 0:
                    at, block = (place, turn, dims), Block(dims, low, slices, ids, rows)
                    continue
                if at != (place, turn, dims):  # no vector of this length lies in the block
                    continue
                wanted = np.frombuffer(query_ids, "<i8").tolist()
                out = [(vec, *hit) for vec, q in zip(wanted, np.frombuffer(queries, "<i8").reshape(len(wanted), dims), strict=True) for hit in block.search(vec, q, k)]
                columns = list(zip(*out, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def _query_blocks(batches):
    """Queries packed by (dims, part), from rows sorted by them."""
    now, held = None, []

    def done():
        values = (*now, np.array([i for i, _ in held], "<i8").tobytes(), np.array([q for _, q in held], "<i8").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["dims", "part", "query_ids", "queries"])

    for batch in batches:
        for dims, part, vec, q in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (dims, part) != now and held:
                yield done()
                held = []
            now = (dims, part)
            held.append((vec, q))
    if held:
        yield done()


def top_scores(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best of all other rows for each row whose id ``every`` divides.

    Scores are inner products of floor(scale * component), ties go to the smaller id. Vectors that are null or hold null
    or non-finite components take no part; vectors of different lengths do not meet; zero vectors and vectors without
    components score 0. Rows without an id are left out; of rows with one id one counts. Other columns are not read. An
    empty table gives no rows. Quantised components must fit 31 bits, scores 63.
    """
    spark = vectors.sparkSession
    ready(spark, 2000)
    v = F.col(embedding).cast("array<double>")
    rows = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).dropDuplicates(["vec_id"])
    rows = rows.where("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = settle(rows.select("vec_id", F.size("v").alias("dims"), F.expr(f"transform(v, x -> cast(floor({scale} * x) as long))").alias("q")), "search-rows")
    total = rows.count()
    blocks, parts = max(1, -(-total // BLOCK)), max(1, -(-total // (every * QUERIES)))
    spread = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).repartition(blocks, "dims", "block").sortWithinPartitions("dims", "block", "vec_id")
    index = settle(spread.select("dims", "block", "vec_id", "q").mapInArrow(_index, INDEX), "search-index")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(parts)))
    asked = asked.repartition(parts, "dims", "part").sortWithinPartitions("dims", "part", "vec_id").select("dims", "part", "vec_id", "q")
    asked = settle(asked.mapInArrow(_query_blocks, "dims int, part long, query_ids binary, queries binary"), "search-queries")
    # every part of the queries goes to every block; where blocks are few, each is dealt out several times
    turns = max(1, min(parts, -(-deals(spark) // blocks)))
    nothing = F.lit(None)
    held = index.select(
        F.col("block").cast("long").alias("place"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"), "dims",
        F.lit(-1).cast("long").alias("part"), "low", "slices", "ids", "rows", nothing.cast("binary").alias("query_ids"), nothing.cast("binary").alias("queries"),
    )
    kinds = {f.name: f.dataType for f in index.schema.fields}
    sent = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("place"), F.pmod("part", F.lit(turns)).alias("turn"), "dims", "part",
        *[nothing.cast(kinds[c]).alias(c) for c in ("low", "slices", "ids", "rows")], "query_ids", "queries",
    )
    together = held.unionByName(sent).repartition(2 * blocks * turns, "place", "turn").sortWithinPartitions("place", "turn", "dims", "part")
    before = spark.conf.get(ROWS_AT_ONCE)
    spark.conf.set(ROWS_AT_ONCE, "4")  # rows are whole blocks here
    hits = settle(together.select(*MEET).mapInArrow(_searched(k), "query_id long, vec_id long, score long"), "search-hits")
    spark.conf.set(ROWS_AT_ONCE, before)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", F.col("rank").cast("int"), "vec_id", "score")
