"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one representative a group.

A vector's home is the cell of its nearest centre. Two vectors may be similar although their homes differ, so a vector is
also sent to each later cell whose border lies within the angle of the threshold: let ``u`` be the unit vector from the
other cell's centre to the home centre; if x.u exceeds the sine of that angle, no vector of the other cell is near
enough. So no link is lost, whatever the centres are. Cells are cut into blocks, and pairs of blocks are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.links import Roots, components
from ledgerlake.llm.shared import ready, settle

SAMPLE = 20_000  # vectors that the centres are fitted on, chosen by hash
CELL, CELLS = 8192, 1024  # vectors for which there is one more centre; centres at most
BLOCK = 2048  # vectors of a cell that are compared at once with as many others
ROUNDS = 12


def usable(vector: str) -> str:
    """SQL: the vector is neither null nor zero nor holds null or non-finite components."""
    return f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists({vector}, x -> x != 0)"


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _fit(cells: int):
    """Spherical k-means on the sample; centres start from spread-out vectors, empty ones leave."""

    def run(batches):
        parts = [_unit(_matrix(b.column(0))) for b in batches if b.num_rows]
        if not parts:
            return
        rows = np.concatenate(parts)
        rng = np.random.default_rng(5)
        centres = rows[rng.choice(len(rows), min(cells, len(rows)), replace=False)]
        for _ in range(ROUNDS):
            home = np.concatenate([np.argmax(rows[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(rows), 4096)])
            sums = np.zeros_like(centres)
            np.add.at(sums, home, rows)
            length = np.linalg.norm(sums, axis=1)
            centres = sums[length > 0] / length[length > 0, None]
        yield pa.RecordBatch.from_arrays([pa.array(list(centres), pa.list_(pa.float64()))], names=["centre"])

    return run


def _dealt(centres: np.ndarray, least: float):
    """Each class at home, and as a guest in the later cells that may hold similar vectors."""
    reach = math.sin(math.acos(least)) + 1e-9
    between = centres[:, None, :] - centres[None, :, :]
    size = np.linalg.norm(between, axis=2)

    def by_length(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v"))
            for size in pc.unique(lengths):
                yield batch.filter(pc.equal(lengths, size))

    def run(batches):
        for batch in by_length(batches):
            rows = _unit(_matrix(batch.column("v")))
            near = rows @ centres.T if rows.shape[1] == centres.shape[1] else np.zeros((len(rows), 1))
            home = np.argmax(near, axis=1)
            # x.u for all cells at once; equal centres are never told apart
            off = near[np.arange(len(rows)), home][:, None] - near
            apart = size[home][:, : near.shape[1]]  # one cell, if the length is not the centres'
            guest = (off <= reach * apart) & (np.arange(near.shape[1])[None, :] > home[:, None])
            who, cell = np.nonzero(guest)
            pick = np.r_[np.arange(len(rows)), who]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").take(pa.array(pick)), pa.array(np.r_[home, cell]), pa.array(np.r_[np.zeros(len(rows), bool), np.ones(len(who), bool)]), batch.column("class_id").take(pa.array(pick)), batch.column("copies").take(pa.array(pick)), pa.array(list(rows[pick]), pa.list_(pa.float64()))],
                names=["label", "cell", "guest", "class_id", "copies", "v"],
            )

    return run


def _compared(least: float):
    """Links of two blocks: for each vector how many vectors it meets, and a star for each set that links connect."""

    def run(table: pa.Table) -> pa.Table:
        first = table.column("first").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        rows, ids = _matrix(table.column("v")), table.column("class_id").to_numpy()
        copies = table.column("copies").to_numpy()
        same = bool(table.column("same")[0].as_py())
        a = np.arange(len(ids)) if same else np.flatnonzero(first)
        b = a if same else np.flatnonzero(~first)
        hits = rows[a] @ rows[b].T >= least
        if same:
            np.fill_diagonal(hits, False)
        links = np.zeros(len(ids), np.int64)
        links[a] += hits @ copies[b]
        if not same:
            links[b] += hits.T @ copies[a]
        low = _connected(a, b, hits, ids)
        keep = links > 0
        return pa.table({"class_id": ids[keep], "links": links[keep], "low": low[keep]})

    return run


def _connected(a: np.ndarray, b: np.ndarray, hits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that links reach from each row."""
    low = ids.copy()
    if hits.sum() <= 50_000:
        roots = Roots()
        for i, j in zip(*np.nonzero(hits), strict=True):
            roots.join(int(ids[a[i]]), int(ids[b[j]]))
        return np.array([roots.find(int(i)) for i in ids], np.int64)
    top = np.iinfo(np.int64).max
    while True:
        was = low.copy()
        low[a] = np.minimum(low[a], np.where(hits, low[b][None, :], top).min(axis=1, initial=top))
        low[b] = np.minimum(low[b], np.where(hits, low[a][:, None], top).min(axis=0, initial=top))
        if (low == was).all():
            return low


def near_duplicates(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept): cosine links (``least`` or more) among vectors of one label.

    Vectors that are null, zero, or hold null or non-finite components, or whose label is null, link with nothing; so do
    vectors of different lengths. Rows without an id are left out; of rows with one id one counts. Equal vectors are one
    class and are counted, not expanded. Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ready(spark, 2000)
    rows = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).alias("label")).dropDuplicates(["vec_id"])
    good = F.expr(f"label is not null and {usable('v')}")
    classes = settle(rows.where(good).groupBy("label", "v").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")).withColumn("label", F.struct("label", F.size("v").alias("dims"))), "vector-classes")
    sizes = {r.dims: r.n for r in classes.groupBy(F.col("label.dims").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(1).collect()}
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    (dims, count), = sizes.items()
    sample = classes.where(F.col("label.dims") == dims).orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("v")
    centres = sample.coalesce(1).mapInArrow(_fit(min(CELLS, -(-count // CELL))), "centre array<double>").collect()
    centres = np.array([c.centre for c in centres])
    plain = classes.select(F.struct("label").alias("key"), "class_id", "copies", "v").select(F.xxhash64("key").alias("label"), "key", "class_id", "copies", "v")
    dealt = settle(plain.select("label", "class_id", "copies", "v").mapInArrow(_dealt(centres, least), "label long, cell long, guest boolean, class_id long, copies long, v array<double>"), "vector-cells")
    # a cell's blocks: b at home, g of guests
    held = dealt.groupBy("label", "cell").agg(F.expr(f"cast(ceil(count_if(not guest) / {BLOCK}) as int)").alias("homes"), F.expr(f"cast(ceil(count_if(guest) / {BLOCK}) as int)").alias("guests"))
    placed = dealt.join(held, ["label", "cell"]).where("homes > 0").withColumn("at", F.expr("cast(pmod(xxhash64(class_id), if(guest, guests, homes)) as int)"))
    own = "transform(sequence(0, homes - 1), o -> struct(least(at, o) as a, greatest(at, o) as b, false as visit, at <= o as first))"
    met = "if(guests > 0, transform(sequence(0, guests - 1), o -> struct(o as a, at as b, true as visit, false as first)), array())"
    out = "transform(sequence(0, homes - 1), o -> struct(at as a, o as b, true as visit, true as first))"
    sent = placed.withColumn("to", F.explode(F.expr(f"if(guest, {out}, concat({own}, {met}))")))
    sent = sent.select("label", "cell", "to.a", "to.b", "to.visit", "to.first", F.expr("to.a = to.b and not to.visit").alias("same"), "class_id", "copies", "v")
    found = settle(sent.groupBy("label", "cell", "visit", "a", "b").applyInArrow(_compared(least), "class_id long, links long, low long"), "vector-links")
    counted = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("class_id").alias("a"), F.col("low").alias("b")))
    facts = classes.join(counted, "class_id", "left").join(reached, classes.class_id == reached.id, "left")
    facts = facts.select(F.col("label.label").alias("label"), "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    judged = rows.join(facts, ["label", "v"], "left")
    whole = judged.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return whole.withColumn("kept", F.col("vec_id") == F.col("component_id"))
