"""Vector code compression by equal-average search.

A vector is cut into equal parts, and a part's code is the number of the nearest entry in that place's codebook. For two
vectors of d components the squared distance is at least the squared difference of their sums divided by d. So the
entries are sorted by their sum; from a part's own sum the search goes outward on both sides, always to the nearer sum, and
ends where the squared gap over d strictly exceeds the best distance found: an entry beyond it can neither be nearer nor tie.

Codebooks are fitted by rounds over all vectors. A task adds up its parts by entry and sends one row for each sum, so
what meets is bounded by tasks times components, whatever the entries hold. All arithmetic is exact, in integers.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.columns import on_workers
from ledgerlake.llm.shared import settle

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
AT_ONCE = 4096  # vectors whose parts are searched together
WHOLE = 1 << 29  # products of dims and the largest component whose squares stay exact in 64 bits


def usable(vector: str) -> str:
    """SQL: the vector is not null and holds neither null nor non-finite components."""
    return f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"


def whole(rows: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where these may not do for exact sums of squares."""
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * scale)
    if not scaled.size or np.abs(scaled).max() * rows.shape[-1] < WHOLE:
        return scaled.astype(np.int64)
    exact = [int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in rows.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


def cut(rows: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """(vector, part, position); zeros fill up the last part if the length does not divide."""
    width = -(-rows.shape[1] // parts)
    full = np.zeros((len(rows), width * parts), rows.dtype)
    full[:, : rows.shape[1]] = rows
    return full.reshape(len(rows), parts, width)


class Entries:
    """The codebook of one part, sorted by component sums."""

    def __init__(self, book: np.ndarray):
        sums = book.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.sums, self.book = sums[self.number], book[self.number]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row the nearest entry, the lower of equally near ones, its squared distance; and how many were compared."""
        count, width = rows.shape
        size, most = len(self.sums), max(width, 1)
        own = rows.sum(axis=1) if width else np.zeros(count, np.int64)
        right = np.searchsorted(self.sums, own)
        left = right - 1
        near, best = np.full(count, size), np.zeros(count, rows.dtype)
        going, compared = np.arange(count), 0
        while len(going):
            low, high = left[going], right[going]
            below, above = own[going] - self.sums[np.maximum(low, 0)], self.sums[np.minimum(high, size - 1)] - own[going]
            down = (high >= size) | ((low >= 0) & (below <= above))
            gap = np.where(down, below, above)
            # the first entry is always compared; later ones unless their gap is too wide
            open_ = ((low >= 0) | (high < size)) & ((near[going] == size) | (gap * gap <= best[going] * most))
            going, down, low, high = going[open_], down[open_], low[open_], high[open_]
            entry = np.where(down, low, high)
            left[going] -= down
            right[going] += ~down
            apart = rows[going] - self.book[entry]
            distance = (apart * apart).sum(axis=1) if width else np.zeros(len(going), np.int64)
            compared += len(going)
            number, old, found = self.number[entry], near[going], best[going]
            better = (old == size) | (distance < found) | ((distance == found) & (number < old))
            near[going[better]], best[going[better]] = number[better], distance[better]
        return near, best, compared


def _by_length(batches):
    """(batch, matrix of its vectors) of vectors of one length each."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("v"))
        for size in pc.unique(sizes).to_pylist():
            some = batch.filter(pc.equal(sizes, size))
            flat = some.column("v").flatten().to_numpy(zero_copy_only=False)
            for first in range(0, some.num_rows, AT_ONCE):
                few = some.slice(first, AT_ONCE)
                yield few, flat[first * size : (first + few.num_rows) * size].reshape(few.num_rows, size)


def _summed(books: dict[int, np.ndarray], scale: int):
    """One row for each sum of a task: length, part, entry, position, how many parts, their sum."""

    def run(batches):
        sums = {n: np.zeros(b.shape, object) for n, b in books.items()}
        counts = {n: np.zeros(b.shape[:2], np.int64) for n, b in books.items()}
        sorted_ = {n: [Entries(b) for b in book] for n, book in books.items()}
        for _, rows in _by_length(batches):
            size = rows.shape[1]
            cuts = cut(whole(rows, scale), len(sorted_[size]))
            for part, entries in enumerate(sorted_[size]):
                near, _, _ = entries.nearest(cuts[:, part])
                added = np.zeros(sums[size].shape[1:], cuts.dtype)
                np.add.at(added, near, cuts[:, part])
                sums[size][part] += added.astype(object)
                counts[size][part] += np.bincount(near, minlength=len(added))
        for size, count in counts.items():
            for part, entry in zip(*np.nonzero(count), strict=True):
                values = [str(x) for x in sums[size][part, entry].tolist()]
                n, width = int(count[part, entry]), len(values)
                facts = [[size] * width, [int(part)] * width, [int(entry)] * width, list(range(width)), [n] * width]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in facts), pa.array(values, pa.string())], names=["size", "part", "entry", "position", "n", "total"])

    return run


def _seeds(rows: DataFrame, size: int, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids; of rows with one id the smallest vector."""
    found: dict[int, list[float]] = {}
    left = rows.where(F.size("v") == size).select("vec_id", "v")
    while len(found) < entries:
        some = left.where(F.col("vec_id") > max(found)) if found else left
        top = some.orderBy("vec_id", "v").limit(entries).collect()
        for row in top:
            if len(found) < entries:
                found.setdefault(row.vec_id, row.v)
        if len(top) < entries:
            break
    return list(found.values())


def fitted(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> dict[int, np.ndarray]:
    """Codebooks (part, entry, position) for each length of the vectors of ``rows`` (vec_id, label, v)."""
    sizes = [r.size for r in rows.groupBy(F.size("v").alias("size")).count().select("size").collect()]
    books = {}
    for size in sizes:
        seeds = _seeds(rows, size, entries)
        first = np.array(seeds, float).reshape(len(seeds), size)
        books[size] = cut(whole(first, scale), parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if books else 0):
        sent = rows.select("v").mapInArrow(_summed(books, scale), "size long, part long, entry long, position long, n long, total string")
        moved = sent.groupBy("size", "part", "entry", "position").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        books = {n: b.astype(object) for n, b in books.items()}
        for row in moved:
            books[row["size"]][row.part, row.entry, row.position] = int(row.total) // row.n
        books = {n: b if not b.size or max(map(abs, b.ravel())) * n >= WHOLE else b.astype(np.int64) for n, b in books.items()}
    return books


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def _coded(books: dict[int, np.ndarray], scale: int):
    def run(batches):
        sorted_ = {n: [Entries(b) for b in book] for n, book in books.items()}
        digests = {n: digest(b) for n, b in books.items()}
        for few, rows in _by_length(batches):
            size = rows.shape[1]
            cuts = cut(whole(rows, scale), len(sorted_[size]))
            found = [entries.nearest(cuts[:, part])[:2] for part, entries in enumerate(sorted_[size])]
            codes = np.stack([near for near, _ in found], axis=1)
            errors = sum(best for _, best in found)
            hexes = ["".join(f"{x:02x}" for x in code) for code in codes.tolist()]
            arrays = [few.column("vec_id"), few.column("label"), pa.array(hexes, pa.string()), pa.array(errors.tolist(), pa.int64()), pa.array([digests[size]] * len(hexes), pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return run


def coded(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, label, code, error, label_error, codebooks_sha256) of all usable vectors, by codebooks fitted on them.

    Vectors that are null or hold null or non-finite components are dropped, and rows without an id. A row that is
    repeated is coded and counted each time, but an id gives one first entry, its smallest vector. With fewer ids than
    entries there are fewer entries. Vectors of each length have codebooks of their own; zeros fill up the last part of a
    length that does not divide. Null labels are one label. Other columns are not read. An empty table gives no rows.
    An error beyond 64 bits ends the query. Codebooks, entries times length for each length, go through the driver.
    """
    on_workers(vectors)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    rows = rows.where(f"vec_id is not null and {usable('v')}")
    books = fitted(rows, parts, entries, rounds, scale)
    kind = rows.schema["label"].dataType.simpleString()
    codes = settle(rows.mapInArrow(_coded(books, scale), f"vec_id long, label {kind}, code string, error long, codebooks_sha256 string"), "vector-codes")
    sums = codes.groupBy(F.col("label").alias("whose")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("whose"))).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, by comparing each part with all entries; for vectors of one length that divides."""
    steps = [f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v, len(embedding) // {parts} AS w
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cuts AS MATERIALIZED (
    SELECT r, vec_id, p, v[p * w + 1:(p + 1) * w] AS x FROM kept, range({parts}) AS places(p)
), first_ids AS (
    SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT {entries}
), book_0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, min(x) AS c FROM cuts WHERE vec_id IN (FROM first_ids) GROUP BY p, vec_id
)"""]
    for i in range(rounds + 1):
        steps.append(f"""near_{i} AS MATERIALIZED (
    SELECT r, p, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS best
    FROM cuts JOIN book_{i} USING (p) GROUP BY r, p
)""")
        if i < rounds:
            steps.append(f"""means_{i} AS (
    SELECT p, e, list(m ORDER BY j) AS c FROM (
        SELECT p, best.e AS e, j, floor(sum(x[j])::DOUBLE / count(*))::BIGINT AS m FROM near_{i}, range(1, 1 + (SELECT max(w) FROM kept)) AS positions(j) GROUP BY p, best.e, j
    ) GROUP BY p, e
), book_{i + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book_{i} b LEFT JOIN means_{i} m ON m.p = b.p AND m.e = b.e
)""")
    steps.append(f"""codes AS MATERIALIZED (
    SELECT r, string_agg(lpad(to_hex(best.e), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near_{rounds} GROUP BY r
)""")
    return ", ".join(steps) + f"""
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book_{rounds}) AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""
