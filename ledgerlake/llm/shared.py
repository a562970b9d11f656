"""Helpers of this folder: staging, key-bucketed binary postings, hashing in numpy."""

from __future__ import annotations

import math
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import settle

U = np.uint64
__all__ = ["settle", "read_table", "deals", "ready", "mix", "word_hashes", "documents_of", "bucket_of", "postings", "packed", "unpacked"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deals(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ready(spark: SparkSession, rows: int = 500) -> None:
    """Python workers of this session get ``rows`` rows at a time, for whole texts can be long, and find this package
    where it lies on the driver, if it is not installed with them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    home = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser; different seeds give independent hashes."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(256, dtype=U), 11)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n; kept in the worker and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, math.ceil(math.log2(max(n, 2))))
        steps = np.full(size, U(base))
        steps[0] = U(1)
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums such that ``span_hashes`` gets the hash of any byte span from two of them."""
    sums = np.empty(len(data) + 1, dtype=U)
    sums[0] = 0
    np.cumsum(_BYTES[data] * powers(len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes, wherever the span lies."""
    back = powers(len(sums), _BACK)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(U))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and the index of its text, in order."""
    joined = b" ".join(texts).translate(_LOWER) + b" "
    data = np.frombuffer(joined, dtype=np.uint8)
    ends_of = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    edge = np.diff(_SPACE[data].view(np.int8), prepend=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return span_hashes(prefix_sums(data), start, end), np.searchsorted(ends_of, start, side="right")


def documents_of(batches, size: int = 1 << 20):
    """Lists of (doc_id, bytes) of about ``size`` bytes from record batches (doc_id, text); null text is empty."""
    ids: list[int] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        column = batch.column(1).cast(pa.binary()) if not pa.types.is_binary(batch.column(1).type) else batch.column(1)
        for doc, text in zip(batch.column(0).to_pylist(), column.to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text or b"")
            held += len(texts[-1])
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(key.view(U), 77) % U(buckets)).astype(np.int64)


def postings(key: np.ndarray, columns: list[np.ndarray], buckets: int, names: list[str]):
    """One row for each bucket of keys: the bucket and the keys' and columns' bytes. Equal keys share a bucket."""
    if not len(key):
        return
    bucket = bucket_of(key, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(bucket)]
    arrays = [pa.array(bucket[starts], pa.int64())]
    for column in [key, *columns]:
        dealt = np.ascontiguousarray(column[order])
        width = dealt.dtype.itemsize
        offsets = np.r_[starts, ends[-1]].astype(np.int64) * width
        arrays.append(pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(dealt)]).cast(pa.binary()))
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *names])


def unpacked(batches, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """All values of the packed columns of one partition."""
    parts: dict[str, list[bytes]] = {name: [] for name in kinds}
    for batch in batches:
        for name in kinds:
            parts[name] += batch.column(batch.schema.get_field_index(name)).to_pylist()
    return {name: np.frombuffer(b"".join(parts.pop(name)), dtype=kind) for name, kind in kinds.items()}


def packed(*names: str) -> str:
    """Schema text of rows that ``postings`` makes."""
    return "bucket long, " + ", ".join(f"{name} binary" for name in names)
