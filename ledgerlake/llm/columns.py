"""Running a batch function beside all columns of a table, whatever these are called."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 4 << 20  # bytes of text that are worked on at once; a longer text is worked on alone


def on_workers(frame: DataFrame) -> None:
    """Python workers find this package where it lies on the driver, if it is not installed with them."""
    here = frame.sparkSession.sparkContext.environment
    home = str(Path(__file__).resolve().parents[2])
    paths = here.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        here["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def beside(frame: DataFrame, inputs: list[Column], made: dict[str, str], run, rest: list[str] | None = None) -> DataFrame:
    """``frame`` with the columns ``made`` (name: type). ``run`` turns a record batch of ``inputs`` into arrays of
    ``made``, in pieces that are shorter than the batch if it likes: it yields the arrays of one piece after another.

    Other columns go along under neutral names, so that nothing clashes; one that is called as a new one is replaced.
    """
    on_workers(frame)
    rest = [c for c in (frame.columns if rest is None else rest) if c not in made]
    kept = [f"kept_{i}" for i in range(len(rest))]
    given = [f"given_{i}" for i in range(len(inputs))]
    new = [f"made_{i}" for i in range(len(made))]
    plain = frame.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(rest, kept, strict=True)], *[x.alias(g) for x, g in zip(inputs, given, strict=True)])
    shape = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.select(*kept).schema.fields] + [f"{n} {t}" for n, t in zip(new, made.values(), strict=True)])

    def all_batches(batches):
        for batch in batches:
            at = 0
            for arrays in run(batch.select(given)):
                own = [c.slice(at, len(arrays[0])) for c in batch.columns[: len(kept)]]
                at += len(arrays[0])
                yield pa.RecordBatch.from_arrays([*own, *arrays], names=[*kept, *new])

    done = plain.mapInArrow(all_batches, shape)
    return done.select(*[F.col(k).alias(c) for c, k in zip(rest, kept, strict=True)], *[F.col(n).alias(c) for c, n in zip(made, new, strict=True)])


def pieces(column: pa.Array, size: int = PIECE):
    """(first row, end row, bytes, offsets) of consecutive rows with about ``size`` bytes; null texts are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts from their joined bytes."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers).cast(pa.string())
