"""A log that multiplexes many streams: ``record_metadata`` and ``record_content``, both VARIANT.

Each stream is one filter on the model's name or class, followed by one row per entry of ``results``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import vlong, vstr
from ledgerlake.operators.flatten import flatten_array


def created_at(metadata: str = "record_metadata") -> Column:
    """``CreateTime`` is epoch milliseconds."""
    return F.timestamp_millis(vlong(F.col(metadata), "CreateTime")).cast("timestamp_ntz")


def named(*names: str) -> Column:
    return vstr("record_content", "model.name").isin(*names)


def classed(*classes: str) -> Column:
    return vstr("record_content", "model.class").isin(*classes)


def pinned(runs: Sequence[tuple[str, str]]) -> Column:
    """Only one run id of each named model counts."""
    out = None
    for name, run_id in runs:
        both = (vstr("record_content", "model.name") == name) & (vstr("record_content", "model.run_id") == run_id)
        out = both if out is None else out | both
    return out


def stream_results(log: DataFrame, which: Column) -> DataFrame:
    """Entries of the selected stream as ``t``, with ``system_created_at``, ``_inserted_timestamp`` and the content."""
    chosen = log.where(which).select(
        created_at().alias("system_created_at"), "_inserted_timestamp", "record_content"
    )
    return flatten_array(chosen, F.expr("variant_get(record_content, '$.results', 'variant')"), "t", "t_index")


def typed_results(log: DataFrame, which: Column, fields: Sequence[str]) -> DataFrame:
    """Entries of the selected stream with ``fields`` (``name type``), ``system_created_at`` and ``_inserted_timestamp``.

    All fields of an entry are read in one pass; reading them one by one out of a VARIANT searches and copies it each
    time. A field of another kind is null, as it is for single reads, and an entry that is no object has only nulls.
    """
    chosen = log.where(which).select(created_at().alias("system_created_at"), "_inserted_timestamp", "record_content")
    # not a column of its own: Spark would infer a filter on its size and read the entries once more for it
    entries = F.try_variant_get("record_content", "$.results", f"array<struct<{','.join(fields)}>>")
    return chosen.select("system_created_at", "_inserted_timestamp", F.inline(entries))
