"""Row identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder that the public surrogate-key formula uses for a null part.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*parts) -> Column:
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def joined_key(separator: str, *parts) -> Column:
    """Parts joined by ``separator``; null as soon as one part is null (``concat_ws`` would skip it)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)
