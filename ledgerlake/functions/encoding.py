"""Event attributes arrive as plain text or as base64, depending on the node version."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_BASE64 = r"[!-*,\-.:-<>-@\[-`{-~]"


def decode_attr(value: Column) -> Column:
    """The base64-decoded text where ``value`` is padded base64 of valid UTF-8, else ``value`` itself.

    The length test is needed because Spark's decoder also accepts unpadded words such as ``action``. A printable ASCII
    character that base64 does not use is looked for first, for a text that cannot be decoded costs an exception.
    """
    decoded = F.try_validate_utf8(F.try_to_binary(value, F.lit("base64")).cast("string"))
    return F.coalesce(F.when((F.length(value) % 4 == 0) & ~value.rlike(NO_BASE64), decoded), value)
