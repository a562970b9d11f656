"""Typed reads from VARIANT columns.

A path is written ``a.b[0].c``; every key is quoted, so keys such as ``0_sender`` or ``@type`` need no escape.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def jpath(path: str) -> str:
    out = "$"
    for key, index in re.findall(r"([^.\[\]]+)(?![^\[]*\])|\[(\d+)\]", path):
        out += f"[{index}]" if index else f"['{key}']"
    return out


def safe_json(text) -> Column:
    """VARIANT of a JSON text, null where the text is not one JSON value.

    The parser stops after the first value and would accept ``{"a":1} rest``; inside brackets the rest is an error
    or a second element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), _col(text), F.lit("]")))
    return F.when(F.array_size(F.try_variant_get(wrapped, "$", "array<variant>")) == 1, F.try_variant_get(wrapped, "$[0]", "variant"))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _read(value, path: str, kind: str) -> Column:
    return F.try_variant_get(_col(value), jpath(path), kind)


def vstr(value, path: str = "") -> Column:
    return _read(value, path, "string")


def vlong(value, path: str = "") -> Column:
    return _read(value, path, "bigint")


def vdec(value, path: str = "") -> Column:
    """Whole token amounts; they may exceed 2^63."""
    return _read(value, path, "decimal(38,0)")


def vdouble(value, path: str = "") -> Column:
    return _read(value, path, "double")


def vtime(value, path: str = "") -> Column:
    """Chain times carry nanoseconds and a trailing Z; microseconds are kept and the wall clock is UTC."""
    text = F.regexp_replace(vstr(value, path), r"Z$", "")
    return text.try_cast("timestamp_ntz")


def vvar(value, path: str = "") -> Column:
    return _read(value, path, "variant")


def varray(value, path: str = "") -> Column:
    return _read(value, path, "array<variant>")


def vmap(value, path: str = "") -> Column:
    return _read(value, path, "map<string,variant>")


def has(value, path: str) -> Column:
    """True when the path exists, a JSON null included; typed reads cannot tell the two nulls apart."""
    return vvar(value, path).isNotNull()
