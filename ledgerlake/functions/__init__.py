"""Column expressions; all of them are built-in Spark functions, none is a Python UDF."""

from ledgerlake.functions.coins import coin_amount, coin_denom, denom_cut, scaled
from ledgerlake.functions.encoding import decode_attr
from ledgerlake.functions.keys import joined_key, surrogate_key
from ledgerlake.functions.nulls import greatest_strict
from ledgerlake.functions.variants import has, jpath, safe_json, vdec, vdouble, vlong, vmap, vstr, vtime, vvar, varray

__all__ = [
    "coin_amount", "coin_denom", "denom_cut", "scaled", "decode_attr", "joined_key", "surrogate_key",
    "greatest_strict", "has", "jpath", "safe_json", "vdec", "vdouble", "vlong", "vmap", "vstr", "vtime", "vvar", "varray",
]
