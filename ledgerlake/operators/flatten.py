"""Arrays and objects to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.binding import let, runs
from ledgerlake.functions.variants import varray, vmap


def flatten_array(df: DataFrame, array: Column, value: str = "value", index: str = "index") -> DataFrame:
    """One row per element of a VARIANT array; parents without elements are dropped."""
    return df.select("*", F.posexplode(varray(array)).alias(index, value))


def flatten_array_outer(df: DataFrame, array: Column, value: str = "value", index: str = "index") -> DataFrame:
    return df.select("*", F.posexplode_outer(varray(array)).alias(index, value))


def flatten_object(df: DataFrame, obj: Column, key: str = "key", value: str = "value") -> DataFrame:
    """One row per field of a VARIANT object."""
    return df.select("*", F.explode(vmap(obj)).alias(key, value))


def flatten_path(df: DataFrame, root: Column, steps: Sequence[str], value: str = "value") -> DataFrame:
    """Explode nested arrays along known paths, e.g. ``["data", "result.block_metas"]``."""
    out = df.withColumn(value, root)
    for step in steps:
        out = out.withColumn("_step", F.explode(varray(F.col(value), step)))
        out = out.withColumn(value, F.col("_step")).drop("_step")
    return out


def _children(path: Column, node: Column) -> Column:
    """(path, key, index, value) of the direct children of a VARIANT node; empty for a scalar."""

    def entry(step: Column, key: Column, index: Column, value: Column) -> Column:
        return F.struct(
            F.concat(path, step).alias("path"), key.cast("string").alias("key"), index.cast("bigint").alias("index"),
            value.alias("value"),
        )

    nothing = F.lit(None)
    dot = F.when(path == "", F.lit("")).otherwise(F.lit("."))
    items = F.transform(
        varray(node), lambda v, i: entry(F.concat(F.lit("["), i.cast("string"), F.lit("]")), nothing, i, v)
    )
    fields = F.transform(
        F.map_entries(vmap(node)), lambda e: entry(F.concat(dot, e["key"]), e["key"], nothing, e["value"])
    )
    return F.coalesce(items, fields, F.filter(F.array(entry(F.lit(""), nothing, nothing, node)), lambda _: F.lit(False)))


def _depth(node: Column) -> Column:
    """How many brackets of a VARIANT are open at once, from its JSON text without strings and scalars."""
    brackets = F.regexp_replace(F.to_json(node), r'"(?:[^"\\]++|\\.)*+"|[^\[\]{}]', "")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("most"))

    def step(state: Column, bracket: Column) -> Column:
        now = state["open"] + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("open"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.filter(F.split(brackets, ""), lambda c: c != ""), start, step, lambda state: state["most"])


def flatten_recursive(df: DataFrame, root: Column) -> DataFrame:
    """Every node below ``root``, however deep, as (path, key, index, value).

    The levels are walked inside the row, as many as the row's own value has, so the payload is read once and exploded
    once at the end. A scalar or null root has no nodes and its row goes.
    """
    top = _children(F.lit(""), root)
    start = F.struct(top.alias("nodes"), top.alias("level"))

    def step(state: Column, _: Column) -> Column:
        deeper = F.flatten(F.transform(state["level"], lambda n: _children(n["path"], n["value"])))
        return let(deeper, lambda d: F.struct(F.concat(state["nodes"], d).alias("nodes"), d.alias("level")))

    levels = F.sequence(F.lit(1), F.greatest(_depth(root), F.lit(1)))
    return df.select("*", F.inline(F.aggregate(levels, start, step, lambda state: state["nodes"])))


def split_rows(df: DataFrame, text: Column, separator: str, value: str = "value", index: str = "index") -> DataFrame:
    """One row per part of a delimited text; the index starts at 1. ``separator`` is taken literally."""
    parts = F.split(text, F.lit("\\Q" + separator + "\\E"))
    return df.select("*", F.posexplode(parts).alias("_pos", value)).withColumn(index, F.col("_pos") + 1).drop("_pos")


def prefix_regroup(entries: Column) -> Column:
    """Regroup fields such as ``3_sender`` by their leading index, inside one row.

    ``entries`` is MAP<STRING, VARIANT>. The result is an array of (array_index, fields), ordered by the index as
    text; fields without an index belong to index ``0``. No shuffle: the groups never leave their row.
    """
    numbered = F.transform(
        F.map_entries(entries),
        lambda e: F.struct(
            F.regexp_extract(e["key"], r"^([0-9]+)(?:_|$)", 1).alias("i"), e["key"].alias("k"), e["value"].alias("v")
        ),
    )
    parts = F.transform(
        numbered,
        lambda p: F.struct(
            F.when(p["i"] == "", F.lit("0")).otherwise(p["i"]).alias("i"),
            F.when(p["i"] == "", p["k"]).otherwise(F.substring(p["k"], F.length(p["i"]) + 2, F.length(p["k"]))).alias("k"),
            p["v"].alias("v"),
        ),
    )

    def regrouped(parts: Column) -> Column:
        # values need not be orderable, so positions are sorted and values looked up
        order = F.sort_array(F.transform(parts, lambda p, n: F.struct(p["i"].alias("i"), n.alias("n"))))
        field = lambda o: F.struct(F.get(parts, o["n"])["k"], F.get(parts, o["n"])["v"])
        return F.transform(
            runs(order, lambda o: o["i"]),
            lambda run: F.struct(
                F.get(run, F.lit(0))["i"].alias("array_index"),
                F.map_from_entries(F.transform(run, field)).alias("fields"),
            ),
        )

    return let(parts, regrouped)
