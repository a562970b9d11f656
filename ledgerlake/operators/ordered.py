"""Ordered per-key computations that do not put a whole key into one task.

A plain window sends all rows of a key to one task. Here every key is cut into chunks by ``chunk``, an expression
that is monotone in the first order column (an hour of a timestamp, an id divided by a width). Windows run inside
a slot = (key, chunk); what must cross chunks is one small row per slot, pre-aggregated on the map side, scanned
per key and joined back on the slot. The join and the window share one shuffle, and the slot is a struct, so null
keys form a group of their own as they do in a window. Without keys, slots are scanned in two levels: inside blocks of
neighbouring chunks, and one row per block across, so no task sees a row for every chunk of the table.

``scan_steps`` carries several steps over the same keys and order at once: one aggregate of the slots, one scan and one
join back, however many steps there are. ``density_chunk`` cuts chunks that hold too many rows at their quantiles, so a
hot hour becomes several slots; rows with one value of the first order column stay together.

``order`` is a list of column names, ascending, and must be total where the result depends on ties.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOT = "_slot"
SLOT_ROWS = 1_000_000  # rows of a chunk from which on it is cut by density
MOST_CUTS = 100_000  # cuts of a table, held as one literal; beyond, chunks get larger instead


def time_chunk(ts: Column, unit: str = "hour") -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def id_chunk(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width)).cast("bigint")


def density_cuts(df: DataFrame, column: str, chunk: Column, rows: int = SLOT_ROWS) -> list:
    """Where chunks of more than ``rows`` rows are to be cut: values of ``column``, ascending.

    Only hot chunks are read a second time; each gets the quantiles of a mergeable sketch. At most MOST_CUTS values come
    back, for ``rows`` grows with the table. Nulls are not counted.
    """
    held = df.select(F.col(column).alias("v"), chunk.alias("c")).where("v is not null")
    counts = held.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
    rows = max(rows, -(-(size["total"] or 0) // MOST_CUTS))
    if (size["largest"] or 0) <= rows:
        return []
    fan = min(10_000, -(-size["largest"] // rows))
    hot = counts.where(F.col("n") > rows).select("c", "n")
    shares = F.percentile_approx("v", [i / fan for i in range(1, fan)] or [0.5], 10 * fan)
    sketched = held.join(hot, "c").groupBy("c").agg(shares.alias("at"), F.first("n").alias("n"))
    # a chunk that is less hot than the hottest needs fewer cuts: every step-th of them
    step = F.greatest(F.lit(1), F.floor(F.lit(fan * rows) / F.col("n")))
    thinned = sketched.select(F.explode(F.filter("at", lambda _, i: (i + 1) % step == 0)).alias("cut"))
    return [r["cut"] for r in thinned.distinct().orderBy("cut").collect()]


def density_chunk(value: Column, chunk: Column, cuts: list) -> Column:
    """``chunk``, cut further at ``cuts``: how many of them are at or below ``value``, by halving steps."""
    if not cuts:
        return chunk
    steps = F.lit([1 << i for i in reversed(range(len(cuts).bit_length()))])
    bounds = F.lit(cuts)
    reached = lambda at: F.coalesce(F.get(bounds, at - 1) <= value, F.lit(False))
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))
    return F.struct(chunk.alias("coarse"), below.alias("fine"))


def _slotted(df: DataFrame, keys: Sequence[str], chunk: Column, **extra: Column) -> DataFrame:
    slot = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], chunk.alias("chunk"))
    return df.withColumns({SLOT: slot, **extra})


def _across(keys: Sequence[str], forward: bool = True):
    chunk = F.col(f"{SLOT}.chunk")
    window = Window.partitionBy(*[F.col(f"{SLOT}.k{i}") for i in range(len(keys))])
    return window.orderBy(chunk.asc() if forward else chunk.desc())


def _scanned(scan: str, value: str, window) -> Column:
    """What the rows before this one in ``window`` amount to."""
    if scan == "lag":
        return F.lag(value).over(window)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.sum(value).over(earlier) if scan == "sum" else F.last(value, ignorenulls=True).over(earlier)


def _block_of(slots: DataFrame) -> Column | None:
    """A coarser chunk of a slot: ten thousand numbers or a year of times; None for other kinds of chunks."""
    kind = slots.schema[SLOT].dataType["chunk"].dataType
    chunk = F.col(f"{SLOT}.chunk")
    if isinstance(kind, T.StructType):
        kind, chunk = kind["coarse"].dataType, chunk["coarse"]
    if isinstance(kind, T.IntegralType):
        return F.floor(chunk / 10_000)
    return F.year(chunk) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else None


@dataclass(frozen=True)
class Step:
    """One ordered computation: ``value`` is taken from a row, ``summary`` aggregates a slot's values, ``scan`` combines
    the summaries of the slots before: ``sum`` (0 where there is none), ``last`` (the nearest that is not null) or
    ``lag``. ``result`` makes the outcome of value, window of the slot and carry. Backward steps run from the end."""

    value: Column
    summary: Callable[[str, Column], Column]
    scan: str
    result: Callable[[str, object, Column], Column]
    forward: bool = True


def count_of(flag: Column) -> Step:
    """How many rows up to and including this one satisfy ``flag``."""
    hit = F.coalesce(flag.cast("int"), F.lit(0))
    upto = lambda v, w, carry: F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)) + carry
    return Step(hit, lambda v, _: F.sum(v), "sum", upto)


def number() -> Step:
    """1, 2, 3, ... in order."""
    return Step(F.lit(1), lambda v, _: F.count(v), "sum", lambda _, w, carry: (F.row_number().over(w) + carry).cast("bigint"))


def rank_of(by: str) -> Step:
    """Dense rank by the only order column; equal values share a slot because the chunk is a function of it."""
    rank = lambda _, w, carry: (F.dense_rank().over(w) + carry).cast("bigint")
    return Step(F.col(by), lambda v, _: F.count_distinct(v), "sum", rank)


def _filled(v: str, w, carry: Column) -> Column:
    return F.coalesce(F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), carry)


def last_of(value: Column) -> Step:
    """The last non-null ``value`` at or before each row."""
    return Step(value, lambda v, at: F.max_by(v, F.when(F.col(v).isNotNull(), at)), "last", _filled)


def next_of(value: Column) -> Step:
    """The first non-null ``value`` at or after each row."""
    return Step(value, lambda v, at: F.min_by(v, F.when(F.col(v).isNotNull(), at)), "last", _filled, forward=False)


def before(value: Column) -> Step:
    """``value`` of the row just before; null for the first row of a key."""
    lagged = lambda v, w, carry: F.coalesce(F.lag(v).over(w), carry)["v"]
    return Step(F.struct(value.alias("v")), lambda v, at: F.max_by(v, at), "lag", lagged)


def _two_levels(slots: DataFrame, block: Column, steps: Sequence[Step]) -> DataFrame:
    """``slots`` of a table without keys, with ``_carry0``, ``_carry1``, ..."""
    placed = slots.withColumn("_block", block)
    at, place = F.col(f"{SLOT}.chunk"), F.col("_block")
    wholes, across, inside, carries = [], {}, {}, {}
    zero = F.lit(0).cast("bigint")
    for i, step in enumerate(steps):
        total, within, ahead = f"_sum{i}", f"_inside{i}", f"_before{i}"
        picked = F.max_by if step.forward else F.min_by
        ends = F.struct(at) if step.scan == "lag" else F.when(F.col(total).isNotNull(), F.struct(at))
        wholes.append((F.sum(total) if step.scan == "sum" else picked(total, ends)).alias(f"_whole{i}"))
        across[ahead] = _scanned(step.scan, f"_whole{i}", Window.orderBy(place.asc() if step.forward else place.desc()))
        inner = Window.partitionBy("_block").orderBy(at.asc() if step.forward else at.desc())
        inside[within] = _scanned(step.scan, total, inner)
        both = F.coalesce(within, zero) + F.coalesce(ahead, zero)
        carries[f"_carry{i}"] = both if step.scan == "sum" else F.coalesce(within, ahead)
    blocks = placed.groupBy("_block").agg(*wholes).withColumns(across)
    left, right = placed.withColumns(inside).alias("l"), blocks.alias("r")
    joined = left.join(right, F.col("l._block").eqNullSafe(F.col("r._block")))
    return joined.select("l.*", *[f"r.{c}" for c in across]).withColumns(carries)


def scan_steps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, steps: Mapping[str, Step]
) -> DataFrame:
    """``df`` with one column for each of ``steps``; all of them share one aggregate, one scan and one join back."""
    outs, todo = list(steps), list(steps.values())
    values = [f"_value{i}" for i in range(len(todo))]
    base = _slotted(df, keys, chunk, **{v: step.value for v, step in zip(values, todo, strict=True)})
    at = F.struct(*order)
    sums = [step.summary(v, at).alias(f"_sum{i}") for i, (v, step) in enumerate(zip(values, todo, strict=True))]
    slots = base.groupBy(SLOT).agg(*sums)
    block = None if keys else _block_of(slots)
    if block is None:
        scans = {f"_carry{i}": _scanned(s.scan, f"_sum{i}", _across(keys, s.forward)) for i, s in enumerate(todo)}
        carried = slots.withColumns(scans)
    else:
        carried = _two_levels(slots, block, todo)
    carry = lambda i, s: F.coalesce(f"_carry{i}", F.lit(0)) if s.scan == "sum" else F.col(f"_carry{i}")
    joined = base.join(carried.select(SLOT, *[carry(i, s).alias(f"_carry{i}") for i, s in enumerate(todo)]), SLOT)
    ways = {True: [F.col(c) for c in order], False: [F.col(c).desc() for c in order]}
    inner = {way: Window.partitionBy(SLOT).orderBy(*by) for way, by in ways.items()}
    done = {out: s.result(values[i], inner[s.forward], F.col(f"_carry{i}")) for i, (out, s) in enumerate(steps.items())}
    # results first go beside the row, so that a step may replace a column that another one reads
    fresh = joined.withColumns({f"_done{i}": done[out] for i, out in enumerate(outs)})
    rest = [F.col(f"`{c}`") for c in df.columns if c not in outs]
    return fresh.select(*rest, *[F.col(f"_done{i}").alias(out) for i, out in enumerate(outs)])


def running_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, flag: Column, out: str
) -> DataFrame:
    """How many rows up to and including this one satisfy ``flag``."""
    return scan_steps(df, keys, order, chunk, {out: count_of(flag)})


def event_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, starts: Column, out: str
) -> DataFrame:
    """Number the groups that begin at rows where ``starts`` holds: null before the first, then 0, 1, 2, ..."""
    return running_count(df, keys, order, chunk, starts, out).withColumn(out, group_number(F.col(out)))


def group_number(starts: Column) -> Column:
    """The group of a row by the number of starts up to it: null before the first, then 0, 1, 2, ..."""
    return F.nullif(starts - 1, F.lit(-1).cast("bigint"))


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column, out: str
) -> DataFrame:
    """The last non-null ``value`` at or before each row."""
    return scan_steps(df, keys, order, chunk, {out: last_of(value)})


def carry_backward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column, out: str
) -> DataFrame:
    """The first non-null ``value`` at or after each row."""
    return scan_steps(df, keys, order, chunk, {out: next_of(value)})


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column, out: str
) -> DataFrame:
    """``value`` of the row just before; null for the first row of a key."""
    return scan_steps(df, keys, order, chunk, {out: before(value)})


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, out: str) -> DataFrame:
    """1, 2, 3, ... in ``order``."""
    return scan_steps(df, keys, order, chunk, {out: number()})


def dense_ranks(df: DataFrame, keys: Sequence[str], by: str, chunk: Column, out: str) -> DataFrame:
    """Dense rank by one column."""
    return scan_steps(df, keys, [by], chunk, {out: rank_of(by)})


def ntiles(df: DataFrame, order: Sequence[str], chunk: Column, tiles: int, out: str) -> DataFrame:
    """``ntile`` over the whole table: positions come from chunk counts, so no task sees all rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    numbered = row_numbers(df, [], order, chunk, "_row").withColumn("_total", total)
    size, extra = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    head = extra * (size + 1)
    tile = F.when(F.col("_row") <= head, F.floor((F.col("_row") - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((F.col("_row") - 1 - head) / F.greatest(size, F.lit(1))) + 1
    )
    return numbered.withColumn(out, tile.cast("bigint")).drop("_row", "_total")
