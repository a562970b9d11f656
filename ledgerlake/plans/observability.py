"""Completeness reports.

A run gives one summary row, appended to a log that the next run reads, and the impacted blocks one per row. The
summary holds counts and the lowest impacted block, never a list, so its size does not depend on what is missing.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import vlong, vstr, vvar
from ledgerlake.incremental.models import Fresh, IdRange, Model, ModelSet
from ledgerlake.operators.flatten import flatten_array
from ledgerlake.operators.gaps import fill_gaps, sequence_gaps
from ledgerlake.plans.worklists import FIRST_SERVED_BLOCK
from ledgerlake.run import Run


def last_report(log: DataFrame | None):
    """What the previous run saw: its newest block time and its lowest impacted block."""
    if log is None:
        return None, None
    seen = log.agg(F.max("max_block_timestamp").alias("seen")).first()["seen"]
    last = log.agg(F.max_by("first_impacted_block", "test_timestamp").alias("low")).first()
    return seen, last["low"]


def blocks_to_check(blocks: DataFrame, run: Run, log: DataFrame | None = None, full: bool = False) -> DataFrame:
    """Blocks older than a day; after the first run only the last 96 hours and whatever was flagged last time."""
    old = blocks.where(F.col("block_timestamp") < F.lit(run.now - timedelta(hours=24)))
    if log is None:
        return old
    seen, low = last_report(log)
    again = [F.lit(False)]
    if seen is not None:
        again.append(F.col("block_timestamp") >= F.lit(seen - timedelta(hours=96)))
    if full:
        again.append(F.col("block_id") >= 0)
    elif low is not None:
        again.append(F.col("block_id") >= low - 1)
    return old.where(reduce(lambda a, b: a | b, again))


def block_gaps(checked: DataFrame, width: int = 100_000) -> DataFrame:
    """(prev_block_id, block_id) around every gap; found per id range, so no task sees all blocks."""
    ids = checked.select("block_id").distinct()
    return sequence_gaps(ids, "block_id", width=width).select("prev_block_id", "block_id", "gap")


def _checked(blocks: DataFrame, run: Run, log: DataFrame | None, full: bool, first_block: int) -> DataFrame:
    served = blocks.where(F.col("block_id") > first_block)
    return blocks_to_check(served, run, log, full).select("block_id", "block_timestamp")


def impacted_blocks(
    blocks: DataFrame, run: Run, log: DataFrame | None = None, full: bool = False, first_block: int = FIRST_SERVED_BLOCK
) -> DataFrame:
    """One row per missing block, with the present blocks on both sides of its gap."""
    gaps = block_gaps(_checked(blocks, run, log, full, first_block)).withColumnRenamed("block_id", "next_block_id")
    return fill_gaps(gaps, "prev_block_id", "next_block_id", "block_id").select(
        F.lit("blocks").alias("test_name"), "block_id", "prev_block_id", "next_block_id", run.clock.alias("test_timestamp")
    )


def blocks_completeness(
    blocks: DataFrame, run: Run, log: DataFrame | None = None, full: bool = False, first_block: int = FIRST_SERVED_BLOCK
) -> DataFrame:
    """The summary row. Every number between the lowest and the highest block is either present or inside a gap."""
    checked = _checked(blocks, run, log, full, first_block)
    gaps = block_gaps(checked)
    seen = checked.agg(
        F.min("block_id").alias("min_block"),
        F.max("block_id").alias("max_block"),
        F.min("block_timestamp").alias("min_block_timestamp"),
        F.max("block_timestamp").alias("max_block_timestamp"),
        F.count(F.lit(1)).alias("present"),
    )
    details = gaps.agg(
        F.coalesce(F.sum("gap"), F.lit(0)).alias("blocks_impacted_count"),
        (F.min("prev_block_id") + 1).alias("first_impacted_block"),
    )
    one = F.lit(1).alias("one")
    joined = seen.select(one, "*").join(details.select(one, "*"), "one")
    return joined.select(
        F.lit("blocks").alias("test_name"),
        "min_block", "max_block", "min_block_timestamp", "max_block_timestamp",
        (F.col("present") + F.col("blocks_impacted_count")).alias("blocks_tested"),
        "blocks_impacted_count", "first_impacted_block",
        run.clock.alias("test_timestamp"),
    )


NUMBERS = ["block_id", "block_id_requested", "height"]


def sent_transactions(responses: DataFrame) -> DataFrame:
    """Transactions of responses under three block numbers: stored, requested and stated by the transaction."""
    rows = responses.select(
        F.col("block_number").alias("block_id"),
        F.replace(vstr("metadata", "request.params[0]"), F.lit("tx.height="), F.lit(""))
        .try_cast("bigint")
        .alias("block_id_requested"),
        vvar("data", "result.txs").alias("txs"), "_inserted_timestamp",
    )
    return flatten_array(rows, F.col("txs"), "tx", "i").select(
        "block_id", "block_id_requested", vlong("tx", "height").alias("height"), vstr("tx", "hash").alias("tx_id"), "_inserted_timestamp"
    )


def landed_model(width: int = 100_000) -> Model:
    """The state behind the report: each transaction that ever landed, once for each set of numbers, filed under each of
    them. A run adds what landed since the last one; payloads are never read again."""

    def build(inputs: dict[str, DataFrame], run: Run) -> DataFrame:
        sent = sent_transactions(inputs["tx_responses"])
        once = sent.groupBy(*NUMBERS, "tx_id").agg(F.max("_inserted_timestamp").alias("_inserted_timestamp"))
        numbers = F.array_compact(F.array_distinct(F.array(*NUMBERS)))
        return once.select("*", F.explode(numbers).alias("near"))

    keys = [*NUMBERS, "tx_id", "near"]
    return Model("landed_transactions", keys, IdRange("near", width), {"tx_responses": Fresh()}, build, "delete_insert", ())


def landed_near(built: ModelSet, checked: DataFrame) -> DataFrame:
    """Stored transactions with a number inside the span of the blocks under check, read from these partitions alone."""
    span = checked.agg(F.min("block_id").alias("low"), F.max("block_id").alias("high")).first()
    part = next(m for m in built.models if m.name == "landed_transactions").part
    low, high = (span.low, span.high) if span.low is not None else (0, -1)
    rows = built.table("landed_transactions").read(part.names(low, high))
    if rows is None:
        raise ValueError("landed_transactions is not built")
    return rows.where(F.col("near").between(F.lit(low), F.lit(high))).select(*NUMBERS, "tx_id").distinct()


def landed_transactions(sent: DataFrame, checked: DataFrame, manual: DataFrame | None) -> DataFrame:
    """Transactions of which a block number is under check."""
    times = checked.select(F.col("block_id").alias("id"), F.col("block_timestamp").alias("at"))

    def on(df: DataFrame, column: str, out: str) -> DataFrame:
        side = times.select(F.col("id").alias(column), F.col("at").alias(out))
        return df.join(side, column, "left")

    known = on(on(on(sent, "block_id", "t_block"), "block_id_requested", "t_requested"), "height", "t_height")
    kept = known.where(F.coalesce("t_block", "t_requested", "t_height").isNotNull()).select(
        "block_id", "block_id_requested", "height", F.col("t_block").alias("block_timestamp"), "tx_id"
    )
    if manual is None:
        return kept
    same = F.col("block_id")
    return kept.unionByName(
        manual.select(
            "block_id", same.alias("block_id_requested"), same.alias("height"), "block_timestamp", "tx_id"
        )
    )


def counted_transactions(landed: DataFrame) -> DataFrame:
    """Per block the best of three counting rules.

    Each row is counted under its three block numbers in one pass over the input. Per rule one row per (block,
    transaction) is kept first, which is combined on the map side and thins out re-sent pages before they move.
    """
    rules = F.array(
        *[
            F.struct(F.lit(i).alias("rule"), F.col(c).alias("block"))
            for i, c in enumerate(NUMBERS)
        ]
    )
    rows = landed.select("tx_id", "block_timestamp", F.col("block_id").alias("_stored"), F.inline(rules))
    once = rows.groupBy("rule", "block", "tx_id").agg(F.max_by("block_timestamp", "_stored").alias("at"))
    by_rule = once.groupBy("rule", F.col("block").alias("block_id")).agg(
        F.min("at").alias("block_timestamp"), F.count("tx_id").alias("num_txs")
    )
    return by_rule.groupBy("block_id", "block_timestamp").agg(F.max("num_txs").alias("num_txs"))


def compared_transactions(counted: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared blocks with what was found: ``diff`` is found minus declared."""
    found = counted.select("block_id", F.col("num_txs").alias("found"))
    joined = declared.select("block_id", "block_timestamp", "num_txs").join(found, "block_id", "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(0))).withColumn("diff", F.col("found") - F.col("num_txs"))


def block_counts(
    landed: DataFrame | ModelSet,
    blocks: DataFrame,
    declared: DataFrame,
    run: Run,
    manual: DataFrame | None = None,
    log: DataFrame | None = None,
    full: bool = False,
    first_block: int = FIRST_SERVED_BLOCK,
) -> DataFrame:
    """One row per checked block: its declared transactions against the best of three counts of what landed.

    ``landed`` is the set that holds ``landed_model``, of which only the blocks under check are read, or raw responses.
    Both are bound by the blocks under check, whenever the responses landed.
    """
    checked = blocks_to_check(blocks, run, log, full).select("block_id", "block_timestamp")
    sent = landed_near(landed, checked) if isinstance(landed, ModelSet) else sent_transactions(landed).drop("_inserted_timestamp")
    counted = counted_transactions(landed_transactions(sent, checked, manual))
    span = checked.agg(F.min("block_timestamp").alias("lo"), F.max("block_timestamp").alias("hi")).first()
    expected = declared.where(
        F.col("block_timestamp").between(F.lit(span["lo"]), F.lit(span["hi"])) & (F.col("block_id") > first_block)
    )
    return compared_transactions(counted, expected)


def impacted_transactions(counts: DataFrame, run: Run) -> DataFrame:
    """The rows of ``block_counts`` whose numbers differ."""
    return counts.where(F.col("diff") != 0).select(
        F.lit("transactions").alias("test_name"), "block_id", "block_timestamp", "diff",
        F.col("num_txs").alias("blockchain_num_txs"), F.col("found").alias("bronze_num_txs"),
        run.clock.alias("test_timestamp"),
    )


def transactions_completeness(counts: DataFrame, run: Run) -> DataFrame:
    """The summary row of ``block_counts``."""
    off = F.col("diff") != 0
    return counts.agg(
        F.lit("transactions").alias("test_name"),
        F.min("block_id").alias("min_block"),
        F.max("block_id").alias("max_block"),
        F.min("block_timestamp").alias("min_block_timestamp"),
        F.max("block_timestamp").alias("max_block_timestamp"),
        F.count(F.lit(1)).alias("blocks_tested"),
        F.count_if(off).alias("blocks_impacted_count"),
        F.min(F.when(off, F.col("block_id"))).alias("first_impacted_block"),
        F.sum(F.abs("diff")).alias("transactions_impacted_count"),
        run.clock.alias("test_timestamp"),
    )
