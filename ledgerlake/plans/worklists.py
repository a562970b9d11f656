"""What is still to be fetched: blocks, transaction searches, pages, block metadata and repairs.

Requests are JSON text, one per row. The calls themselves are not made here; their responses land as files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import vlong, vstr, vvar
from ledgerlake.operators.flatten import flatten_array_outer
from ledgerlake.operators.gaps import missing_ids, pages
from ledgerlake.operators.ordered import id_chunk, row_numbers
from ledgerlake.sources.numbers import numbers

# First block the current node serves, transactions per page.
FIRST_SERVED_BLOCK = 4109598
PAGE_SIZE = 100
# Fixed value: blocks kept between the chain's head and the newest request.
HEAD_LAG = 500


def head_of(status: Column) -> Column:
    return vlong(status, "result.sync_info.latest_block_height") - HEAD_LAG


def chainhead(status: DataFrame) -> DataFrame:
    """The newest block worth asking for, from a node's status response."""
    return status.select(head_of(F.col("data")).alias("block_id"))


def block_universe(spark: SparkSession, head: int) -> DataFrame:
    """streamline.blocks: every block number up to the head."""
    return numbers(spark, head, 1, "block_id")


def max_block_by_date(silver_blocks: DataFrame) -> DataFrame:
    """Highest block per day; the newest day is still open and left out."""
    days = silver_blocks.groupBy(F.to_date("block_timestamp").alias("block_date")).agg(
        F.max("block_height").alias("block_id")
    )
    newest = days.agg(F.max("block_date")).scalar()
    return days.where(F.col("block_date") != newest)


def third_newest_day(by_date: DataFrame):
    """Highest block of the third-newest full day: a top-3 read on the driver; None with fewer days."""
    top = by_date.orderBy(F.desc("block_id")).limit(3).collect()
    return top[2]["block_id"] if len(top) == 3 else None


def _rpc(method: str, params: str) -> Column:
    block = F.col("block_id").cast("string")
    return F.concat(
        F.lit('{"jsonrpc": "2.0","method": "' + method + '", "params":['), F.expr(params), F.lit('],"id":"'), block, F.lit('"}')
    )


def missing_block_requests(universe: DataFrame, by_date: DataFrame, landed: DataFrame) -> DataFrame:
    """One ``block`` request per block that has not landed since the third-newest full day (with fewer: ever)."""
    missing = missing_ids(_since(universe, by_date), landed.select(F.col("block_number").alias("block_id")), "block_id")
    return missing.select("block_id", _rpc("block", "concat('\"', cast(block_id as string), '\"')").alias("request"))


def missing_search_requests(universe: DataFrame, by_date: DataFrame, landed: DataFrame) -> DataFrame:
    """One first-page ``tx_search`` request per block without a search response."""
    missing = missing_ids(_since(universe, by_date), landed.select(F.col("block_number").alias("block_id")), "block_id")
    text = "concat('\"tx.height=', cast(block_id as string), '\",true, \"1\" ,\"100\" ,\"asc\"')"
    return missing.select("block_id", _rpc("tx_search", text).alias("request"))


def _since(universe: DataFrame, by_date: DataFrame) -> DataFrame:
    """With fewer than three full days every block is asked for."""
    first = third_newest_day(by_date)
    return universe if first is None else universe.where(F.col("block_id") >= first)


def missing_page_requests(silver_blocks: DataFrame, by_date: DataFrame, landed: DataFrame) -> DataFrame:
    """``tx_search`` requests for pages 2.. of blocks with more than one page of transactions.

    Pages come from the declared count (no join with a list of page numbers). Responses whose metadata starts with
    a first-page marker are ignored.
    """
    first = third_newest_day(by_date)
    recent = F.lit(True) if first is None else F.col("block_id") > first
    busy = silver_blocks.where(
        (F.col("block_id") > FIRST_SERVED_BLOCK) & (F.col("tx_count") > PAGE_SIZE) & recent
    )
    wanted = busy.select(
        "block_id", F.explode(pages(F.col("tx_count"), PAGE_SIZE, 2)).alias("id")
    ).distinct()
    answered = landed.where(~F.coalesce(F.to_json("metadata").startswith('"1",'), F.lit(False))).select(
        F.col("block_number").alias("block_id"), vlong("metadata", "request.params[2]").alias("id")
    )
    missing = wanted.join(answered, ["block_id", "id"], "left_anti")
    text = "concat('\"tx.height=', cast(block_id as string), '\",true, \"', cast(id as string), '\" ,\"100\" ,\"asc\"')"
    return missing.select("block_id", "id", _rpc("tx_search", text).alias("request"))


def batched_calls(missing: DataFrame, column: str, size: int, method: str, params: Column):
    """All missing numbers in batches of ``size`` request texts; batch 1 holds the newest, the last one may be shorter.

    A caller with a limited budget takes batches from 1 upward and comes back for the rest.
    """
    backwards = missing.select(column).distinct().withColumn("_back", -F.col(column))
    numbered = row_numbers(backwards, [], ["_back"], id_chunk(F.col("_back"), 1000), "_row")
    batches = numbered.withColumn("grp", F.floor((F.col("_row") - 1) / size) + 1)
    call = F.to_json(
        F.struct(F.col(column).alias("id"), F.lit("2.0").alias("jsonrpc"), F.lit(method).alias("method"), params.alias("params"))
    )
    ordered = F.sort_array(F.collect_list(F.struct(F.col(column).alias("n"), call.alias("call"))))
    return batches.groupBy("grp").agg(F.transform(ordered, lambda c: c["call"]).alias("calls"))


def block_params(column: str = "block_id") -> Column:
    return F.array(F.col(column).cast("string"))


def search_params(column: str = "block_id") -> Column:
    """The page size is the node's largest and the last flag asks for ordered events."""
    text = lambda v: F.lit(v)
    return F.array(
        F.concat(F.lit("tx.height="), F.col(column).cast("string")),
        text("true"), text("1"), text("1000"), text("asc"), text("true"),
    )


def header_ranges(blocks: DataFrame, known: DataFrame | None, width: int = 20, per_call: int = 100):
    """Header requests for runs of ``width`` pending block numbers, ``per_call`` runs per call, as many calls as needed.

    Blocks are ordered by number; for heights of equally many digits that is also their order as text.
    """
    pending = blocks.select("block_id").distinct()
    if known is not None:
        pending = pending.join(known.select("block_id"), "block_id", "left_anti")
    numbered = row_numbers(pending, [], ["block_id"], id_chunk(F.col("block_id"), 1000), "rn")
    runs = numbered.groupBy(F.floor((F.col("rn") - 1) / width).alias("run")).agg(
        F.min("block_id").cast("string").alias("min_block"), F.max("block_id").cast("string").alias("max_block")
    )
    call = F.to_json(
        F.struct(
            F.lit("2.0").alias("jsonrpc"),
            F.col("min_block").cast("bigint").alias("id"),
            F.lit("blockchain").alias("method"),
            F.array("min_block", "max_block").alias("params"),
        )
    )
    sorted_calls = F.sort_array(F.collect_list(F.struct(F.col("run"), call.alias("call"))))
    return runs.groupBy((F.floor(F.col("run") / per_call) + 1).alias("groupid_out")).agg(
        F.transform(sorted_calls, lambda c: c["call"]).alias("call")
    )


def land_responses(results: DataFrame, run) -> DataFrame:
    """Batch responses to one row per answered block; an empty answer keeps one row of nulls."""
    flat = flatten_array_outer(results, vvar("data", "data"), "answer", "answer_index")
    block = vlong("answer", "id")
    return flat.select(
        F.lit(None).cast("variant").alias("value"),
        F.round(block, -3).alias("_partition_by_block_id"),
        block.alias("block_number"),
        vvar("data", "headers").alias("metadata"),
        F.col("answer").alias("data"),
        run.clock.alias("_inserted_timestamp"),
    )


def repair_list(seed: DataFrame, answered: DataFrame | None) -> DataFrame:
    """All transaction ids still without a repair response."""
    wanted = seed.select("tx_id").distinct()
    if answered is not None:
        done = answered.where(vstr("data", "data.tx_response.height").isNotNull()).select("tx_id")
        wanted = wanted.join(done, "tx_id", "left_anti")
    return wanted
