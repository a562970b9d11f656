"""Responses as full history and as a stream, late acknowledgements, and contract details."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlake.functions import vlong, vstr
from ledgerlake.plans import classic_silver
from ledgerlake.run import Run
from ledgerlake.session import new_folder
from ledgerlake.sources import read_responses, stream_responses
from ledgerlake.streaming import ClosedHours, matched_packets
from workload import query, table
from workload.chain_queries import O
from workload.table_queries import response_lines

NOW = Run(datetime(2024, 1, 1))
ANSWERED = f"""
WITH {O} SELECT o_orderkey AS block_number, d // 100 * 100 AS _partition_by_block_id, o_custkey AS cust, md5(CAST(o_orderkey AS VARCHAR)) AS id
FROM o WHERE status <> 'P'
"""


def _published(responses):
    return responses.select("block_number", "_partition_by_block_id", vlong("data", "result.cust").alias("cust"), "id")


@query(ANSWERED)
def response_history(spark, sf):
    """All responses that ever landed, whatever the age of their files."""
    path = response_lines(spark, sf)
    return _published(read_responses(spark, path, root=f"{path}/"))


@query(ANSWERED)
def response_stream(spark, sf):
    """The same responses as a stream of files; a second run finds nothing new."""
    path = response_lines(spark, sf)
    out, mark = new_folder(spark, "streamed"), new_folder(spark, "checkpoint")
    rows = _published(stream_responses(spark, path, root=f"{path}/"))
    for _ in range(2):
        run = rows.writeStream.format("parquet").option("checkpointLocation", mark).option("path", out).trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query("SELECT o_orderkey AS seq, strftime(o_orderdate, '%Y-%m-%d') AS sent FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 5 <= 2")
def late_acknowledgements(spark, sf):
    """Packets whose acknowledgement comes up to two days later; some come late, some twice, some never."""
    path = new_folder(spark, "packets")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderstatus")
    sent = orders.select("seq", "at", F.lit("send_packet").alias("kind"))
    later = F.expr("at + make_dt_interval(cast(seq % 5 as int))")
    back = orders.where("o_orderstatus <> 'O'").select("seq", later.alias("at"), F.lit("acknowledge_packet").alias("kind"), F.explode(F.expr("if(o_orderstatus = 'P', array(1, 2), array(1))"))).drop("col")
    packets = sent.unionByName(back)
    packets.write.parquet(path)

    def arriving(kind: str):
        return spark.readStream.schema(packets.schema).parquet(path).where(F.col("kind") == kind).select("seq", "at")

    out = new_folder(spark, "matched")
    matched = matched_packets(arriving("send_packet"), arriving("acknowledge_packet"), ["seq"], "at", "2 days")
    run = matched.writeStream.format("parquet").option("checkpointLocation", new_folder(spark, "checkpoint")).option("path", out).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(matched.schema).parquet(out).select("seq", F.date_format("at", "yyyy-MM-dd").alias("sent"))


@query("""
SELECT 'bulk' || s_suppkey // 50 || '-/bulk_get_contract_info-con' || s_suppkey AS _uk, 'bulk' || s_suppkey // 50 AS source,
  '/bulk_get_contract_info' AS route, 'con' || s_suppkey AS address, s_name AS admin, s_suppkey AS code_id, 'wallet' || s_nationkey AS creator,
  CAST(s_nationkey AS BIGINT) AS nation
FROM supplier
""")
def contract_info(spark, sf):
    """Contract details from bulk answers of fifty contracts each; later answers and other routes change nothing."""
    c = F.col
    text = c("s_suppkey").cast("string")
    name = F.concat(F.lit("bulk"), F.floor(c("s_suppkey") / 50).cast("string"))
    answers = table(spark, sf, "supplier").select(
        "*", name.alias("name"),
        F.inline(F.array(*[F.struct(F.lit(day).alias("day"), F.lit(path).alias("path")) for day, path in ((1, "/bulk_get_contract_info"), (2, "/bulk_get_contract_info"), (0, "/other"))])),
    )
    admin = F.when(c("day") == 1, c("s_name")).otherwise(F.lit("later"))
    details = F.struct(
        F.concat(F.lit("con"), text).alias("address"), admin.alias("admin"), c("s_suppkey").alias("code_id"),
        F.concat(F.lit("wallet"), c("s_nationkey").cast("string")).alias("creator"), F.struct(c("s_nationkey").alias("nation")).alias("init_msg"),
    )
    # at most fifty details meet in one answer
    bulk = answers.groupBy("name", "day", "path").agg(F.collect_list(F.struct(details.alias("contract_info"))).alias("response_data"))
    api = bulk.select(
        F.parse_json(F.to_json(F.struct("name", F.struct("path").alias("request_meta"), "response_data"))).alias("data"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), c("day") + 1, F.lit(0), F.lit(0), F.lit(0)).alias("_inserted_timestamp"),
    )
    rows = classic_silver.contract_info(api, NOW)
    return rows.select("_uk", "source", "route", "address", "admin", "code_id", "creator", vlong("init_msg", "nation").alias("nation"))


@query("""
SELECT 'token' || p_partkey AS token_contract, 'WORMHOLE' AS description FROM part
WHERE p_size % 2 = 1 AND TIMESTAMP '2021-05-20' + INTERVAL 1 DAY * p_size > TIMESTAMP '2021-06-01'
""")
def token_contracts(spark, sf):
    """Contracts that the bridge's wallet created since it exists."""
    c = F.col
    creator = F.when(c("p_size") % 2 == 1, F.lit(classic_silver.WORMHOLE)).otherwise(F.concat(F.lit("user"), c("p_size").cast("string")))
    attributes = F.struct(creator.alias("creator"), F.concat(F.lit("token"), c("p_partkey").cast("string")).alias("contract_address"))
    events = table(spark, sf, "part").select(
        F.expr("timestamp_ntz '2021-05-20 00:00:00' + make_dt_interval(p_size)").alias("block_timestamp"), F.parse_json(F.to_json(attributes)).alias("event_attributes"),
    )
    return classic_silver.token_contracts(events, NOW).select("token_contract", "description")


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n, count(DISTINCT user_id) AS users FROM events
WHERE ts < date_trunc('hour', (SELECT max(ts) FROM events) - INTERVAL 1 DAY) GROUP BY 1
""")
def late_rows_repaired(spark, sf):
    """Hours that a stream publishes a day after their end; a fifth of the rows comes days later and goes to the repair."""
    path, mark = new_folder(spark, "arriving"), new_folder(spark, "checkpoint")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    by_hour = lambda rows: rows.groupBy("hour").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))
    closed = ClosedHours(spark, new_folder(spark, "closed"), ["event_id"], "ts", by_hour, timedelta(days=1), part="month")
    # the second wave holds the newest rows, the last one rows of all days and some that were there before
    late, early = F.col("event_id") % 5 == 0, F.col("ts") < F.lit(datetime(2024, 1, 12, 5))
    for wave in (events.where(~late & early), events.where(~late & ~early), events.where(late | (F.col("event_id") % 7 == 0))):
        wave.write.mode("append").parquet(path)
        closed.run(spark.readStream.schema(events.schema).parquet(path), mark)
    closed.repair()
    return closed.published.read().select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n", "users")
