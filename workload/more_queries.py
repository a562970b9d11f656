"""Stored balance history, contract-read balances and the coins expected from pool calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.plans import classic_bronze, classic_silver
from ledgerlake.quality.pool_pairs import wrong_pairs
from ledgerlake.run import Run
from workload import chainlike as cl
from workload import query, table
from workload.classiclike import Classic
from workload.relational import cents, last_event


@query("""
SELECT 'c' || o_custkey AS address, o_orderkey * 1000 AS block_number, CAST(round(o_totalprice * 100) AS BIGINT) AS balance,
  CASE WHEN o_orderkey * 1000 <= 3820000 THEN 'columbus-3' WHEN o_orderstatus = 'O' THEN 'columbus-5' ELSE 'columbus-4' END AS blockchain,
  '2000-01-01' AS loaded
FROM orders WHERE o_orderstatus <> 'P'
""")
def history_balances(spark, sf):
    """Stored history without balances of zero; its chain version follows from height, time and chain name."""
    zero = F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(cents("o_totalprice").cast("double"))
    history = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("address"), zero.alias("balance"),
        F.lit("liquid").alias("balance_type"), (F.col("o_orderkey") * 1000).alias("block_number"),
        F.col("o_orderdate").alias("block_timestamp"),
        F.when(F.col("o_orderstatus") == "O", "terra-5").otherwise("terra").alias("blockchain"), F.lit("LUNA").alias("currency"),
    )
    logged = Classic(spark, sf).no_history.withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("system_created_at", "_inserted_timestamp")}
    )
    rows = classic_silver.balances(logged, history)
    return rows.select(
        "address", "block_number", F.col("balance").cast("bigint").alias("balance"), "blockchain",
        F.date_format("_inserted_timestamp", "yyyy-MM-dd").alias("loaded"),
    )


@query("""
WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, arg_max(value, ts) AS v FROM events GROUP BY 1, 2, 3),
s AS (SELECT user_id, event_type, unnest(generate_series(min(day), (SELECT max(day) FROM d), INTERVAL 1 DAY)) AS day FROM d GROUP BY 1, 2)
SELECT lpad(CAST(s.user_id AS VARCHAR), 44, 'w') AS address, s.event_type AS currency, strftime(s.day, '%Y-%m-%d') AS day, false AS is_native,
  last_value(v IGNORE NULLS) OVER (PARTITION BY s.user_id, s.event_type ORDER BY s.day ROWS UNBOUNDED PRECEDING) AS balance
FROM s LEFT JOIN d ON s.user_id = d.user_id AND s.event_type = d.event_type AND CAST(s.day AS DATE) = d.day
""")
def synthetic_balances(spark, sf):
    """Balances read from contracts: the wallet is cut out of the call's input, each day keeps its last value."""
    c = F.col
    coin = F.struct(c("event_type").alias("denom"), c("value").cast("string").alias("amount"))
    entry = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("block_timestamp"),
        F.concat(F.lit("x" * 24), F.lpad(c("user_id").cast("string"), 44, "w")).alias("inputs"),
        F.struct(F.array(coin).alias("balances")).alias("value_obj"),
    )
    kind = F.struct(F.lit(classic_bronze.SYNTHETIC_CLASSES[0]).alias("class"))
    log = table(spark, sf, "events").select(
        F.parse_json(F.lit('{"CreateTime":1000}')).alias("record_metadata"),
        F.parse_json(F.to_json(F.struct(kind.alias("model"), F.array(entry).alias("results")))).alias("record_content"),
        c("ts").alias("_inserted_timestamp"),
    )
    rows = classic_silver.block_synthetic_balances(classic_bronze.classic_synthetic_balances(log), Run(last_event(spark, sf)))
    return rows.select("address", "currency", F.date_format("date", "yyyy-MM-dd").alias("day"), "is_native", "balance")


@query("""
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS tx_id, o_orderkey AS amount, 'AMERICA' AS currency FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
""")
def pool_pairs(spark, sf):
    """Provide calls to a labelled pool; the table under test misses the pool token of orders with status F."""
    c = F.col
    rows = cl.orders(spark, sf).withColumn("pool", F.when(c("priority") == cl.URGENT, "pool1").otherwise("none"))
    value = F.struct(c("pool").alias("contract"), F.struct(F.struct(F.lit(1).alias("x")).alias("provide_liquidity")).alias("msg"))
    key = c("o_orderkey").cast("string")
    logs = F.create_map(
        F.lit("_contract_address_0"), c("pool"), F.lit("share"), key,
        F.lit("assets"), F.concat(c("cents"), F.lit("uluna, "), c("o_custkey").cast("string"), F.lit("uusd")),
    )
    messages = rows.select(
        c("hash").alias("tx_id"), F.parse_json(F.to_json(value)).alias("message_value"),
        F.create_map(F.lit("wasm"), logs).alias("attributes"),
    )
    labels = table(spark, sf, "region").select(
        F.concat(F.lit("pool"), c("r_regionkey").cast("string")).alias("address"), c("r_name").alias("label"),
        F.lit("pool").alias("label_subtype"),
    )
    urgent = rows.where(c("priority") == cl.URGENT)
    dec = lambda x: x.cast("decimal(38,0)").alias("amount")
    actual = (
        urgent.select(c("hash").alias("tx_id"), dec(c("cents")), F.lit("uluna").alias("currency"))
        .unionByName(urgent.select(c("hash").alias("tx_id"), dec(c("o_custkey")), F.lit("uusd").alias("currency")))
        .unionByName(urgent.where(c("status") != "F").select(c("hash").alias("tx_id"), dec(c("o_orderkey")), F.lit("AMERICA").alias("currency")))
    )
    return wrong_pairs(actual, labels, messages).select("tx_id", c("amount").cast("bigint").alias("amount"), "currency")
