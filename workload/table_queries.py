"""Incremental tables, checks, sources and streams."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlake import quality
from ledgerlake.functions import vlong
from ledgerlake.incremental import KeyedTable, earliest_touched_hour, since_mark, since_mark_minus
from ledgerlake.incremental.table import date_part, hash_part
from ledgerlake.incremental.watermark import from_hour, lookback_days, since_mark_date
from ledgerlake.operators.dedupe import latest_by
from ledgerlake.operators.ordered import time_chunk
from ledgerlake.plans import chain_silver, observability
from ledgerlake.quality import CheckPlan, stored
from ledgerlake.run import Run
from ledgerlake.session import new_folder
from ledgerlake.sources import read_responses, read_seed, write_append, write_full
from ledgerlake.streaming import hourly_counts, run_available
from workload import chainlike as cl
from workload import query, table
from workload.chain_queries import O
from workload.chainlike import Chain
from workload.relational import cents, last_event


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", cents("o_totalprice").alias("v"))


def _before(year: int):
    return F.col("o_orderdate") < F.lit(datetime(year, 1, 1))


# ---------------------------------------------------------------- upserts


@query("""
SELECT o_orderkey, year(o_orderdate) + CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS y,
  CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS v FROM orders
""")
def upsert_delete_insert(spark, sf):
    """Two overlapping batches; the second also moves some keys to another partition."""
    orders = _orders(spark, sf)
    target = KeyedTable(spark, new_folder(spark, "upsert"), ["o_orderkey"], F.year("o_orderdate"))
    target.delete_insert(orders.where(_before(1999)))
    moved = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("interval 1 year")).otherwise(F.col("o_orderdate"))
    target.delete_insert(orders.where(~_before(1998)).withColumns({"v": F.col("v") + 1, "o_orderdate": moved}))
    return target.read().select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("y"), "v")


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'second' ELSE 'first' END AS modified,
  CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'second' ELSE 'first' END AS inserted,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderstatus END AS extra FROM orders
""")
def upsert_merge(spark, sf):
    """A merge that keeps the first insert mark, appends a new column and is run twice (nothing changes)."""
    orders = _orders(spark, sf).select("o_orderkey", "o_orderdate", "o_orderstatus")
    target = KeyedTable(spark, new_folder(spark, "merge"), ["o_orderkey"], date_part("o_orderdate").substr(1, 4), moves=False)
    mark = lambda df, text: df.withColumns({"inserted": F.lit(text), "modified": F.lit(text)})
    target.merge(mark(orders.where(_before(1999)), "first"), ["inserted"])
    second = mark(orders.where(~_before(1998)), "second").withColumn("extra", F.col("o_orderstatus"))
    target.merge(second, ["inserted"])
    target.merge(second, ["inserted"])
    return target.read().select("o_orderkey", "modified", "inserted", "extra")


def _after_all(spark, sf) -> datetime:
    """A bound behind the newest event, for the last batch."""
    return (last_event(spark, sf) or datetime(2024, 1, 1)) + timedelta(days=1)


def _hours(df):
    return df.groupBy(time_chunk(F.col("ts"), "hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("_inserted_timestamp")
    )


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n FROM events GROUP BY 1
""")
def upsert_bucket(spark, sf):
    """The key is a whole hour: a run recomputes every hour from the earliest one its new rows touch."""
    events = table(spark, sf, "events")
    target = KeyedTable(spark, new_folder(spark, "hours"), ["hour"], date_part("hour"), moves=False)
    for end in [*(datetime(2024, 1, 1) + timedelta(days=day, minutes=30) for day in (10, 20)), _after_all(spark, sf)]:
        arrived = events.where(F.col("ts") < F.lit(end))
        first = earliest_touched_hour(arrived.withColumn("_inserted_timestamp", F.col("ts")), target.read(), "ts")
        target.delete_insert(_hours(from_hour(arrived, first, "ts")))
    return target.read().select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n")


@query("""
SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def incremental_equals_full(spark, sf):
    """Three incremental runs over a growing source end in the state of one full run."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.col("ts").alias("_inserted_timestamp"))
    target = KeyedTable(spark, new_folder(spark, "latest"), ["user_id", "event_type"], hash_part(8, "user_id"), moves=False)
    for end in [*(datetime(2024, 1, 1) + timedelta(days=day) for day in (7, 15)), _after_all(spark, sf)]:
        arrived = events.where(F.col("_inserted_timestamp") < F.lit(end))
        fresh = since_mark(arrived, target.read())
        target.merge(latest_by(fresh, ["user_id", "event_type"], [F.desc("_inserted_timestamp"), F.desc("event_id")]))
    return target.read().select("user_id", "event_type", "event_id")


@query("""
WITH t AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'), m AS (SELECT max(ts) AS m FROM t)
SELECT 'mark' AS rule, count(*) AS n FROM events, m WHERE ts >= m
UNION ALL SELECT 'two days back', count(*) FROM events, m WHERE ts >= m - INTERVAL 2 DAY
UNION ALL SELECT 'date back', count(*) FROM events, m WHERE ts >= CAST(CAST(m AS DATE) - INTERVAL 10 DAY AS TIMESTAMP)
UNION ALL SELECT 'days', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-22'
UNION ALL SELECT 'first run', count(*) FROM events
""")
def lookbacks(spark, sf):
    events = table(spark, sf, "events")
    target = events.where(F.col("ts") < F.lit(datetime(2024, 1, 20)))
    rules = {
        "mark": since_mark(events, target, "ts"),
        "two days back": since_mark_minus(events, target, timedelta(days=2), "ts"),
        "date back": since_mark_date(events, target, 10, "ts"),
        "days": lookback_days(events, datetime(2024, 1, 25), 3, "ts"),
        "first run": since_mark(events, None, "ts"),
    }
    out = None
    for name, rows in rules.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).withColumn("rule", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("""
SELECT c_custkey, c_mktsegment AS label FROM customer WHERE c_acctbal >= 0
""")
def soft_deletes(spark, sf):
    """Labels arrive with a delete flag; the table drops flagged rows after the upsert."""
    customer = table(spark, sf, "customer")
    rows = customer.select(
        "c_custkey", F.col("c_mktsegment").alias("label"), (F.col("c_acctbal") < 0).alias("_is_deleted")
    )
    target = KeyedTable(spark, new_folder(spark, "labels"), ["c_custkey"], hash_part(4, "c_custkey"), moves=False)
    target.merge(rows.withColumn("_is_deleted", F.lit(False)))
    target.merge(rows)
    target.delete_where(F.col("_is_deleted"))
    return target.read().select("c_custkey", "label")


@query("""
SELECT 'terra' AS blockchain, 'acct' || c_custkey AS address, c_mktsegment AS label, 'id' || c_custkey AS dim_labels_id
FROM customer WHERE c_acctbal >= 0 AND c_nationkey < 20
""")
def chain_labels(spark, sf):
    from ledgerlake.plans import chain_gold

    c = F.col
    combined = table(spark, sf, "customer").select(
        cl.RUN.clock.alias("system_created_at"), cl.RUN.clock.alias("insert_date"),
        F.when(c("c_nationkey") < 20, "terra").otherwise("other").alias("blockchain"),
        F.concat(F.lit("acct"), c("c_custkey").cast("string")).alias("address"), F.lit("x").alias("creator"),
        F.lit("t").alias("label_type"), F.lit("s").alias("label_subtype"), c("c_mktsegment").alias("address_name"),
        F.lit("p").alias("project_name"), (c("c_acctbal") < 0).alias("_is_deleted"),
        F.concat(F.lit("id"), c("c_custkey").cast("string")).alias("labels_combined_id"),
    )
    gold = chain_gold.dim_address_labels(chain_silver.address_labels(combined, cl.RUN))
    return gold.select("blockchain", "address", "label", "dim_labels_id")


# ---------------------------------------------------------------- run log and checks


@query(f"""
WITH {O}, b AS (SELECT block, d, n, strptime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM days WHERE day < DATE '1999-12-31'),
m AS (SELECT unnest(generate_series(min(block), max(block))) AS x FROM b), low AS (SELECT min(x) AS x FROM m WHERE x NOT IN (SELECT block FROM b)),
again AS (SELECT block, t FROM (SELECT block, strptime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM days) d
  WHERE t >= (SELECT max(t) FROM b) - INTERVAL 96 HOUR OR block >= (SELECT x FROM low) - 1)
SELECT 1 AS run, max(block) - min(block) + 1 AS blocks_tested FROM b
UNION ALL SELECT 2, max(block) - min(block) + 1 FROM again
""")
def completeness_feedback(spark, sf):
    """The second run re-checks what the first one flagged; the log only grows."""
    blocks = Chain(spark, sf).blocks
    path = new_folder(spark, "report")
    write_append(observability.blocks_completeness(blocks, Run(datetime(2000, 1, 1))), path)
    log = spark.read.parquet(path)
    write_append(observability.blocks_completeness(blocks, Run(datetime(2010, 1, 1)), log), path)
    order = F.when(F.col("test_timestamp") < F.lit(datetime(2005, 1, 1)), 1).otherwise(2)
    return spark.read.parquet(path).select(order.alias("run"), "blocks_tested")


@query("""
WITH n AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS model_tx_count FROM lineitem GROUP BY 1)
SELECT o_orderkey AS l_orderkey, o_custkey % 7 + 1 AS declared, model_tx_count FROM orders JOIN n ON o_orderkey = l_orderkey
WHERE o_custkey % 7 + 1 <> model_tx_count
""")
def tx_gaps(spark, sf):
    blocks = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7 + 1).alias("declared"))
    return quality.tx_gaps(table(spark, sf, "lineitem"), blocks, "l_partkey", "l_orderkey", "declared")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def uniqueness(spark, sf):
    return quality.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, prev AS prev_o_orderkey, o_orderkey, o_orderkey - prev - 1 AS gap FROM (
  SELECT *, lag(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS prev FROM orders WHERE o_orderpriority = '1-URGENT')
WHERE o_orderkey - prev <> 1
""")
def sequence_gap_check(spark, sf):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    found = quality.gaps(table(spark, sf, "orders"), "o_orderkey", ["o_orderstatus"], urgent, "o_orderdate", width=1000)
    return found.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "prev_o_orderkey", "o_orderkey", "gap")


@query("""
SELECT 'accepted' AS "check", 'error' AS severity, count(DISTINCT o_orderpriority) AS violations FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'regex', 'warn', count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '[0-9]-[HLMU]')
UNION ALL SELECT 'not_null', 'error', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'recent', 'warn', CASE WHEN max(o_orderdate) < TIMESTAMP '2001-07-30' THEN 1 ELSE 0 END FROM orders
UNION ALL SELECT 'stale', 'warn', CASE WHEN max(o_orderdate) < TIMESTAMP '2029-12-31' THEN 1 ELSE 0 END FROM orders
UNION ALL SELECT 'types', 'error', 1 FROM (SELECT count(*) FROM orders)
UNION ALL SELECT 'differs', 'error', count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)
  UNION ALL SELECT DISTINCT c_custkey FROM customer WHERE c_nationkey < 5 AND c_custkey NOT IN (SELECT o_custkey FROM orders))
""")
def quality_report(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nulls = orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    expected = {"o_orderkey": ["bigint"], "o_custkey": ["string"], "o_orderdate": ["timestamp_ntz", "timestamp"]}
    few = customer.where(F.col("c_nationkey") < 5).select(F.col("c_custkey").alias("o_custkey"))
    return quality.report(
        {
            "accepted": ("error", quality.accepted_values(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])),
            "regex": ("warn", quality.matches(orders, "o_orderpriority", "[0-9]-[HLMU]")),
            "not_null": ("error", quality.not_null(nulls, "status")),
            "recent": ("warn", quality.recent(orders, "o_orderdate", 2, datetime(2001, 8, 1))),
            "stale": ("warn", quality.recent(orders, "o_orderdate", 1, datetime(2030, 1, 1))),
            "types": ("error", quality.column_types(orders, expected)),
            "differs": ("error", quality.differs_from(orders.select("o_custkey"), few)),
        }
    )


def order_checks() -> CheckPlan:
    """Five checks of a row, which share one scan, and two of groups."""
    late = F.col("o_orderdate") > F.lit(datetime(1998, 1, 1))
    return CheckPlan(
        {
            "priority": ("error", stored.outside("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])), "pattern": ("warn", stored.unlike("o_orderpriority", "[0-9]-[HLMU]")),
            "status": ("error", stored.is_null("status")), "late": ("warn", late & (F.col("o_orderstatus") == "F")), "never": ("error", F.col("o_orderkey") < 0),
        },
        {
            "customers": ("warn", lambda df: quality.unique(df, ["o_custkey", "o_orderpriority"])),
            "days": ("warn", lambda df: quality.gaps(df.select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderkey", ["o_orderstatus"], time="o_orderdate", width=1000)),
        },
    )


def _checked_orders(spark, sf):
    return table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))


@query("""
SELECT 'priority' AS "check", 'error' AS severity, count(*) AS violations FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'pattern', 'warn', count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '[0-9]-[HLMU]')
UNION ALL SELECT 'status', 'error', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'late', 'warn', count(*) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'
UNION ALL SELECT 'never', 'error', 0
UNION ALL SELECT 'customers', 'warn', count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1)
UNION ALL SELECT 'days', 'warn', count(*) FROM (SELECT o_orderkey - lag(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS g FROM orders) WHERE g <> 1
""")
def check_plan(spark, sf):
    """The report of all checks of a table."""
    return order_checks().run(_checked_orders(spark, sf), new_folder(spark, "violations"))


@query("""
SELECT 'priority' AS "check", o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'pattern', o_orderkey, o_orderpriority FROM orders WHERE NOT regexp_matches(o_orderpriority, '[0-9]-[HLMU]')
UNION ALL SELECT 'status', o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'late', o_orderkey, o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'
UNION ALL SELECT 'customers', o_custkey, o_orderpriority FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1
""")
def stored_violations(spark, sf):
    """The violating rows of each check, read back from where they were stored; a run replaces those of the run before."""
    plan, orders, folder = order_checks(), _checked_orders(spark, sf), new_folder(spark, "violations")
    plan.run(orders.limit(5), folder)
    plan.run(orders, folder)
    out = None
    for name in ("priority", "pattern", "status", "late", "never"):
        one = plan.stored(spark, folder, name, orders).select(F.lit(name).alias("check"), "o_orderkey", F.col("o_orderpriority").alias("priority"))
        out = one if out is None else out.unionByName(one)
    twice = plan.stored(spark, folder, "customers", orders)
    return out.unionByName(twice.select(F.lit("customers").alias("check"), F.col("o_custkey").alias("o_orderkey"), F.col("o_orderpriority").alias("priority")))


# ---------------------------------------------------------------- sources and sinks


def response_lines(spark, sf) -> str:
    """Responses as JSON lines in folders named after a block range; some hold an error that will be retried (status P)."""
    rows = cl.orders(spark, sf)
    c = F.col
    code = F.when(c("status") == "P", -32000).when(c("status") == "O", -32600)
    line = F.to_json(
        F.struct(
            c("o_orderkey").alias("block_number"),
            F.struct(F.struct(code.alias("code")).alias("error"), F.struct(c("o_custkey").alias("cust")).alias("result")).alias("data"),
        )
    )
    first = (F.floor(F.date_diff(F.to_date("o_orderdate"), F.lit(cl.FIRST_DAY).cast("date")) / 100) * 100).cast("bigint")
    path = new_folder(spark, "responses")
    for_files = rows.select(line.alias("value"), F.concat(first.cast("string"), F.lit("_"), (first + 99).cast("string")).alias("range"))
    for_files.hint("rebalance", "range").write.partitionBy("range").text(f"{path}/a/b/c")
    return path


@query(f"""
WITH {O} SELECT o_orderkey AS block_number, d // 100 * 100 AS _partition_by_block_id, o_custkey AS cust, md5(CAST(o_orderkey AS VARCHAR)) AS id
FROM o WHERE status <> 'P'
""")
def response_files(spark, sf):
    """Responses of the last days; retryable errors are dropped."""
    path = response_lines(spark, sf)
    responses = read_responses(spark, path, root=f"{path}/", recent_days=7, now=datetime.now())
    return responses.select("block_number", "_partition_by_block_id", vlong("data", "result.cust").alias("cust"), "id")


@query("SELECT n_nationkey, n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1, 2")
def seed_scan(spark, sf):
    """A seed CSV read with its declared schema, and a full overwrite of a small table."""
    path = new_folder(spark, "seed")
    table(spark, sf, "nation").select("n_nationkey", "n_name").write.option("header", "true").csv(path)
    seed = read_seed(spark, path, "n_nationkey int, n_name string")
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    out = new_folder(spark, "full")
    write_full(seed, out)
    write_full(seed.join(counts, "n_nationkey", "left").withColumn("customers", F.coalesce("customers", F.lit(0))), out)
    return spark.read.parquet(out)


# ---------------------------------------------------------------- streams


def _event_files(spark, sf) -> tuple[str, object]:
    """The events as a few files that arrive in turn."""
    path = new_folder(spark, "arriving")
    events = table(spark, sf, "events")
    events.repartitionByRange(4, "ts").write.parquet(path)
    return path, events.schema


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1")
def stream_equals_batch(spark, sf):
    """A file stream with keyed upserts; replaying all files under a new checkpoint changes nothing."""
    path, schema = _event_files(spark, sf)
    target = KeyedTable(spark, new_folder(spark, "streamed"), ["event_id"], date_part("ts"), moves=False)
    for _ in range(2):
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
        run_available(source, lambda batch: batch, target, new_folder(spark, "checkpoint"))
    return target.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("cents"))


@query("""
WITH w AS (SELECT max(ts) - INTERVAL 2 HOUR AS w FROM events)
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n FROM events, w
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= w GROUP BY 1
""")
def stream_closed_hours(spark, sf):
    """Hourly counts as a stream: hours still open at the watermark are not emitted."""
    path, schema = _event_files(spark, sf)
    source = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    out = new_folder(spark, "hourly")
    query_ = (
        hourly_counts(source, "ts", "2 hours").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", new_folder(spark, "checkpoint")).option("path", out).trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    return spark.read.parquet(out).select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n")


