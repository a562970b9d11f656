"""Ordered, grouped and streaming computations over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import safe_json, vlong
from ledgerlake.operators.dedupe import first_value_by
from ledgerlake.operators.gaps import pages
from ledgerlake.operators.joins import earliest_match, pair_nth, semi, with_next
from ledgerlake.operators.ordered import (
    before, carry_forward, count_of, density_chunk, density_cuts, event_groups, group_number, number, row_numbers, scan_steps,
    time_chunk,
)
from ledgerlake.operators.pivot import object_of, pivot_known
from ledgerlake.plans.classic_silver import balance_chain, daily_locf
from ledgerlake.plans.observability import counted_transactions
from ledgerlake.run import Run
from ledgerlake.session import settle
from workload import query, table
from workload.relational import cents, last_event

KINDS = ["click", "error", "purchase", "signup", "view"]
HOUR = "yyyy-MM-dd HH:mm"


def events(spark, sf):
    return table(spark, sf, "events")


def hour():
    return time_chunk(F.col("ts"), "hour")


def _groups(spark, sf):
    return event_groups(
        events(spark, sf).select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], hour(),
        F.col("event_type") == "signup", "grp",
    )


GROUPS_SQL = """
g AS (SELECT event_id, user_id, ts, event_type, nullif(CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT), -1) AS grp FROM events)
"""


@query(f"WITH {GROUPS_SQL} SELECT event_id, grp FROM g")
def running_group(spark, sf):
    return _groups(spark, sf).select("event_id", "grp")


@query(f"""
WITH {GROUPS_SQL},
e AS (SELECT DISTINCT user_id, grp FROM g WHERE event_type = 'purchase' AND grp IS NOT NULL),
c AS (SELECT g.event_id, row_number() OVER (PARTITION BY g.user_id, g.grp ORDER BY ts, g.event_id) - 1 AS step
  FROM g JOIN e ON g.user_id = e.user_id AND g.grp = e.grp WHERE event_type = 'click')
SELECT g.event_id, CASE WHEN grp IS NULL THEN NULL ELSE coalesce(first_value(step IGNORE NULLS) OVER (
  PARTITION BY user_id, grp ORDER BY ts, g.event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) END AS sub_grp
FROM g LEFT JOIN c ON g.event_id = c.event_id
""")
def sub_group_backfill(spark, sf):
    """In a group with a purchase, the clicks before a row are the step of the next click, if there is one."""
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    is_ = lambda kind: F.col("event_type") == kind
    at = density_chunk(F.col("ts"), hour(), density_cuts(rows, "ts", hour()))
    steps = {"starts": count_of(is_("signup")), "clicks": count_of(is_("click"))}
    counted = settle(scan_steps(rows, ["user_id"], ["ts", "event_id"], at, steps), "sub-groups").select(
        "event_id", "user_id", "event_type", group_number(F.col("starts")).alias("grp"),
        (F.col("clicks") - is_("click").cast("int")).alias("ahead"),
    )
    groups = counted.where("grp is not null").groupBy("user_id", "grp").agg(
        F.min("ahead").alias("first"), F.count_if(is_("click")).alias("n"), F.bool_or(is_("purchase")).alias("bought"),
    )
    joined = counted.join(groups, ["user_id", "grp"], "left")
    step = F.col("ahead") - F.col("first")
    sub = F.when(F.col("grp").isNotNull(), F.when(F.col("bought") & (step < F.col("n")), step).otherwise(0))
    return joined.select("event_id", sub.alias("sub_grp"))


@query("""
SELECT event_id, last_value(event_type) OVER w AS last_type,
       CASE WHEN last_value(event_type) OVER w <> 'signup' THEN 0 END AS fallback
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def header_rule(spark, sf):
    """The last type of a user is one small aggregate joined back; no window holds a user's rows."""
    last = events(spark, sf).groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    )
    joined = events(spark, sf).select("event_id", "user_id").join(last, "user_id")
    return joined.select("event_id", "last_type", F.when(F.col("last_type") != "signup", 0).alias("fallback"))


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_cents FROM events
""")
def locf(spark, sf):
    paid = F.when(F.col("event_type") == "purchase", cents("value"))
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    return carry_forward(rows, ["user_id"], ["ts", "event_id"], hour(), paid, "last_cents").select("event_id", "last_cents")


@query("""
SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
""")
def lag_and_row_number(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    steps = {"prev_event": before(F.col("event_id")), "rn": number()}
    numbered = scan_steps(rows, ["user_id"], ["ts", "event_id"], hour(), steps)
    return numbered.select("event_id", "prev_event", "rn")


HOURLY_SQL = """
h AS (SELECT date_trunc('hour', ts) AS hr, count(*) AS n_events,
  count(DISTINCT CASE WHEN event_type = 'purchase' THEN event_id END) AS n_purchases,
  count(DISTINCT CASE WHEN event_type = 'error' THEN event_id END) AS n_errors,
  count(DISTINCT user_id) AS n_users, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents,
  max_by(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END,
         CASE WHEN event_type = 'purchase' THEN ts END) AS last_cents
  FROM events GROUP BY 1),
i AS (SELECT *, last_value(last_cents IGNORE NULLS) OVER (ORDER BY hr ROWS UNBOUNDED PRECEDING) AS price_cents FROM h)
"""


@query(f"""
WITH {HOURLY_SQL}
SELECT strftime(hr, '%Y-%m-%d %H:%M') AS hour, n_events, n_purchases, n_errors, n_users, value_cents, price_cents,
       (value_cents * price_cents + 50) // 100 AS worth_cents FROM i
""")
def hourly_metrics(spark, sf):
    bought = F.col("event_type") == "purchase"
    rows = events(spark, sf).withColumn("hr", hour())
    hours = rows.groupBy("hr").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct(F.when(bought, F.col("event_id"))).alias("n_purchases"),
        F.count_distinct(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("n_errors"),
        F.count_distinct("user_id").alias("n_users"),
        F.sum(cents("value")).alias("value_cents"),
        F.max_by(F.when(bought, cents("value")), F.when(bought, F.col("ts"))).alias("last_cents"),
    )
    day = time_chunk(F.col("hr"), "day")
    priced = carry_forward(hours, [], ["hr"], day, F.col("last_cents"), "price_cents")
    return priced.select(
        F.date_format("hr", HOUR).alias("hour"), "n_events", "n_purchases", "n_errors", "n_users", "value_cents",
        "price_cents", F.floor((F.col("value_cents") * F.col("price_cents") + 50) / 100).alias("worth_cents"),
    )


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, count(*) AS n FROM events
WHERE ts < (SELECT date_trunc('hour', max(ts)) FROM events) GROUP BY 1
""")
def closed_hours_only(spark, sf):
    newest = events(spark, sf).agg(F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz")).scalar()
    return events(spark, sf).where(F.col("ts") < newest).groupBy(F.date_format(hour(), HOUR).alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _counts(spark, sf):
    """Users' counts per type as one map per user; a map has at most one entry per type."""
    counts = events(spark, sf).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return object_of(counts, ["user_id"], "event_type", "n")


@query("""
SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
  count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
  count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id
""")
def pivot_kv(spark, sf):
    return _counts(spark, sf).select(
        "user_id", *[F.coalesce(F.try_element_at("j", F.lit(k)), F.lit(0)).alias(k) for k in KINDS]
    )


@query("""
SELECT user_id, max(CASE WHEN event_type = 'click' THEN props END) AS click,
       max(CASE WHEN event_type = 'purchase' THEN props END) AS purchase FROM events GROUP BY user_id
""")
def pivot_known_keys(spark, sf):
    return pivot_known(events(spark, sf), ["user_id"], ["click", "purchase"], "event_type", "props")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS own FROM events")
def windowed_object(spark, sf):
    joined = events(spark, sf).select("event_id", "user_id", "event_type").join(_counts(spark, sf), "user_id")
    return joined.select("event_id", F.try_element_at("j", F.col("event_type")).alias("own"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       event_type <> 'error' AS has_k FROM events
""")
def json_path(spark, sf):
    text = F.when(F.col("event_type") == "error", F.concat("props", F.lit("{"))).otherwise(F.col("props"))
    parsed = events(spark, sf).select("event_id", safe_json(text).alias("v"))
    return parsed.select(
        "event_id", vlong("v", "k").alias("k"), F.try_variant_get("v", "$.k", "variant").isNotNull().alias("has_k")
    )


@query("""
SELECT user_id, event_id AS first_click FROM events WHERE event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def first_match(spark, sf):
    clicks = events(spark, sf).where(F.col("event_type") == "click")
    return first_value_by(clicks, ["user_id"], F.col("event_id"), F.struct("ts", "event_id"), "first_click")


@query("""
SELECT event_id FROM events e WHERE event_type = 'view' AND EXISTS (
  SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND floor(p.value / 10) = floor(e.value / 10))
""")
def ack_match(spark, sf):
    rows = events(spark, sf).withColumn("bucket", F.floor(F.col("value") / 10))
    views, bought = (rows.where(F.col("event_type") == k) for k in ("view", "purchase"))
    return earliest_match(views, bought, ["user_id", "bucket"]).select("event_id")


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT c.user_id, c.rn, c.event_id AS click, p.event_id AS purchase FROM n c JOIN n p
  ON c.user_id = p.user_id AND c.rn = p.rn WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""", name="pair_nth")
def pair_nth_query(spark, sf):
    def side(kind: str, out: str):
        rows = events(spark, sf).where(F.col("event_type") == kind).select("user_id", "ts", "event_id")
        numbered = row_numbers(rows, ["user_id"], ["ts", "event_id"], hour(), "rn")
        return numbered.select("user_id", "rn", F.col("event_id").alias(out))

    return pair_nth(side("click", "click"), side("purchase", "purchase"), ["user_id"], "rn")


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT event_id FROM n WHERE event_type = 'purchase' OR (user_id, rn) IN (
  SELECT user_id, rn + 1 FROM n WHERE event_type = 'purchase')
""")
def adjacent_rows(spark, sf):
    rows = events(spark, sf).select("user_id", "ts", "event_id", "event_type")
    numbered = row_numbers(rows, ["user_id"], ["ts", "event_id"], hour(), "rn")
    near = with_next(numbered.where(F.col("event_type") == "purchase").select("user_id", "rn"), "rn")
    return semi(numbered, near, "user_id", "rn").select("event_id")


@query("""
WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, arg_max(CAST(round(value * 100) AS BIGINT), ts) AS v
  FROM events GROUP BY 1, 2, 3),
s AS (SELECT user_id, event_type, unnest(generate_series(min(day), (SELECT max(day) FROM d), INTERVAL 1 DAY)) AS day FROM d GROUP BY 1, 2)
SELECT s.user_id, s.event_type, strftime(s.day, '%Y-%m-%d') AS day,
  last_value(v IGNORE NULLS) OVER (PARTITION BY s.user_id, s.event_type ORDER BY s.day ROWS UNBOUNDED PRECEDING) AS balance
FROM s LEFT JOIN d ON s.user_id = d.user_id AND s.event_type = d.event_type AND CAST(s.day AS DATE) = d.day
""")
def spine_range(spark, sf):
    rows = events(spark, sf).select(
        "user_id", "event_type", F.col("ts").alias("block_timestamp"), cents("value").alias("balance")
    )
    daily = daily_locf(rows, ["user_id", "event_type"], Run(last_event(spark, sf)))
    return daily.select("user_id", "event_type", F.date_format("date", "yyyy-MM-dd").alias("day"), "balance")


@query("""
WITH t AS (SELECT user_id, event_type, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS v FROM events),
r AS (SELECT *, dense_rank() OVER (PARTITION BY user_id, event_type ORDER BY us) AS rn FROM t),
j AS (SELECT a.rn AS a_rn, b.*, max(b.rn) OVER (PARTITION BY coalesce(a.user_id, b.user_id), coalesce(a.event_type, b.event_type)) AS top
  FROM r a FULL OUTER JOIN r b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.rn = b.rn - 1)
SELECT user_id AS address, event_type AS currency, us AS block_number, v AS balance FROM j WHERE coalesce(a_rn, 0) <> top
""", name="balance_chain")
def balance_chain_query(spark, sf):
    rows = events(spark, sf).select(
        F.col("user_id").alias("address"), F.col("event_type").alias("currency"), F.lit("liquid").alias("balance_type"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("block_number"), cents("value").alias("balance"),
    )
    chained = balance_chain(rows, width=3_600_000_000)
    return chained.select("address", "currency", "block_number", "balance")


@query("""
SELECT user_id, unnest(generate_series(2, CAST(ceil(count(*) / 2.0) AS BIGINT))) AS page FROM events GROUP BY user_id
""")
def pages_theta(spark, sf):
    counts = events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("user_id", F.explode(pages(F.col("n"), 2, 2)).alias("page"))


@query("""
WITH l AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS b, l_suppkey AS c, l_orderkey || '-' || l_linenumber AS tx FROM lineitem),
r AS (SELECT a AS block_id, count(DISTINCT tx) AS n FROM l GROUP BY 1
  UNION ALL SELECT b, count(DISTINCT tx) FROM l GROUP BY 1 UNION ALL SELECT c, count(DISTINCT tx) FROM l GROUP BY 1)
SELECT block_id, max(n) AS num_txs FROM r GROUP BY 1
""")
def max_of_counts(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("block_id"), F.col("l_partkey").alias("block_id_requested"),
        F.col("l_suppkey").alias("height"), F.lit(None).cast("timestamp_ntz").alias("block_timestamp"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("tx_id"),
    )
    return counted_transactions(landed).select("block_id", "num_txs")
