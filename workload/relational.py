"""Dedupe, joins, sets, aggregates and scalar rules over the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions import (
    coin_amount, coin_denom, decode_attr, denom_cut, greatest_strict, joined_key, scaled, surrogate_key, vlong, vstr,
)
from ledgerlake.operators.dedupe import keep_max_ties, latest_by, nth_by, tombstoned
from ledgerlake.operators.flatten import (
    flatten_array, flatten_array_outer, flatten_object, flatten_path, flatten_recursive, prefix_regroup, split_rows,
)
from ledgerlake.operators.gaps import sequence_gaps, spine
from ledgerlake.operators.joins import lookup, pair_nth, symmetric_difference
from ledgerlake.operators.ordered import dense_ranks, id_chunk, ntiles, row_numbers, time_chunk
from ledgerlake.operators.pivot import object_delete, object_insert, object_merge
from ledgerlake.plans.chain_silver import resolve_sender
from workload import query, table

DAY = "yyyy-MM-dd"


def last_event(spark, sf):
    """The newest time in events."""
    return table(spark, sf, "events").agg(F.max("ts")).first()[0]


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def text_day(column: str) -> Column:
    return F.date_format(column, DAY)


# ---------------------------------------------------------------- dedupe and ranks


@query("""
SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_by_key(spark, sf):
    orders = table(spark, sf, "orders")
    latest = latest_by(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", cents("o_totalprice").alias("price_cents"))


@query("""
SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS last_ship, count(*) AS lines
FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r FROM lineitem)
WHERE r = 1 GROUP BY 1, 2
""", name="keep_max_ties")
def keep_max_ties_query(spark, sf):
    kept = keep_max_ties(table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate"), ["l_orderkey"], "l_shipdate")
    return kept.groupBy("l_orderkey", text_day("l_shipdate").alias("last_ship")).agg(F.count(F.lit(1)).alias("lines"))


@query("""
WITH d AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
SELECT o_custkey, dense_rank() OVER w AS rn, strftime(o_orderdate, '%Y-%m-%d') AS this_date,
       strftime(lead(o_orderdate) OVER w, '%Y-%m-%d') AS next_date
FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
""")
def dense_rank_chain(spark, sf):
    dates = table(spark, sf, "orders").select("o_custkey", "o_orderdate").distinct()
    ranked = dense_ranks(dates, ["o_custkey"], "o_orderdate", F.trunc("o_orderdate", "year"), "rn")
    following = ranked.select("o_custkey", (F.col("rn") - 1).alias("rn"), F.col("o_orderdate").alias("next"))
    return pair_nth(ranked, following, ["o_custkey"], "rn", "left").select(
        "o_custkey", "rn", text_day("o_orderdate").alias("this_date"), text_day("next").alias("next_date")
    )


@query("""
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 3
""")
def nth_row(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return nth_by(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("""
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 750
""")
def top_k(spark, sf):
    orders = table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(750)
    return orders.select("o_orderkey", cents("o_totalprice").alias("price_cents"))


@query("""
SELECT ntile(10) OVER (ORDER BY o_orderkey) AS grp, o_orderkey FROM orders
""")
def ntile_batches(spark, sf):
    keys = table(spark, sf, "orders").select("o_orderkey")
    return ntiles(keys, ["o_orderkey"], id_chunk(F.col("o_orderkey"), 1000), 10, "grp").select("grp", "o_orderkey")


@query("""
WITH n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 20 AS run FROM orders)
SELECT run, run // 100 + 1 AS call, min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS n FROM n GROUP BY 1, 2
""")
def chunking(spark, sf):
    keys = table(spark, sf, "orders").select("o_orderkey")
    numbered = row_numbers(keys, [], ["o_orderkey"], id_chunk(F.col("o_orderkey"), 1000), "rn")
    runs = numbered.withColumn("run", F.floor((F.col("rn") - 1) / 20))
    return runs.groupBy("run").agg(
        F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.count(F.lit(1)).alias("n")
    ).withColumn("call", F.floor(F.col("run") / 100) + 1)


# ---------------------------------------------------------------- semi-structured


@query("""
SELECT l_orderkey, k, CAST(sum(v) AS BIGINT) AS total, count(*) AS n, CAST(sum(i) AS BIGINT) AS positions
FROM (
  SELECT l_orderkey, 'qty' AS k, CAST(l_quantity AS BIGINT) AS v, 0 AS i FROM lineitem
  UNION ALL SELECT l_orderkey, 'price', CAST(round(l_extendedprice * 100) AS BIGINT), 1 FROM lineitem
  UNION ALL SELECT l_orderkey, 'disc', CAST(round(l_discount * 100) AS BIGINT), 2 FROM lineitem
) GROUP BY l_orderkey, k
""", name="flatten_array")
def flatten_array_query(spark, sf):
    parts = [("qty", F.col("l_quantity").cast("bigint")), ("price", cents("l_extendedprice")), ("disc", cents("l_discount"))]
    body = F.to_json(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in parts]))
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.parse_json(body).alias("j"))
    flat = flatten_array(lines, F.col("j"), "e", "i")
    return flat.groupBy("l_orderkey", vstr("e", "k").alias("k")).agg(
        F.sum(vlong("e", "v")).alias("total"), F.count(F.lit(1)).alias("n"), F.sum("i").alias("positions")
    )


@query("""
SELECT o_orderkey, i, CASE i WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderpriority END AS v
FROM orders, (VALUES (0), (1), (NULL)) AS p(i)
WHERE (o_orderstatus = 'P' AND i IS NULL) OR (o_orderstatus <> 'P' AND i IS NOT NULL)
""")
def flatten_outer(spark, sf):
    full = F.to_json(F.array("o_orderstatus", "o_orderpriority"))
    body = F.when(F.col("o_orderstatus") == "P", F.lit("[]")).otherwise(full)
    orders = table(spark, sf, "orders").select("o_orderkey", F.parse_json(body).alias("j"))
    return flatten_array_outer(orders, F.col("j"), "e", "i").select("o_orderkey", F.col("i").cast("int").alias("i"), vstr("e").alias("v"))


@query("""
SELECT o_orderkey, 'status' AS key, o_orderstatus AS v FROM orders
UNION ALL SELECT o_orderkey, 'cust', CAST(o_custkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
""", name="flatten_object")
def flatten_object_query(spark, sf):
    fields = F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.parse_json(F.to_json(fields)).alias("j"))
    return flatten_object(orders, F.col("j"), "key", "e").select("o_orderkey", "key", vstr("e").alias("v"))


def _metas(spark, sf):
    """Per order a response with two results of two entries, shaped like header-range responses."""
    meta = lambda height: F.struct(
        F.struct(height.alias("height")).alias("header"), F.col("o_custkey").alias("num_txs")
    )
    result = lambda a, b: F.struct(F.struct(F.array(a, b).alias("block_metas")).alias("result"))
    key = F.col("o_orderkey")
    body = F.struct(F.array(result(meta(key), meta(key + 1)), result(meta(key + 2), meta(key + 3))).alias("data"))
    return table(spark, sf, "orders").select("o_orderkey", F.parse_json(F.to_json(body)).alias("j"))


@query("""
SELECT o_orderkey, o_orderkey + i AS height, o_custkey AS num_txs FROM orders, range(4) AS r(i)
""", name="flatten_path")
def flatten_path_query(spark, sf):
    flat = flatten_path(_metas(spark, sf), F.col("j"), ["data", "result.block_metas"], "m")
    return flat.select("o_orderkey", vlong("m", "header.height").alias("height"), vlong("m", "num_txs").alias("num_txs"))


@query("""
SELECT o_orderkey, 'data[' || i // 2 || '].result.block_metas[' || i % 2 || ']' AS path, i % 2 AS item,
       o_orderkey + i AS height
FROM orders, range(4) AS r(i)
""", name="flatten_recursive")
def flatten_recursive_query(spark, sf):
    nodes = flatten_recursive(_metas(spark, sf), F.col("j"))
    items = nodes.where(F.col("path").like("data%.result.block_metas%") & F.col("index").isNotNull())
    return items.select(
        "o_orderkey", "path", F.col("index").alias("item"), vlong("value", "header.height").alias("height")
    )


@query("""
SELECT o_orderkey, repeat('a.', i) || 'a' AS path FROM orders, range(20) AS r(i) WHERE i <= o_custkey % 20
""")
def flatten_recursive_deep(spark, sf):
    """Objects nested up to twenty levels."""
    levels = (F.col("o_custkey") % 20 + 1).cast("int")
    body = F.concat(F.repeat(F.lit('{"a":'), levels), F.lit("1"), F.repeat(F.lit("}"), levels))
    rows = table(spark, sf, "orders").select("o_orderkey", F.parse_json(body).alias("j"))
    return flatten_recursive(rows, F.col("j")).select("o_orderkey", "path")


@query("""
SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) AS INTEGER) AS i,
       unnest(string_split(p_name, ' ')) AS word
FROM part
""", name="split_rows")
def split_rows_query(spark, sf):
    return split_rows(table(spark, sf, "part"), F.col("p_name"), " ", "word", "i").select("p_partkey", "i", "word")


@query("""
SELECT l_orderkey, '0' AS array_index, 3 AS fields, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS flag FROM lineitem
UNION ALL SELECT l_orderkey, '1', 1, CAST(l_linenumber AS BIGINT), NULL FROM lineitem
UNION ALL SELECT l_orderkey, '10', 1, l_partkey, NULL FROM lineitem
""", name="prefix_regroup")
def prefix_regroup_query(spark, sf):
    fields = {
        "0_qty": F.col("l_quantity").cast("bigint"), "0_supp_key": F.col("l_suppkey"), "1_qty": F.col("l_linenumber"),
        "10_qty": F.col("l_partkey"), "flag": F.col("l_returnflag"),
    }
    entries = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])
    lines = table(spark, sf, "lineitem").select("l_orderkey", entries.alias("m"))
    parts = lines.select("l_orderkey", F.explode(prefix_regroup(F.col("m"))).alias("p"))
    return parts.select(
        "l_orderkey", F.col("p.array_index").alias("array_index"), F.size("p.fields").alias("fields"),
        F.try_element_at("p.fields", F.lit("qty")).cast("bigint").alias("qty"),
        F.try_element_at("p.fields", F.lit("flag")).alias("flag"),
    )


def _maps(spark, sf):
    left = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"))
    right = F.create_map(
        F.lit("priority"), F.substring("o_orderpriority", 1, 1), F.lit("cust"), F.col("o_custkey").cast("string")
    )
    return table(spark, sf, "orders").select("o_orderkey", left.alias("l"), right.alias("r"))


@query("""
SELECT o_orderkey, 3 AS fields, o_orderstatus AS status, substr(o_orderpriority, 1, 1) AS priority,
       CAST(o_custkey AS VARCHAR) AS cust
FROM orders
""", name="object_merge")
def object_merge_query(spark, sf):
    merged = _maps(spark, sf).select("o_orderkey", object_merge(F.col("l"), F.col("r")).alias("m"))
    return merged.select(
        "o_orderkey", F.size("m").alias("fields"), F.col("m")["status"].alias("status"),
        F.col("m")["priority"].alias("priority"), F.col("m")["cust"].alias("cust"),
    )


@query("""
SELECT o_orderkey, 2 AS fields, CAST(NULL AS VARCHAR) AS status, o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) AS key_text
FROM orders
""", name="object_delete")
def object_delete_query(spark, sf):
    kept = object_insert(object_delete(F.col("l"), "status", "cust"), "key", F.col("o_orderkey").cast("string"))
    return _maps(spark, sf).select("o_orderkey", kept.alias("m")).select(
        "o_orderkey", F.size("m").alias("fields"), F.try_element_at("m", F.lit("status")).alias("status"),
        F.col("m")["priority"].alias("priority"), F.col("m")["key"].alias("key_text"),
    )


# ---------------------------------------------------------------- coins, text, time


@query("SELECT o_orderkey, o_orderpriority AS decoded FROM orders", name="decode_attr")
def decode_attr_query(spark, sf):
    coded = F.when(F.col("o_orderstatus") == "F", F.base64(F.col("o_orderpriority").cast("binary"))).otherwise(
        F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select("o_orderkey", decode_attr(coded).alias("decoded"))


@query("""
SELECT l_orderkey, CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS amount,
       CASE l_returnflag WHEN 'A' THEN 'uluna' WHEN 'R' THEN 'uluna,5ibc/A' ELSE 'abc' END AS denom
FROM lineitem
""")
def coin_parse(spark, sf):
    digits = F.col("l_quantity").cast("bigint").cast("string")
    coin = (
        F.when(F.col("l_returnflag") == "A", F.concat(digits, F.lit("uluna")))
        .when(F.col("l_returnflag") == "R", F.concat(digits, F.lit("uluna,5ibc/A")))
        .otherwise("abc")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", coin_amount(coin).cast("bigint").alias("amount"), coin_denom(coin).alias("denom")
    )


@query("""
SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS amount,
       CASE l_returnflag WHEN 'A' THEN 'uluna' WHEN 'R' THEN 'gamm/pool/' || repeat('7', 120) || l_partkey ELSE 'ibc/' || repeat('A', 120) || l_partkey END AS currency
FROM lineitem
""")
def multi_coin(spark, sf):
    """Denominations of over 120 characters, told apart by their ends."""
    part = F.col("l_partkey").cast("string")
    pool, ibc = F.concat(F.lit("gamm/pool/" + "7" * 120), part), F.concat(F.lit("ibc/" + "A" * 120), part)
    denom = F.when(F.col("l_returnflag") == "A", "uluna").when(F.col("l_returnflag") == "R", pool).otherwise(ibc)
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat(F.col("l_quantity").cast("bigint").cast("string"), denom).alias("coin")
    )
    amount, currency = denom_cut(F.col("coin"))
    return lines.select("l_orderkey", amount.cast("bigint").alias("amount"), currency.alias("currency"))


@query("""
SELECT o_orderkey, CASE o_orderstatus
  WHEN 'F' THEN CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority ELSE 'payer' || o_custkey END
  WHEN 'O' THEN CAST(o_custkey AS VARCHAR)
  ELSE o_orderpriority END AS sender
FROM orders
""")
def sender_case(spark, sf):
    status = F.col("o_orderstatus")
    key = F.when(status == "F", "granter").when(status == "O", "fee").otherwise("spender")
    payer = F.when(~F.col("o_orderpriority").like("1%"), F.concat(F.lit("payer"), F.col("o_custkey").cast("string")))
    sequence = F.concat_ws("/", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    none = F.lit(None).cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey", resolve_sender(key, F.col("o_orderpriority"), payer, none, sequence).alias("sender")
    )


@query("""
SELECT o_orderkey, md5(concat_ws('-', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'P'
  THEN '_dbt_utils_surrogate_key_null_' ELSE CAST(o_custkey AS VARCHAR) END)) AS id,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey || ':' || o_custkey END AS joined
FROM orders
""", name="surrogate_key")
def surrogate_key_query(spark, sf):
    cust = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return table(spark, sf, "orders").select(
        "o_orderkey", surrogate_key("o_orderkey", cust).alias("id"), joined_key(":", "o_orderkey", cust).alias("joined")
    )


@query("""
SELECT o_orderkey, CAST(round(o_orderkey, -3) AS BIGINT) AS part, CAST(ceil(o_custkey / 100.0) * 100 AS BIGINT) AS up,
       o_custkey % 7 AS m, abs(100 - o_custkey) AS a, CAST(o_orderkey AS DOUBLE) / 1000000 AS scaled,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE greatest(o_custkey, o_orderkey) END AS g
FROM orders
""")
def scalar_math(spark, sf):
    cust = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round("o_orderkey", -3).cast("bigint").alias("part"),
        F.ceil(cust, F.lit(-2)).cast("bigint").alias("up"), (cust % 7).alias("m"), F.abs(100 - cust).alias("a"),
        scaled(F.col("o_orderkey")).alias("scaled"),
        greatest_strict(F.when(F.col("o_orderstatus") != "P", cust), F.col("o_orderkey")).alias("g"),
    )


@query("""
SELECT p_partkey, upper(p_brand) AS up, lower(p_type) AS low, left(p_name, 3) AS l, right(p_name, 4) AS r,
       length(p_name) AS n, split_part(p_name, ' ', 1) AS first, replace(p_name, ' ', '') AS joined,
       instr(p_name, 'e') AS at_e, nullif(regexp_extract(p_brand, '[0-9]+'), '') AS digits,
       regexp_full_match(p_type, '.*STEEL') AS steel, TRY_CAST(p_brand AS BIGINT) AS num, md5(p_name) AS h
FROM part
""")
def scalar_text(spark, sf):
    name = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey", F.upper("p_brand").alias("up"), F.lower("p_type").alias("low"),
        F.left(name, F.lit(3)).alias("l"), F.right(name, F.lit(4)).alias("r"), F.length(name).cast("bigint").alias("n"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first"), F.replace(name, F.lit(" "), F.lit("")).alias("joined"),
        F.instr(name, "e").cast("bigint").alias("at_e"), F.regexp_substr("p_brand", F.lit("[0-9]+")).alias("digits"),
        F.col("p_type").rlike("^(?:.*STEEL)$").alias("steel"), F.col("p_brand").try_cast("bigint").alias("num"),
        F.md5(name).alias("h"),
    )


@query("""
SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS h, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS m,
       strftime(ts - INTERVAL 3 DAY, '%Y-%m-%d') AS back, epoch_us(ts) // 1000 AS ms,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS again
FROM events
""")
def scalar_time(spark, sf):
    ts = F.col("ts")
    ms = F.unix_millis(ts.cast("timestamp"))
    minute = "yyyy-MM-dd HH:mm"
    return table(spark, sf, "events").select(
        "event_id", F.date_format(time_chunk(ts, "hour"), minute).alias("h"),
        F.date_format(time_chunk(ts, "minute"), minute).alias("m"),
        F.date_format(ts - F.expr("interval 3 days"), DAY).alias("back"), ms.alias("ms"),
        F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss").alias("again"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey <= 5000 THEN o_orderpriority END AS old_field,
       CASE WHEN o_orderkey <= 5000 THEN 'header' ELSE 'commit' END AS origin
FROM orders
""")
def era_switch(spark, sf):
    old = F.col("o_orderkey") <= 5000
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(old, F.col("o_orderpriority")).alias("old_field"),
        F.when(old, "header").otherwise("commit").alias("origin"),
    )


@query("""
SELECT o_orderkey, o_orderpriority LIKE '%URG%' AS is_like, lower(o_orderpriority) LIKE '%high%' AS is_ilike,
       o_orderstatus IN ('F', 'P') AS in_list, o_custkey BETWEEN 100 AND 500 AS between_keys,
       coalesce(nullif(o_orderstatus, 'P'), 'none') AS status
FROM orders
""")
def predicates(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").like("%URG%").alias("is_like"),
        F.col("o_orderpriority").ilike("%HIGH%").alias("is_ilike"),
        F.col("o_orderstatus").isin("F", "P").alias("in_list"), F.col("o_custkey").between(100, 500).alias("between_keys"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("none")).alias("status"),
    )


# ---------------------------------------------------------------- joins


@query("""
SELECT n_name, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def inner_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", cents("o_totalprice").alias("v"))
    # Orders are summed per customer before they meet the dimension, so a hot customer is one row in the join.
    per_customer = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    return per_customer.join(customers, "o_custkey").groupBy("n_name").agg(
        F.sum("n").alias("orders"), F.sum("v").alias("cents")
    )


@query("""
SELECT l_orderkey, l_linenumber, s_name AS label FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
""")
def left_join_labels(spark, sf):
    labels = table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookup(lines, labels, {"s_suppkey": F.col("l_suppkey")}, {"s_name": "label"}).drop("l_suppkey")


@query("""
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
GROUP BY 1, 2
""")
def multi_alias_join(spark, sf):
    nation = table(spark, sf, "nation")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = lines.join(suppliers, "l_suppkey").join(orders, "l_orderkey").join(customers, "o_custkey")
    by_nation = joined.groupBy("c_nationkey", "s_nationkey").agg(F.sum("n").alias("lines"))
    named = lookup(by_nation, nation, {"n_nationkey": F.col("c_nationkey")}, {"n_name": "customer_nation"})
    named = lookup(named, nation, {"n_nationkey": F.col("s_nationkey")}, {"n_name": "supplier_nation"})
    return named.select("customer_nation", "supplier_nation", "lines")


@query("""
WITH p AS (SELECT l_partkey, date_trunc('month', l_shipdate) AS m,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) // count(*) AS avg_cents
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, l.l_partkey AS part, avg_cents FROM lineitem l
LEFT JOIN p ON l.l_partkey = p.l_partkey AND date_trunc('month', l.l_shipdate) = p.m
""")
def price_lookup(spark, sf):
    lines = table(spark, sf, "lineitem")
    month = F.trunc("l_shipdate", "month")
    prices = lines.where(F.col("l_returnflag") == "A").groupBy("l_partkey", month.alias("m")).agg(
        F.floor(F.sum(cents("l_extendedprice")) / F.count(F.lit(1))).alias("avg_cents")
    )
    rows = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"), month.alias("at"))
    return lookup(rows, prices, {"l_partkey": F.col("part"), "m": F.col("at")}, {"avg_cents": "avg_cents"}).drop("at")


@query("""
WITH f AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
     p AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT coalesce(f.o_custkey, p.o_custkey) AS cust, f.n AS finished, p.n AS partial
FROM f FULL OUTER JOIN p ON f.o_custkey = p.o_custkey
""")
def full_outer(spark, sf):
    orders = table(spark, sf, "orders")

    def side(status: str, out: str):
        return orders.where(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("cust")).agg(
            F.count(F.lit(1)).alias(out)
        )

    return side("F", "finished").join(side("P", "partial"), "cust", "full_outer")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def semi_join(spark, sf):
    returned = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return table(spark, sf, "orders").select("o_orderkey").join(
        returned.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
    )


@query("""
SELECT o_orderkey, 'kept' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT o_orderkey, 'null list' FROM orders
WHERE o_orderkey NOT IN (SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END FROM lineitem)
UNION ALL
SELECT o_orderkey, 'empty list' FROM orders
WHERE nullif(o_orderkey, 1) NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 0)
""")
def anti_join_null_aware(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    lines = table(spark, sf, "lineitem")

    def side(df, key, flagged, name: str):
        rows = df.withColumn("k", key)
        return tombstoned(rows, flagged, "k").select("o_orderkey", F.lit(name).alias("side"))

    key = F.col("o_orderkey")
    kept = side(orders, key, lines.select(F.col("l_orderkey").alias("k")), "kept")
    nulls = lines.select(F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("k"))
    none = lines.where(F.col("l_quantity") < 0).select(F.col("l_orderkey").alias("k"))
    return kept.unionByName(side(orders, key, nulls, "null list")).unionByName(
        side(orders, F.nullif(key, F.lit(1).cast("bigint")), none, "empty list")
    )


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def not_in_list(spark, sf):
    return table(spark, sf, "orders").where(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("""
SELECT o_orderkey FROM orders
WHERE o_orderdate BETWEEN (SELECT min(l_shipdate) FROM lineitem) AND (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'A')
""")
def bounds_subquery(spark, sf):
    lines = table(spark, sf, "lineitem")
    low = lines.agg(F.min("l_shipdate")).scalar()
    high = lines.where(F.col("l_returnflag") == "A").agg(F.max("l_shipdate")).scalar()
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderdate").between(low, high)).select("o_orderkey")


# ---------------------------------------------------------------- gaps and calendars


@query("""
WITH k AS (SELECT DISTINCT l_orderkey FROM lineitem),
     g AS (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS prev FROM k)
SELECT prev AS prev_l_orderkey, l_orderkey, l_orderkey - prev - 1 AS gap FROM g WHERE l_orderkey - prev <> 1
""")
def gap_ranges(spark, sf):
    keys = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return sequence_gaps(keys, "l_orderkey", width=1000)


@query("""
WITH m AS (SELECT n_name, date_trunc('month', o_orderdate) AS mon, count(*) AS n FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
 r AS (SELECT n_name, min(mon) AS lo, max(mon) AS hi FROM m GROUP BY 1),
 s AS (SELECT n_name, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS mon FROM r)
SELECT s.n_name, strftime(s.mon, '%Y-%m-%d') AS month, coalesce(m.n, 0) AS orders
FROM s LEFT JOIN m ON s.n_name = m.n_name AND s.mon = m.mon
""")
def calendar_spine(spark, sf):
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    months = table(spark, sf, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("mon")).agg(
        F.count(F.lit(1)).alias("n")
    ).join(customers, "o_custkey").groupBy("n_name", "mon").agg(F.sum("n").alias("n"))
    ranges = months.groupBy("n_name").agg(F.min("mon").alias("lo"), F.max("mon").alias("hi"))
    days = spine(ranges, "lo", F.col("hi"), "mon", "1 month").drop("lo", "hi")
    return days.join(months, ["n_name", "mon"], "left").select(
        "n_name", text_day("mon").alias("month"), F.coalesce("n", F.lit(0)).alias("orders")
    )


# ---------------------------------------------------------------- aggregates and sets


@query("""
SELECT c_nationkey, count(DISTINCT c_mktsegment) AS segments, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS finished,
       count(DISTINCT CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END) AS open
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
""")
def distinct_counts(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey"
    )
    done = F.col("o_orderstatus") == "F"
    return joined.groupBy("c_nationkey").agg(
        F.count_distinct("c_mktsegment").alias("segments"), F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct(F.when(done, F.col("o_orderkey"))).alias("finished"),
        F.count_distinct(F.when(~done, F.col("o_orderkey"))).alias("open"),
    )


@query("""
SELECT l_suppkey, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
       max(CASE WHEN l_linestatus = 'O' THEN l_partkey END) AS open_part, min(l_linenumber) AS lo, max(l_linenumber) AS hi,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) // count(*) AS avg_cents
FROM lineitem GROUP BY l_suppkey
""")
def conditional_aggs(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.max(F.when(F.col("l_linestatus") == "O", F.col("l_partkey"))).alias("open_part"),
        F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"),
        F.floor(F.sum(cents("l_extendedprice")) / F.count(F.lit(1))).alias("avg_cents"),
    )


@query("""
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1
""")
def ordered_array(spark, sf):
    """The array holds distinct segment names, a closed list, so no group grows with the data."""
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ",").alias("segments")
    )


@query("""
SELECT p_brand AS label, max(CASE WHEN p_type LIKE '%STEEL' THEN p_name END) AS steel,
       max(CASE WHEN p_type LIKE '%BRASS' THEN p_name END) AS brass, max(CASE WHEN p_size = 1 THEN p_name END) AS smallest
FROM part GROUP BY 1
HAVING max(CASE WHEN p_type LIKE '%STEEL' THEN p_name END) IS NOT NULL OR max(CASE WHEN p_type LIKE '%BRASS' THEN p_name END) IS NOT NULL
    OR max(CASE WHEN p_size = 1 THEN p_name END) IS NOT NULL
""")
def label_pivot(spark, sf):
    name = F.col("p_name")
    out = table(spark, sf, "part").groupBy(F.col("p_brand").alias("label")).agg(
        F.max(F.when(F.col("p_type").like("%STEEL"), name)).alias("steel"),
        F.max(F.when(F.col("p_type").like("%BRASS"), name)).alias("brass"),
        F.max(F.when(F.col("p_size") == 1, name)).alias("smallest"),
    )
    return out.where(F.coalesce("steel", "brass", "smallest").isNotNull())


@query("""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 45)
""")
def tombstones(spark, sf):
    bad = table(spark, sf, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
    flagged = table(spark, sf, "orders").join(
        bad.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
    ).select(F.col("o_custkey").alias("c_custkey"))
    return tombstoned(table(spark, sf, "customer"), flagged, "c_custkey").select("c_custkey", "c_mktsegment")


def _nations(spark, sf):
    customers = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("nation"))
    return customers, suppliers


@query("""
SELECT nation, count(*) AS n FROM (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 0
UNION ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1
""")
def union_all(spark, sf):
    customers, suppliers = _nations(spark, sf)
    return customers.unionByName(suppliers).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 0 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
""")
def union_distinct(spark, sf):
    customers, suppliers = _nations(spark, sf)
    return customers.unionByName(suppliers).distinct()


@query("""
SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 0 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
""")
def except_rows(spark, sf):
    customers, suppliers = _nations(spark, sf)
    return customers.subtract(suppliers)


@query("""
(SELECT l_partkey AS part, l_suppkey AS supp FROM lineitem WHERE l_returnflag = 'A'
 EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL
(SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
 EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')
""")
def sym_diff(spark, sf):
    pairs = lambda flag: table(spark, sf, "lineitem").where(F.col("l_returnflag") == flag).select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")
    )
    return symmetric_difference(pairs("A"), pairs("R"))
