"""The current chain's tables over payloads derived from orders, against plain SQL over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import vstr
from ledgerlake.incremental import KeyedTable
from ledgerlake.plans import chain_gold, chain_silver, chain_stats, observability, worklists
from ledgerlake.session import new_folder
from ledgerlake.sources.numbers import numbers
from workload import chainlike as cl
from workload import query, table
from workload.chainlike import Chain, RUN

O = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day,
  datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS d,
  datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 4710578 AS block,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents, 'addr' || o_custkey AS cust, 'peer' || o_orderstatus AS peer,
  md5(CAST(o_orderkey AS VARCHAR)) AS hash FROM orders),
days AS (SELECT day, d, block, count(*) AS n,
  strftime(day, '%Y-%m-%d') || CASE WHEN d < 1150 THEN ' 00:00:00.000000' ELSE ' 00:00:00.123456' END AS ts FROM o GROUP BY 1, 2, 3)
"""
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def stamp(column: str = "block_timestamp"):
    return F.date_format(column, STAMP)


# ---------------------------------------------------------------- blocks and transactions


@query(f"""
WITH {O}
SELECT x.block AS block_id, x.ts AS ts, x.n % 5 AS tx_count, 'app' || x.block || '-1' AS block_hash, 'phoenix-1' AS chain_id,
  'prop' || (x.d % 5) AS proposer, x.block AS height, md5(CAST(x.block AS VARCHAR)) AS fact_blocks_id,
  CASE WHEN y.d IS NULL THEN NULL WHEN y.d % 7 = y.d % 3 THEN 'VAL' || (y.d % 7)
    ELSE 'VAL' || least(y.d % 7, y.d % 3) || ',VAL' || greatest(y.d % 7, y.d % 3) END AS validators
FROM days x LEFT JOIN days y ON y.d = x.d + 1
""")
def blocks_roundtrip(spark, sf):
    gold = chain_gold.fact_blocks(Chain(spark, sf).blocks)
    return gold.select(
        "block_id", stamp().alias("ts"), "tx_count", "block_hash", "chain_id", F.col("proposer_address").alias("proposer"),
        F.col("block_height").alias("height"), "fact_blocks_id", F.array_join("validator_address_array", ",").alias("validators"),
    )


@query(f"""
WITH {O}
SELECT hash AS tx_id, o.block AS block_id, days.ts AS ts, CASE WHEN o.d <= 1200 THEN 'single' END AS auth_type,
  CASE WHEN o.d <= 1200 THEN hash END AS public_key,
  CASE status WHEN 'F' THEN cust
    WHEN 'O' THEN CASE WHEN o.d <= 1200 AND priority <> '1-URGENT' THEN 'grantee' || o_custkey ELSE cust END
    ELSE CASE WHEN o.d <= 1200 THEN 'payer' || o_custkey ELSE cust END END AS tx_sender,
  CASE WHEN o.d <= 1200 THEN o_orderkey END AS gas_limit, o_custkey + 1 AS gas_used,
  CASE WHEN o.d <= 1200 THEN CAST(cents AS DOUBLE) / 1000000 END AS fee, CASE WHEN o.d <= 1200 THEN 'uluna' END AS fee_denom,
  CASE WHEN o.d <= 1200 THEN priority END AS memo, CASE status WHEN 'P' THEN 'sdk' ELSE '' END AS codespace,
  CASE status WHEN 'P' THEN 5 ELSE 0 END AS tx_code, status <> 'P' AS tx_succeeded, md5(hash) AS fact_transactions_id
FROM o JOIN days ON o.block = days.block
""")
def transactions_roundtrip(spark, sf):
    gold = chain_gold.fact_transactions(Chain(spark, sf).transactions)
    return gold.select(
        "tx_id", "block_id", stamp().alias("ts"), "auth_type", F.array_join("authorizer_public_key", ",").alias("public_key"),
        "tx_sender", F.col("gas_limit").cast("bigint").alias("gas_limit"), F.col("gas_used").cast("bigint").alias("gas_used"),
        "fee", "fee_denom", "memo", "codespace", F.col("tx_code").cast("int").alias("tx_code"), "tx_succeeded",
        "fact_transactions_id",
    )


@query(f"WITH {O} SELECT block AS block_id, 1 AS total_count, md5(CAST(block AS VARCHAR)) AS id FROM days")
def transactions_total_count(spark, sf):
    counts = chain_silver.transactions_total_count(cl.tx_responses(spark, sf), RUN)
    return counts.select("block_id", F.col("total_count").cast("int").alias("total_count"), F.col("transactions_total_count_id").alias("id"))


# ---------------------------------------------------------------- events of the result

LAYOUT = """
layout(priority, i, type, grp, sub) AS (VALUES
  ('1-URGENT', 2, 'message', 0, 0), ('1-URGENT', 3, 'message', 0, 0), ('1-URGENT', 4, 'transfer', 0, 1),
  ('1-URGENT', 5, 'message', 0, 1), ('1-URGENT', 6, 'transfer', 0, 0),
  ('2-HIGH', 2, 'message', 0, 0), ('2-HIGH', 3, 'transfer', 0, 0), ('2-HIGH', 4, 'ibc_transfer', 0, 0),
  ('2-HIGH', 5, 'send_packet', 0, 0), ('2-HIGH', 6, 'message', 0, 0),
  ('3-MEDIUM', 2, 'message', 0, 0), ('3-MEDIUM', 3, 'acknowledge_packet', 0, 0), ('3-MEDIUM', 4, 'message', 0, 0),
  ('4-NOT SPECIFIED', 2, 'message', 0, NULL), ('4-NOT SPECIFIED', 3, 'staking', 0, NULL),
  ('4-NOT SPECIFIED', 4, 'message', 0, NULL), ('4-NOT SPECIFIED', 5, 'tx', 0, NULL),
  ('5-LOW', 2, 'message', 0, 0), ('5-LOW', 3, 'write_acknowledgement', 0, 0), ('5-LOW', 4, 'transfer', 0, 0),
  ('5-LOW', 5, 'message', 0, 0)),
heads(i, type) AS (VALUES (0, 'coin_spent'), (1, 'tx')),
ev AS (SELECT o.*, i, CASE WHEN type <> 'staking' THEN type WHEN status = 'F' THEN 'redelegate' WHEN status = 'O' THEN 'delegate'
    ELSE 'unbond' END AS type, grp, sub FROM o JOIN layout USING (priority)
  UNION ALL SELECT o.*, i, type, NULL, NULL FROM o, heads)
"""


@query(f"""
WITH {O}, {LAYOUT}
SELECT hash AS tx_id, CAST(i AS BIGINT) AS msg_index, type AS msg_type, CAST(grp AS BIGINT) AS msg_group,
  CAST(sub AS BIGINT) AS msg_sub_group, md5(hash || '-' || i) AS id FROM ev
""")
def message_groups(spark, sf):
    return Chain(spark, sf).msgs_2.select(
        "tx_id", "msg_index", "msg_type", "msg_group", "msg_sub_group", F.col("msgs_2_id").alias("id")
    )


@query(f"""
WITH {O}, {LAYOUT}, actions(priority, action) AS (VALUES ('1-URGENT', '/cosmos.authz.v1beta1.MsgExec'),
  ('2-HIGH', '/ibc.applications.transfer.v1.MsgTransfer'), ('3-MEDIUM', '/ibc.core.channel.v1.MsgAcknowledgement'),
  ('4-NOT SPECIFIED', '/cosmos.staking.v1beta1.MsgDelegate'), ('5-LOW', '/ibc.core.channel.v1.MsgRecvPacket')),
modules(priority, i, module) AS (VALUES ('1-URGENT', 3, 'bank'), ('1-URGENT', 5, 'bank'), ('2-HIGH', 6, 'transfer'), ('3-MEDIUM', 4, 'ibc'),
  ('4-NOT SPECIFIED', 4, 'staking'), ('5-LOW', 5, 'ibc')),
pairs AS (
  SELECT hash, i, type, 0 AS a, CASE status WHEN 'F' THEN 'spender' WHEN 'O' THEN 'fee' ELSE 'granter' END AS k, cust AS v FROM ev WHERE i = 0
  UNION ALL SELECT hash, i, type, 0, 'acc_seq', cust || '/' || o_orderkey FROM ev WHERE i = 1
  UNION ALL SELECT hash, i, type, 1, 'fee', o_custkey || 'uluna' FROM ev WHERE i = 1
  UNION ALL SELECT hash, i, type, 0, 'action', action FROM ev JOIN actions USING (priority) WHERE i = 2
  UNION ALL SELECT hash, i, type, 0, 'module', module FROM ev JOIN modules USING (priority, i)
  UNION ALL SELECT hash, i, type, 1, 'sender', cust FROM ev WHERE priority = '4-NOT SPECIFIED' AND i = 4
  UNION ALL SELECT hash, i, type, 0, 'fee_payer', cust FROM ev WHERE type = 'tx' AND i = 5
  UNION ALL SELECT hash, i, type, 0, 'recipient', CASE WHEN priority = '2-HIGH' THEN 'escrow' ELSE peer END FROM ev WHERE type = 'transfer'
  UNION ALL SELECT hash, i, type, 1, 'sender', CASE WHEN priority = '5-LOW' THEN 'escrow' ELSE cust END FROM ev WHERE type = 'transfer'
  UNION ALL SELECT hash, i, type, 2, 'amount', cents || CASE WHEN i = 6 THEN 'ibc/AB' ELSE 'uluna' END FROM ev WHERE type = 'transfer'
  UNION ALL SELECT hash, i, type, 0, 'sender', cust FROM ev WHERE type = 'ibc_transfer'
  UNION ALL SELECT hash, i, type, 1, 'receiver', peer FROM ev WHERE type = 'ibc_transfer'
  UNION ALL SELECT hash, i, type, 0, 'packet_sequence', '#' || o_custkey FROM ev WHERE type IN ('send_packet', 'acknowledge_packet')
  UNION ALL SELECT hash, i, type, 1, 'packet_src_channel', 'channel-1' FROM ev WHERE type IN ('send_packet', 'acknowledge_packet')
  UNION ALL SELECT hash, i, type, 2, 'packet_dst_channel', 'channel-2' FROM ev WHERE type IN ('send_packet', 'acknowledge_packet')
  UNION ALL SELECT hash, i, type, 0, 'packet_data', '{{"amount":"' || cents || '","denom":"uluna","receiver":"' || peer || '","sender":"far' || cust || '"}}'
    FROM ev WHERE type = 'write_acknowledgement'
  UNION ALL SELECT hash, i, type, 0, CASE status WHEN 'F' THEN 'destination_validator' ELSE 'validator' END, 'val1' FROM ev WHERE priority = '4-NOT SPECIFIED' AND i = 3
  UNION ALL SELECT hash, i, type, 1, 'amount', cents || 'uluna,7ibc/CD' FROM ev WHERE priority = '4-NOT SPECIFIED' AND i = 3
  UNION ALL SELECT hash, i, type, 2, CASE status WHEN 'F' THEN 'source_validator' WHEN 'O' THEN 'note' ELSE 'completion_time' END,
    CASE status WHEN 'P' THEN '2001-02-03T04:05:06Z' ELSE 'valold' END FROM ev WHERE priority = '4-NOT SPECIFIED' AND i = 3)
SELECT hash AS tx_id, CAST(i AS BIGINT) AS msg_index, type AS msg_type, CAST(a AS BIGINT) AS attribute_index, k AS attribute_key, v AS attribute_value FROM pairs
""")
def message_attributes(spark, sf):
    """Every attribute of every event."""
    gold = chain_gold.fact_msg_attributes_standard(Chain(spark, sf).attributes)
    return gold.select("tx_id", "msg_index", "msg_type", "attribute_index", "attribute_key", "attribute_value")


TRANSFERS = """
t AS (SELECT hash, block, day, status, i, 'TERRA' AS kind, CASE WHEN priority = '5-LOW' THEN 'escrow' ELSE cust END AS sender,
    CASE WHEN priority = '2-HIGH' THEN 'escrow' ELSE peer END AS receiver, cents,
    CASE WHEN i = 6 THEN 'ibc/AB' ELSE 'uluna' END AS currency FROM ev WHERE type = 'transfer'),
acks AS (SELECT DISTINCT o_custkey FROM o WHERE priority = '3-MEDIUM'),
ibc AS (SELECT hash, block, day, status, 3 AS i, 'IBC_TRANSFER_OUT' AS kind, cust AS sender, peer AS receiver, cents, 'uluna' AS currency
    FROM o WHERE priority = '2-HIGH' AND o_custkey IN (SELECT o_custkey FROM acks)
  UNION ALL SELECT hash, block, day, status, 4, 'IBC_TRANSFER_IN', 'far' || cust, peer, cents, 'uluna' FROM o WHERE priority = '5-LOW')
"""


@query(f"""
WITH {O}, {LAYOUT}, {TRANSFERS}
SELECT hash AS tx_id, block AS block_id, hash || '_' || i AS transfer_id, status <> 'P' AS tx_succeeded, kind AS transfer_type,
  sender, receiver, cents AS amount, currency, md5(hash || '-' || i) AS ez_transfers_id
FROM (SELECT * FROM t UNION ALL SELECT * FROM ibc)
""")
def transfers_roundtrip(spark, sf):
    chain = Chain(spark, sf)
    gold = chain_gold.ez_transfers(chain.transfers, chain.transfers_ibc)
    return gold.select(
        "tx_id", "block_id", "transfer_id", "tx_succeeded", "transfer_type", "sender", "receiver",
        F.col("amount").cast("bigint").alias("amount"), "currency", "ez_transfers_id",
    )


@query(f"""
WITH {O}, {LAYOUT}, {TRANSFERS}
SELECT hash AS tx_id, block AS block_id, i AS msg_index, sender, receiver, cents AS amount FROM t
""")
def chain_in_batches(spark, sf):
    """Transfers built over stored tables in three runs, each of which takes in the end of the run before once more."""
    chain = Chain(spark, sf)
    year = F.year("block_timestamp")
    keys = [["tx_id"], ["tx_id", "msg_index"], ["tx_id", "msg_index"]]
    transactions, events, transfers = [KeyedTable(spark, new_folder(spark, "batches"), k, year, moves=False) for k in keys]
    for low, high in [(1900, 1997), (1997, 1999), (1999, 2100)]:
        fresh = chain.transactions.where(year.between(low, high))
        transactions.merge(fresh)
        again = transactions.read().where(year.between(low, high))
        events.merge(chain_silver.msgs_2(again, RUN), ["inserted_timestamp"])
        newest = events.read().where(year.between(low, high))
        transfers.merge(chain_silver.transfers(newest, RUN), ["inserted_timestamp"])
    return transfers.read().select(
        "tx_id", "block_id", F.col("msg_index").cast("int").alias("msg_index"), "sender", "receiver", F.col("amount").cast("bigint").alias("amount")
    )


@query(f"""
WITH {O}, {LAYOUT}, {TRANSFERS}
SELECT hash AS tx_id, CAST(i AS BIGINT) AS msg_index, kind AS transfer_type, sender, receiver, cents AS amount FROM ibc
""")
def ibc_roundtrip(spark, sf):
    return Chain(spark, sf).transfers_ibc.select(
        "tx_id", "msg_index", "transfer_type", "sender", "receiver", F.col("amount").cast("bigint").alias("amount")
    )


@query(f"""
WITH {O}, {LAYOUT}
SELECT hash AS tx_id, CAST(i AS BIGINT) AS msg_index, type AS msg_type, '#' || o_custkey AS packet_sequence,
  'channel-1' AS packet_src_channel, 'channel-2' AS packet_dst_channel, md5(hash || '-' || i) AS id
FROM ev WHERE type IN ('send_packet', 'acknowledge_packet')
""")
def packets_roundtrip(spark, sf):
    return Chain(spark, sf).packets.select(
        "tx_id", "msg_index", "msg_type", "packet_sequence", "packet_src_channel", "packet_dst_channel",
        F.col("transfers_ibc_packets_id").alias("id"),
    )


@query(f"""
WITH {O}, coins(currency) AS (VALUES ('uluna'), ('ibc/CD')),
s AS (SELECT o.*, currency, CASE status WHEN 'F' THEN 'redelegate' WHEN 'O' THEN 'delegate' ELSE 'undelegate' END AS action
  FROM o, coins WHERE priority = '4-NOT SPECIFIED')
SELECT hash || '-0--1-' || action || '-' || currency || '-' || cust || '-val1' AS staking_id, block AS block_id,
  status <> 'P' AS tx_succeeded, action, cust AS delegator_address,
  CASE currency WHEN 'uluna' THEN cents ELSE 7 END AS amount, 'val1' AS validator_address,
  CASE status WHEN 'F' THEN 'valold' END AS validator_src_address, r_name AS validator_label,
  CAST(NULL AS VARCHAR) AS validator_src_label
FROM s JOIN region ON r_regionkey = 1
""")
def staking_roundtrip(spark, sf):
    labels = table(spark, sf, "region").select(
        F.concat(F.lit("val"), F.col("r_regionkey").cast("string")).alias("address"), F.col("r_name").alias("label")
    )
    gold = chain_gold.ez_staking(Chain(spark, sf).staking, labels)
    return gold.select(
        "staking_id", "block_id", "tx_succeeded", "action", "delegator_address", F.col("amount").cast("bigint").alias("amount"),
        "validator_address", "validator_src_address", "validator_label", "validator_src_label",
    )


@query(f"""
WITH {O} SELECT hash AS tx_id, cust AS tx_caller_address, currency, strftime(TIMESTAMP '2001-02-03 04:05:06', '%Y-%m-%d %H:%M:%S') AS done
FROM o, (VALUES ('uluna'), ('ibc/CD')) AS c(currency) WHERE priority = '4-NOT SPECIFIED' AND status = 'P'
""")
def unbonding_times(spark, sf):
    ends = Chain(spark, sf).staking.where(F.col("completion_time").isNotNull())
    return ends.select(
        "tx_id", "tx_caller_address", "currency", F.date_format("completion_time", "yyyy-MM-dd HH:mm:ss").alias("done")
    )


# ---------------------------------------------------------------- events of the log

LOG = """
shape(entry, event, type, urgent_only) AS (VALUES (0, 0, 'message', false), (0, 1, 'transfer', false), (1, 0, 'message', false),
  (1, 1, 'wasm', false), (2, 0, 'message', true), (2, 0, 'message', true), (2, 1, 'message', true), (2, 1, 'message', true)),
ev AS (SELECT hash, block, entry, event, type, CASE WHEN entry = 2 THEN '0:1' ELSE '0:0' END AS grp,
  row_number() OVER (PARTITION BY hash ORDER BY entry, event) AS num
  FROM o, shape WHERE status <> 'P' AND (NOT urgent_only OR priority = '1-URGENT'))
"""


@query(f"""
WITH {O}, {LOG}
SELECT hash AS tx_id, block AS block_id, CAST(entry AS BIGINT) AS msg_index, type AS msg_type, grp AS msg_group,
  md5(hash || '-' || entry || '-' || num) AS fact_msgs_id FROM ev
""")
def log_messages(spark, sf):
    chain = Chain(spark, sf)
    gold = chain_gold.fact_msgs(chain_silver.msgs(chain.transactions, chain.block_times, RUN))
    return gold.select("tx_id", "block_id", "msg_index", "msg_type", "msg_group", "fact_msgs_id")


LOGGED = """
actions(priority, action) AS (VALUES ('1-URGENT', '/cosmos.authz.v1beta1.MsgExec'), ('2-HIGH', '/ibc.applications.transfer.v1.MsgTransfer'),
  ('3-MEDIUM', '/ibc.core.channel.v1.MsgAcknowledgement'), ('4-NOT SPECIFIED', '/cosmos.staking.v1beta1.MsgDelegate'),
  ('5-LOW', '/ibc.core.channel.v1.MsgRecvPacket')),
logged AS (SELECT *, priority = '1-URGENT' AND status = 'O' AS two FROM o JOIN actions USING (priority) WHERE status <> 'P'),
pairs AS (SELECT hash, priority, two, unnest([
    {'entry': 0, 'event': 0, 'type': 'message', 'a': 0, 'k': 'action', 'v': action},
    {'entry': 0, 'event': 1, 'type': 'transfer', 'a': 0, 'k': 'recipient', 'v': peer},
    {'entry': 0, 'event': 1, 'type': 'transfer', 'a': 1, 'k': 'sender', 'v': cust},
    {'entry': 0, 'event': 1, 'type': 'transfer', 'a': 2, 'k': 'amount', 'v': cents || 'uluna'},
    {'entry': 0, 'event': 1, 'type': 'transfer', 'a': 3, 'k': 'amount', 'v': '5ibc/AB'},
    {'entry': 1, 'event': 0, 'type': 'message', 'a': 0, 'k': 'module', 'v': 'bank'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 0, 'k': '_contract_address', 'v': peer},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 1, 'k': 'action', 'v': 'swap'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 2, 'k': 'offer_asset', 'v': 'uluna'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 3, 'k': 'offer_amount', 'v': CAST(cents AS VARCHAR)},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 4, 'k': 'ask_asset', 'v': 'uusd'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 5, 'k': 'return_amount', 'v': CAST(o_custkey AS VARCHAR)},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 6, 'k': '_contract_address', 'v': 'pool2'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 7, 'k': 'action', 'v': 'swap'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 8, 'k': 'offer_asset', 'v': 'uusd'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 9, 'k': 'offer_amount', 'v': CAST(o_custkey AS VARCHAR)},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 10, 'k': 'ask_asset', 'v': 'ukrw'},
    {'entry': 1, 'event': 1, 'type': 'wasm', 'a': 11, 'k': 'return_amount', 'v': '11'},
    {'entry': 2, 'event': 0, 'type': 'message', 'a': 0, 'k': 'module', 'v': 'wasm'},
    {'entry': 2, 'event': 1, 'type': 'message', 'a': 0, 'k': 'module', 'v': 'bank'}], recursive := true) FROM logged),
attrs AS (SELECT * FROM pairs WHERE (a < 6 OR two) AND (entry < 2 OR priority = '1-URGENT'))
"""
NESTED = LOGGED + """, numbered AS (
  SELECT o.*, entry, type, k, v, count(*) OVER w AS n, row_number() OVER (w ORDER BY a) - 1 AS i
  FROM attrs JOIN o USING (hash, priority) WHERE entry < 2 WINDOW w AS (PARTITION BY hash, entry, event, k)),
suffixed AS (SELECT *, CASE WHEN n > 1 THEN '_' || i ELSE '' END AS suffix FROM numbered),
fields AS (SELECT *, k || suffix AS field, CASE WHEN k = 'amount' THEN regexp_extract(v, '[0-9]+') ELSE v END AS value FROM suffixed
  UNION ALL SELECT *, 'currency' || suffix, regexp_extract(v, '[^0-9].*') FROM suffixed WHERE k = 'amount')
"""


@query(f"""
WITH {O}, {LOGGED}, steps(entry, step) AS (VALUES (0, 0), (1, 0), (2, 0), (2, 1)),
rows AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY entry, event, step, a) AS num FROM attrs JOIN steps USING (entry))
SELECT hash AS tx_id, block AS block_id, CAST(entry AS BIGINT) AS msg_index, type AS msg_type, CASE WHEN entry = 2 THEN '0:1' ELSE '0:0' END AS msg_group,
  CAST(a AS BIGINT) AS attribute_index, k AS attribute_key, v AS attribute_value, md5(hash || '-' || entry || '-' || a || '-' || num) AS id
FROM rows JOIN o USING (hash)
""")
def log_attributes(spark, sf):
    chain = Chain(spark, sf)
    gold = chain_gold.fact_msg_attributes(chain_silver.msg_attributes(chain.transactions, chain.block_times, RUN))
    return gold.select(
        "tx_id", "block_id", "msg_index", "msg_type", "msg_group", "attribute_index", "attribute_key", "attribute_value",
        F.col("fact_msg_attributes_id").alias("id"),
    )


@query(f"""
WITH {O}, {NESTED}
SELECT hash || '-' || entry AS message_id, CAST(entry AS BIGINT) AS message_index, 'phoenix-1' AS chain_id,
  CASE WHEN priority = '1-URGENT' THEN '/cosmwasm.wasm.v1.MsgExecuteContract' ELSE '/cosmos.bank.v1beta1.MsgSend' END AS message_type,
  type AS event_type, field, value
FROM fields
""")
def nested_messages(spark, sf):
    """Every field of every nested object."""
    gold = chain_gold.ez_messages(Chain(spark, sf).messages)
    types = gold.select("message_id", "message_index", "chain_id", "message_type", F.explode("attributes").alias("event_type", "fields"))
    return types.select("message_id", "message_index", "chain_id", "message_type", "event_type", F.explode("fields").alias("field", "value"))


@query(f"""
WITH {O}
SELECT hash || '-2' AS message_id, 'message.module' AS reason, block AS block_id, strftime(day, '%Y-%m-%d') AS day
FROM o WHERE priority = '1-URGENT' AND status <> 'P'
""")
def odd_messages(spark, sf):
    """Messages in quarantine: two events of one type set one field, so there is no single nested object."""
    odd = Chain(spark, sf).odd_messages
    return odd.select("message_id", F.array_join("shared_fields", ",").alias("reason"), "block_id", F.date_format("block_timestamp", "yyyy-MM-dd").alias("day"))


@query(f"""
WITH {O}
SELECT hash || '-1-' || pool AS swap_id, cust AS trader, cents AS from_amount, 'uluna' AS from_currency, o_custkey AS to_amount,
  'uusd' AS to_currency, pool AS pool_id
FROM (SELECT *, unnest(CASE status WHEN 'O' THEN [peer, 'pool2'] ELSE [peer] END) AS pool FROM o WHERE priority = '1-URGENT' AND status <> 'P')
""")
def dex_swaps_roundtrip(spark, sf):
    """A message that swaps twice numbers its fields; each of its pools takes the offer that comes first by currency and amount."""
    chain = Chain(spark, sf)
    swaps = chain_silver.dex_swaps(chain.messages, chain.transactions)
    gold = chain_gold.ez_swaps(swaps).join(swaps.select("swap_id", "tx_id", "pool_id"), ["tx_id", "pool_id"])
    return gold.select(
        "swap_id", "trader", F.col("from_amount").cast("bigint").alias("from_amount"), "from_currency",
        F.col("to_amount").cast("bigint").alias("to_amount"), "to_currency", "pool_id",
    )


# ---------------------------------------------------------------- hourly metrics


def _prices(spark, sf):
    """A price on days that saw a failed low-priority order; other days carry the last one."""
    marked = table(spark, sf, "orders").where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == cl.LOW))
    return marked.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("terra-luna-2").alias("id"), F.col("day").cast("timestamp_ntz").alias("recorded_hour"),
        (F.sqrt(F.lit(2.0)) * F.col("n")).alias("close"),
    )


@query(f"""
WITH {O}, q AS (SELECT CAST(o_orderdate AS DATE) AS day, sqrt(2.0) * count(*) AS close FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW' GROUP BY 1),
h AS (SELECT day, min(block) AS b, count(*) AS n, count(*) FILTER (status <> 'P') AS ok, count(*) FILTER (status = 'P') AS failed,
  count(DISTINCT o_custkey) AS senders, CAST(CAST(sum(o_custkey) AS BIGINT) AS DOUBLE) / 1000000 AS fees FROM o GROUP BY day),
f AS (SELECT h.*, last_value(close IGNORE NULLS) OVER (ORDER BY h.day ROWS UNBOUNDED PRECEDING) AS price FROM h LEFT JOIN q USING (day))
SELECT strftime(day, '%Y-%m-%d') AS hour, b AS block_number_min, b AS block_number_max, 1 AS block_count, n AS transaction_count,
  ok AS transaction_count_success, failed AS transaction_count_failed, senders AS unique_from_count, fees AS total_fees_native,
  CAST(round(fees * price * 100) AS BIGINT) AS usd_cents, md5(strftime(day, '%Y-%m-%d') || ' 00:00:00') AS id FROM f
""")
def hourly_chain_metrics(spark, sf):
    chain = Chain(spark, sf)
    by_block = chain_stats.core_metrics_block_hourly(chain.blocks, RUN)
    by_tx = chain_stats.core_metrics_hourly(chain.transactions, chain.attributes, RUN)
    gold = chain_stats.ez_core_metrics_hourly(by_block, by_tx, chain_silver.hourly_prices(
        _prices(spark, sf).withColumns({c: F.lit(0.0) for c in ("open", "high", "low")}).withColumns(
            {"_inserted_timestamp": RUN.clock, "hourly_prices_coin_gecko_id": F.lit("")}
        ), RUN,
    ))
    return gold.select(
        F.date_format("block_timestamp_hour", "yyyy-MM-dd").alias("hour"), "block_number_min", "block_number_max",
        F.col("block_count").cast("int").alias("block_count"), "transaction_count", "transaction_count_success",
        "transaction_count_failed", "unique_from_count", "total_fees_native",
        F.round(F.col("total_fees_usd") * 100).cast("bigint").alias("usd_cents"),
        F.col("ez_core_metrics_hourly_id").alias("id"),
    )


# ---------------------------------------------------------------- completeness


def _metas(spark, sf):
    """Header-range answers, one per day; days with five orders more declare one transaction too many."""
    days = cl._days(spark, sf)
    height = F.col("block").cast("string")
    meta = F.struct(
        F.struct(
            F.lit("phoenix-1").alias("chain_id"), height.alias("height"),
            F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("time"),
        ).alias("header"),
        F.lit("77").alias("block_size"), F.struct(F.md5(height).alias("hash")).alias("block_id"),
        F.when(F.col("n") % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).cast("string").alias("num_txs"),
    )
    body = F.struct(F.array(F.struct(F.struct(F.array(meta).alias("block_metas")).alias("result"))).alias("data"))
    twice = days.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.select(
        F.parse_json(F.to_json(body)).alias("data"),
        (F.col("day").cast("timestamp_ntz") + F.make_interval(hours=F.col("copy"))).cast("timestamp_ntz").alias("_inserted_timestamp"),
    )


@query(f"""
WITH {O} SELECT block AS block_id, strftime(day, '%Y-%m-%d') AS day, 77 AS block_size,
  n + CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS num_txs, md5(CAST(block AS VARCHAR)) AS hash FROM days
""")
def block_metadata(spark, sf):
    rows = chain_silver.blockchain(_metas(spark, sf), RUN)
    return rows.select(
        "block_id", F.date_format("block_timestamp", "yyyy-MM-dd").alias("day"), F.col("block_size").cast("int").alias("block_size"),
        "num_txs", vstr("block_id_object", "hash").alias("hash"),
    )


@query(f"""
WITH {O}, r AS (SELECT min(block) AS lo, max(block) AS hi, min(ts) AS lo_ts, max(ts) AS hi_ts, count(*) AS n FROM days),
m AS (SELECT unnest(generate_series(lo, hi)) AS b FROM r), g AS (SELECT b FROM m WHERE b NOT IN (SELECT block FROM days))
SELECT 'blocks' AS test_name, lo AS min_block, hi AS max_block, lo_ts AS min_block_timestamp, hi_ts AS max_block_timestamp,
  hi - lo + 1 AS blocks_tested, (SELECT count(*) FROM g) AS blocks_impacted_count, (SELECT min(b) FROM g) AS first_impacted_block FROM r
""")
def blocks_completeness(spark, sf):
    report = observability.blocks_completeness(Chain(spark, sf).blocks, RUN)
    return report.select(
        "test_name", "min_block", "max_block", stamp("min_block_timestamp").alias("min_block_timestamp"),
        stamp("max_block_timestamp").alias("max_block_timestamp"), "blocks_tested", "blocks_impacted_count",
        "first_impacted_block",
    )


@query(f"""
WITH {O}, busy AS (SELECT block FROM days WHERE n > 2), m AS (SELECT unnest(generate_series(min(block), max(block))) AS block_id FROM busy),
g AS (SELECT block AS hi, lag(block) OVER (ORDER BY block) AS lo FROM busy)
SELECT block_id, lo AS prev_block_id, hi AS next_block_id FROM m JOIN g ON block_id > lo AND block_id < hi
""")
def missing_block_rows(spark, sf):
    """Days with at most two orders are left out, so that there are gaps."""
    busy = cl._days(spark, sf).where("n > 2").select(F.col("block").alias("block_id"))
    present = Chain(spark, sf).blocks.join(busy, "block_id", "left_semi")
    return observability.impacted_blocks(present, RUN).select("block_id", "prev_block_id", "next_block_id")


@query(f"""
WITH {O}, b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM days),
d AS (SELECT block, n, strftime(day, '%Y-%m-%d') || ' 00:00:00.000000' AS stamp FROM days)
SELECT 'transactions' AS test_name, min(block) AS min_block, max(block) AS max_block, count(*) AS blocks_tested,
  count(*) FILTER (n % 5 = 0) AS blocks_impacted_count, count(*) FILTER (n % 5 = 0) AS transactions_impacted_count,
  min(block) FILTER (n % 5 = 0) AS first_impacted_block
FROM d, b WHERE stamp BETWEEN lo AND hi
""")
def transactions_completeness(spark, sf):
    report = observability.transactions_completeness(_block_counts(spark, sf), RUN)
    return report.select(
        "test_name", "min_block", "max_block", "blocks_tested", "blocks_impacted_count", "transactions_impacted_count",
        "first_impacted_block",
    )


def _block_counts(spark, sf):
    declared = chain_silver.blockchain(_metas(spark, sf), RUN)
    return observability.block_counts(cl.tx_responses(spark, sf), Chain(spark, sf).blocks, declared, RUN)


@query(f"""
WITH {O}, b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM days),
d AS (SELECT block, n, strftime(day, '%Y-%m-%d') || ' 00:00:00.000000' AS stamp FROM days)
SELECT block AS block_id, -1 AS diff, n + 1 AS blockchain_num_txs, n AS bronze_num_txs FROM d, b WHERE stamp BETWEEN lo AND hi AND n % 5 = 0
""")
def impacted_transaction_rows(spark, sf):
    rows = observability.impacted_transactions(_block_counts(spark, sf), RUN)
    return rows.select("block_id", F.col("diff").cast("int").alias("diff"), "blockchain_num_txs", "bronze_num_txs")


# ---------------------------------------------------------------- work-lists


@query(f"WITH {O} SELECT day, CAST(max(block) - 500 AS BIGINT) AS block_id FROM (SELECT strftime(day, '%Y-%m-%d') AS day, block FROM days) GROUP BY 1")
def chain_head(spark, sf):
    """The newest block worth asking for, from a status answer of each day."""
    orders = cl.orders(spark, sf).groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.max("block").alias("block"))
    sync = F.struct(F.struct(F.col("block").cast("string").alias("latest_block_height")).alias("sync_info"))
    status = orders.select("day", F.parse_json(F.to_json(F.struct(sync.alias("result")))).alias("data"))
    return status.select("day", worklists.head_of(F.col("data")).alias("block_id"))


def _urgent(spark, sf):
    """Blocks that have landed, as far as the work-list queries are concerned: days with an urgent order."""
    return cl.orders(spark, sf).where(F.col("priority") == cl.URGENT)


def _months(spark, sf):
    """Blocks stamped with their month, so the third-newest 'day' lies two months back."""
    month = F.trunc("o_orderdate", "month").cast("timestamp_ntz")
    blocks = cl.orders(spark, sf).select(F.col("block").alias("block_height"), month.alias("block_timestamp"))
    return worklists.max_block_by_date(blocks)


SINCE = """
mon AS (SELECT date_trunc('month', day) AS m, max(block) AS b FROM o GROUP BY 1),
third AS (SELECT b FROM mon WHERE m <> (SELECT max(m) FROM mon) ORDER BY b DESC LIMIT 1 OFFSET 2)
"""


@query(f"""
WITH {O}, {SINCE}, u AS (SELECT unnest(generate_series(1, (SELECT max(block) FROM o))) AS block_id),
m AS (SELECT block_id FROM u WHERE block_id >= (SELECT b FROM third) AND block_id NOT IN (SELECT block FROM o WHERE priority = '1-URGENT'))
SELECT block_id, 'block' AS kind, '{{"jsonrpc": "2.0","method": "block", "params":["' || block_id || '"],"id":"' || block_id || '"}}' AS request FROM m
UNION ALL SELECT block_id, 'search', '{{"jsonrpc": "2.0","method": "tx_search", "params":["tx.height=' || block_id ||
  '",true, "1" ,"100" ,"asc"],"id":"' || block_id || '"}}' FROM m
""")
def worklist_missing(spark, sf):
    head = cl.orders(spark, sf).agg(F.max("block")).first()[0]
    universe, by_date = worklists.block_universe(spark, head), _months(spark, sf)
    landed = _urgent(spark, sf).select(F.col("block").alias("block_number"))
    one = worklists.missing_block_requests(universe, by_date, landed).withColumn("kind", F.lit("block"))
    two = worklists.missing_search_requests(universe, by_date, landed).withColumn("kind", F.lit("search"))
    return one.unionByName(two).select("block_id", "kind", "request")


@query(f"""
WITH {O}, s AS (SELECT min(block) AS lo, max(block) AS hi FROM o), u AS (SELECT unnest(generate_series(lo, hi)) AS block_id FROM s)
SELECT block_id, '{{"jsonrpc": "2.0","method": "block", "params":["' || block_id || '"],"id":"' || block_id || '"}}' AS request
FROM u WHERE block_id NOT IN (SELECT block FROM o WHERE priority = '1-URGENT')
""")
def worklist_young_chain(spark, sf):
    """With a single full day every block since the first one is asked for."""
    ends = cl.orders(spark, sf).agg(F.min("block").alias("lo"), F.max("block").alias("hi")).first()
    by_date = worklists.max_block_by_date(
        cl.orders(spark, sf).select(F.col("block").alias("block_height"), F.to_date(F.lit("2024-01-01")).alias("block_timestamp"))
    )
    universe = numbers(spark, ends["hi"], ends["lo"], "block_id")
    landed = _urgent(spark, sf).select(F.col("block").alias("block_number"))
    return worklists.missing_block_requests(universe, by_date, landed).select("block_id", "request")


@query(f"""
WITH {O}, {SINCE}, p AS (SELECT block, unnest(generate_series(2, CAST(ceil(n * 2000 / 100.0) AS BIGINT))) AS page FROM days
  WHERE n * 2000 > 100 AND block > (SELECT b FROM third)),
a AS (SELECT DISTINCT block, 2 AS page FROM o WHERE priority = '1-URGENT')
SELECT block AS block_id, page AS id, '{{"jsonrpc": "2.0","method": "tx_search", "params":["tx.height=' || block || '",true, "' || page ||
  '" ,"100" ,"asc"],"id":"' || block || '"}}' AS request
FROM p WHERE (block, page) NOT IN (SELECT block, page FROM a)
""")
def worklist_pages(spark, sf):
    """Blocks of thousands of transactions: all of their pages are asked for."""
    blocks = cl._days(spark, sf).select(F.col("block").alias("block_id"), (F.col("n") * 2000).alias("tx_count"))
    params = F.array(F.lit("tx.height"), F.lit("true"), F.lit("2"))
    landed = _urgent(spark, sf).select(
        F.col("block").alias("block_number"),
        F.parse_json(F.to_json(F.struct(F.struct(params.alias("params")).alias("request")))).alias("metadata"),
    )
    return worklists.missing_page_requests(blocks, _months(spark, sf), landed).select("block_id", "id", "request")


def _numbered_blocks(spark, sf):
    """A block for each order, and those of them that have landed."""
    every = cl.orders(spark, sf).select((F.col("o_orderkey") + 4710578).alias("block_id"), "priority")
    return every.select("block_id"), every.where(F.col("priority") == cl.URGENT).select("block_id")


@query(f"""
WITH {O}, m AS (SELECT o_orderkey + 4710578 AS block FROM o WHERE priority <> '1-URGENT'),
t AS (SELECT block, (row_number() OVER (ORDER BY block DESC) - 1) // 75 + 1 AS grp FROM m)
SELECT grp, string_agg('{{"id":' || block || ',"jsonrpc":"2.0","method":"block","params":["' || block || '"]}}', ';' ORDER BY block) AS calls
FROM t GROUP BY grp
""")
def worklist_batches(spark, sf):
    """All missing blocks, 75 a batch."""
    every, landed = _numbered_blocks(spark, sf)
    missing = worklists.missing_ids(every, landed, "block_id")
    batches = worklists.batched_calls(missing, "block_id", 75, "block", worklists.block_params())
    return batches.select("grp", F.array_join("calls", ";").alias("calls"))


@query(f"""
WITH {O}, n AS (SELECT o_orderkey + 4710578 AS b, (row_number() OVER (ORDER BY o_orderkey) - 1) // 20 AS run FROM o WHERE priority <> '1-URGENT'),
r AS (SELECT run, min(b) AS lo, max(b) AS hi FROM n GROUP BY run)
SELECT run // 100 + 1 AS groupid_out,
  string_agg('{{"jsonrpc":"2.0","id":' || lo || ',"method":"blockchain","params":["' || lo || '","' || hi || '"]}}', ';' ORDER BY run) AS calls
FROM r GROUP BY 1
""")
def worklist_headers(spark, sf):
    """All pending blocks in runs of 20, a hundred runs a call."""
    every, known = _numbered_blocks(spark, sf)
    ranges = worklists.header_ranges(every, known)
    return ranges.select("groupid_out", F.array_join("call", ";").alias("calls"))


@query(f"""
WITH {O} SELECT hash AS tx_id FROM o WHERE status <> 'F' AND hash NOT IN (SELECT hash FROM o WHERE priority = '1-URGENT')
""")
def worklist_repairs(spark, sf):
    seed = cl.orders(spark, sf).where(F.col("status") != "F").select(F.col("hash").alias("tx_id"))
    body = F.struct(F.struct(F.struct(F.col("block").alias("height")).alias("tx_response")).alias("data"))
    answered = _urgent(spark, sf).select(F.col("hash").alias("tx_id"), F.parse_json(F.to_json(body)).alias("data"))
    return worklists.repair_list(seed, answered)


@query(f"""
WITH {O} SELECT block AS block_number, CAST(round(block, -3) AS BIGINT) AS part, priority AS body FROM o WHERE status <> 'P'
UNION ALL SELECT NULL, NULL, NULL FROM o WHERE status = 'P'
""")
def landed_batches(spark, sf):
    """Answers of failed orders are empty lists; each keeps one row of nulls."""
    entry = F.struct(F.col("block").alias("id"), F.col("priority").alias("result"))
    answer = F.when(F.col("status") == "P", F.lit('{"data":[],"headers":{}}')).otherwise(
        F.to_json(F.struct(F.array(entry).alias("data")))
    )
    results = cl.orders(spark, sf).select(F.parse_json(answer).alias("data"))
    landed = worklists.land_responses(results, RUN)
    return landed.select("block_number", F.col("_partition_by_block_id").alias("part"), vstr("data", "result").alias("body"))


@query(f"""
WITH {O} SELECT hash AS tx_id, block AS block_id, CASE status WHEN 'F' THEN cust ELSE 'x' END AS tx_sender, o_custkey AS gas_used FROM o
""")
def repaired_transactions(spark, sf):
    c = F.col
    sender = F.when(c("status") == "F", F.base64(c("cust").cast("binary"))).otherwise("x")
    attribute = F.struct(F.lit("spender").alias("key"), sender.alias("value"))
    response = F.struct(
        c("block").alias("height"), F.lit("1999-01-01T00:00:00Z").alias("timestamp"), c("hash").alias("txhash"),
        c("o_custkey").cast("string").alias("gas_used"), F.array(F.struct(F.array(attribute).alias("attributes"))).alias("events"),
    )
    body = F.struct(F.struct(response.alias("tx_response")).alias("data"))
    answers = cl.orders(spark, sf).select(F.parse_json(F.to_json(body)).alias("data"), RUN.clock.alias("_inserted_timestamp"))
    return chain_silver.manual_transactions(answers).select("tx_id", "block_id", "tx_sender", "gas_used")


@query("""
SELECT n.h AS height, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series(1, (SELECT max(o_custkey) FROM orders))) AS h) n
LEFT JOIN orders ON o_custkey = n.h GROUP BY 1
""")
def number_table(spark, sf):
    """A generated number table against the counts of the keys that occur."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("height")).agg(F.count(F.lit(1)).alias("orders"))
    last = table(spark, sf, "orders").agg(F.max("o_custkey")).first()[0]
    return numbers(spark, last).join(counts, "height", "left").select("height", F.coalesce("orders", F.lit(0)).alias("orders"))


