"""The predecessor chain's tables over a sink log derived from orders, against plain SQL over orders."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerlake.functions import vstr
from ledgerlake.plans import classic_bronze, classic_dex, classic_gold, classic_silver
from ledgerlake.plans import classic_lending as lending
from workload import classiclike as cl
from workload import query, table
from workload.classiclike import EVENTS, KINDS, MESSAGES, SECOND, SECOND_EVENTS, Classic

M6 = "/ 1000000.0"


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value) + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(x if x.isdigit() else _text(x) for x in map(str, row)) + ")" for row in rows)


TYPES = _values([(k, m[0], m[1]) for k, m in MESSAGES.items()])
ALL_TYPES = _values([(k, i, m[0], m[1]) for i, sent in enumerate((MESSAGES, SECOND)) for k, m in sent.items()])
EVENT_ROWS = _values([(k, i, e[0]) for sent in (EVENTS, SECOND_EVENTS) for k, events in sent.items() for i, e in enumerate(events)])
ACTION_ROWS = _values(
    [
        (kind, name.split("_")[0], a["contract_address"], a["action_log"].get("action") or a["action_log"].get("method"))
        for kind, events in EVENTS.items() for e in events if e[2] for name, a in json.loads(e[2]).items()
    ]
)
C = f"""
c AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, list_extract([{', '.join(map(_text, KINDS))}], o_orderkey % {len(KINDS)} + 1) AS kind,
  'user' || (o_custkey % 40) AS u, 'peer' || (o_orderkey % 5) AS v, CAST(round(o_totalprice * 100) AS DOUBLE) AS n,
  CAST(o_custkey AS DOUBLE) AS k, md5(CAST(o_orderkey AS VARCHAR)) AS hash, CAST(o_orderdate AS DATE) AS day,
  datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS d, o_orderstatus <> 'P' AS ok,
  CASE o_orderstatus WHEN 'F' THEN 'columbus-4' ELSE 'columbus-5' END AS chain FROM orders),
types(kind, module, type) AS (VALUES {TYPES}),
lab AS (SELECT 'user' || n_nationkey AS address, 'operator' AS l1, 'sub' AS l2,
    CASE WHEN n_nationkey >= 20 THEN 'delegator_address' ELSE n_name END AS name,
    CASE WHEN n_nationkey >= 20 THEN 'val' || n_nationkey ELSE 'project' || n_regionkey END AS project FROM nation WHERE n_nationkey <> 7
  UNION ALL SELECT 'vp' || n_nationkey, 'operator', 'sub', 'vp_address', 'val' || n_nationkey FROM nation WHERE n_nationkey >= 20
  UNION ALL SELECT '{lending.MARKET}', 'defi', 'pool', r_name, 'market' FROM region WHERE r_regionkey = 0),
dy AS (SELECT DISTINCT day, d FROM c),
lp AS (SELECT day, d, CASE WHEN d % 3 <> 0 THEN CAST(d % 10 + 1 AS DOUBLE) END AS p FROM dy),
lf AS (SELECT *, last_value(p IGNORE NULLS) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS f FROM lp),
fd AS (SELECT DISTINCT day FROM c WHERE kind = 'feed' AND ok),
px AS (
  SELECT day, 'uusd' AS currency, 'UST' AS symbol, 2.0::DOUBLE AS rate, f / 2 AS price, 'oracle' AS source FROM lf
  UNION ALL SELECT day, 'ukrw', 'KRT', 4.0, f / 4, 'oracle' FROM lf
  UNION ALL SELECT day, 'uluna', 'LUNA', 1.0, p, 'coinmarketcap' FROM lp WHERE p IS NOT NULL
  UNION ALL SELECT day, 'terra15gwkyepfc6xgca5t5zefzwy42uts8l2m4g40k6', 'MIR', p / 2, 2.0, 'coinmarketcap' FROM lp
  UNION ALL SELECT day, 'terra14z56l0fp2lsf86zy3hty2z47ezkhnthtr9yq76', 'ANC', p / 4, 4.0, 'coinmarketcap' FROM lp
  UNION ALL SELECT day, 'terra1kcthelkax4j9x8d3ny6sdag0qmxxynl3qtcrpy', 'MINE', p / 0.5, 0.5, 'coinmarketcap' FROM lp
  UNION ALL SELECT lp.day, 'tokA', NULL, p / 1.5, 1.5, 'oracle' FROM lp JOIN fd USING (day)
  UNION ALL SELECT lp.day, 'tokB', NULL, p / 2.5, 2.5, 'oracle' FROM lp JOIN fd USING (day)
  UNION ALL SELECT lp.day, '{classic_dex.EIGHT_DECIMAL_SWAP_TOKEN}', NULL, p / 3, 3.0, 'oracle' FROM lp JOIN fd USING (day)),
made AS (SELECT DISTINCT k FROM c WHERE kind = 'astro_pair')
"""


def day(column: str = "block_timestamp"):
    return F.date_format(column, "yyyy-MM-dd").alias("day")


DAY_SQL = "strftime(c.day, '%Y-%m-%d') AS day"
MARKET_NAME = f"(SELECT name FROM lab WHERE address = '{lending.MARKET}')"


# ---------------------------------------------------------------- facts and dimensions


@query(f"""
WITH {C} SELECT hash AS tx_id, d AS block_id, {DAY_SQL}, chain AS chain_id, ok, module AS msg_module, type AS msg_type, 'terra' AS blockchain,
  CAST(i AS BIGINT) AS msg_index FROM c JOIN (VALUES {ALL_TYPES}) AS sent(kind, i, module, type) USING (kind)
""")
def classic_messages(spark, sf):
    gold = classic_gold.fact_messages(Classic(spark, sf).msgs)
    return gold.select(
        "tx_id", F.col("block_id").cast("bigint").alias("block_id"), day(), "chain_id", (F.col("tx_status") == "SUCCEEDED").alias("ok"),
        "msg_module", "msg_type", "blockchain", "msg_index",
    )


@query(f"""
WITH {C}, e(kind, i, event) AS (VALUES {EVENT_ROWS})
SELECT hash AS tx_id, d AS block_id, CAST(i AS BIGINT) AS event_index, event AS event_type FROM c JOIN e USING (kind)
""")
def classic_message_events(spark, sf):
    gold = classic_gold.fact_message_events(Classic(spark, sf).events)
    return gold.select("tx_id", "block_id", "event_index", "event_type")


@query(f"""
WITH {C}, a(kind, i, contract, method) AS (VALUES {ACTION_ROWS})
SELECT hash AS tx_id, CAST(i AS BIGINT) AS action_index, replace(contract, '<k>', CAST(CAST(k AS BIGINT) AS VARCHAR)) AS action_contract_address,
  method AS action_method, lab.name AS contract_label
FROM c JOIN a USING (kind) LEFT JOIN lab ON contract = lab.address
""")
def classic_event_actions(spark, sf):
    k = Classic(spark, sf)
    return classic_gold.ez_event_actions(k.actions, k.labels).select(
        "tx_id", "action_index", "action_contract_address", "action_method", "contract_label"
    )


@query(f"""
WITH {C} SELECT address, l1 AS label_type, l2 AS label_subtype, project AS label, name AS address_name FROM lab
""")
def classic_labels(spark, sf):
    return classic_gold.dim_labels(Classic(spark, sf).all_labels).select(
        "address", "label_type", "label_subtype", "label", "address_name"
    )


@query("""
SELECT 'val' || n_nationkey AS label, CAST(NULL AS VARCHAR) AS operator_address, 'user' || n_nationkey AS delegator_address,
  'vp' || n_nationkey AS vp_address FROM nation WHERE n_nationkey >= 20
""")
def validator_labels(spark, sf):
    return classic_gold.dim_validator_labels(Classic(spark, sf).all_labels)


@query(f"""
WITH {C} SELECT strftime(day, '%Y-%m-%d') AS day, currency, symbol,
  rate AS luna_exchange_rate, price AS price_usd, source FROM px
""")
def oracle_prices(spark, sf):
    return Classic(spark, sf).prices.select(
        day(), "currency", "symbol", "luna_exchange_rate", "price_usd", "source"
    )


@query(f"""
WITH {C} SELECT d AS block_id, {DAY_SQL.replace('c.day', 'dy.day')}, CAST(i AS BIGINT) AS index, denom FROM dy,
  (VALUES (0, 'uusd'), (1, 'ukrw')) AS t(i, denom)
""")
def classic_transitions(spark, sf):
    gold = classic_gold.fact_transitions(Classic(spark, sf).transitions)
    return gold.select("block_id", day(), "index", vstr("event_attributes", "denom").alias("denom"))


# ---------------------------------------------------------------- transfers


TRANSFERS = f"""
x AS (
  SELECT hash, day, type, u AS f, v AS t, n {M6} AS a, 'uusd' AS cur FROM c JOIN types USING (kind) WHERE kind = 'send' AND ok
  UNION SELECT hash, day, type, u, v, n {M6}, 'ukrw' FROM c JOIN types USING (kind) WHERE kind = 'multi' AND ok
  UNION SELECT hash, day, type, v, u, k {M6}, 'uluna' FROM c JOIN types USING (kind) WHERE kind = 'multi' AND ok
  UNION SELECT hash, day, type, u, v, n {M6}, 'tokA' FROM c JOIN types USING (kind) WHERE kind = 'token' AND ok
  UNION SELECT hash, day, type, 'bridge', v, n {M6}, 'uluna' FROM c JOIN types USING (kind) WHERE kind = 'native' AND ok
  UNION SELECT hash, day, type, '{cl.WORMHOLE}', v, n {M6}, 'tokB' FROM c JOIN types USING (kind) WHERE kind = 'wrapped' AND ok),
sy AS (SELECT currency, max_by(symbol, day) AS symbol FROM px GROUP BY 1)
"""


@query(f"""
WITH {C}, {TRANSFERS}
SELECT hash AS tx_id, type AS msg_type, f AS event_from, a1.l1 AS from_type, a1.project AS from_label, a1.name AS from_name,
  t AS event_to, a2.name AS to_name, a AS event_amount, a * price AS event_amount_usd, coalesce(sy.symbol, cur) AS event_currency
FROM x LEFT JOIN px ON x.day = px.day AND cur = px.currency LEFT JOIN sy ON cur = sy.currency
LEFT JOIN lab a1 ON f = a1.address LEFT JOIN lab a2 ON t = a2.address
""")
def classic_transfers(spark, sf):
    k = Classic(spark, sf)
    gold = classic_gold.ez_transfers(k.msgs, k.events, k.prices, k.hourly, k.labels)
    return gold.select(
        "tx_id", "msg_type", "event_from", F.col("event_from_label_type").alias("from_type"),
        F.col("event_from_address_label").alias("from_label"), F.col("event_from_address_name").alias("from_name"),
        "event_to", F.col("event_to_address_name").alias("to_name"), "event_amount", "event_amount_usd", "event_currency",
    )


@query(f"""
WITH {C}, sy AS (SELECT currency, max_by(symbol, day) AS symbol FROM px GROUP BY 1),
x AS (
  SELECT hash, day, '0' AS i, u AS s, v AS r, 'uusd' AS cur, n {M6} AS a, NULL AS act, NULL AS con FROM c WHERE kind = 'send' AND ok
  UNION ALL SELECT hash, day, '0', 'bridge', v, 'uluna', n {M6}, 'submit_vaa', '{cl.WORMHOLE}' FROM c WHERE kind = 'native' AND ok
  UNION ALL SELECT hash, day, '0', u, v, 'uusd', n {M6}, NULL, NULL FROM c WHERE kind = 'swap' AND ok
  UNION ALL SELECT hash, day, '1', v, u, 'ukrw', k {M6}, NULL, NULL FROM c WHERE kind = 'swap' AND ok
  UNION ALL SELECT hash, day, '0', 'relay', v, 'tokB', n {M6}, 'submit_vaa', 'tokB' FROM c WHERE kind = 'wrapped' AND ok
  UNION ALL SELECT hash, day, '0', u, v, 'tokA', n {M6}, 'transfer', 'tokA' FROM c WHERE kind = 'token' AND ok)
SELECT hash AS tx_id, CAST(i AS BIGINT) AS action_index, act AS initial_action, act AS current_action, s AS sender, a1.name AS sender_address_name,
  r AS recipient, a2.project AS recipient_label, a AS amount, a * price AS amount_usd, coalesce(sy.symbol, cur) AS currency, con AS contract_address
FROM x LEFT JOIN px ON x.day = px.day AND cur = px.currency LEFT JOIN sy ON cur = sy.currency
LEFT JOIN lab a1 ON s = a1.address LEFT JOIN lab a2 ON r = a2.address
""")
def classic_transfer_events(spark, sf):
    k = Classic(spark, sf)
    gold = classic_gold.ez_transfer_events(classic_silver.transfer_events(k.events, k.msgs), k.prices, k.hourly, k.labels)
    return gold.select(
        "tx_id", "action_index", "initial_action", "current_action", "sender", "sender_address_name", "recipient",
        "recipient_label", "amount", "amount_usd", "currency", "contract_address",
    )


# ---------------------------------------------------------------- staking, rewards, governance


@query(f"""
WITH {C} SELECT hash AS tx_id, kind AS action, u AS delegator_address, a1.address AS delegator_address_name,
  CASE kind WHEN 'redelegate' THEN 'user2' ELSE 'user1' END AS validator_address, a2.project AS validator_address_label,
  n {M6} AS event_amount, price AS price_usd, n {M6} * price AS event_amount_usd, symbol AS currency
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uluna' LEFT JOIN lab a1 ON u = a1.address
LEFT JOIN lab a2 ON a2.address = CASE kind WHEN 'redelegate' THEN 'user2' ELSE 'user1' END
WHERE kind IN ('delegate', 'undelegate', 'redelegate') AND ok
""")
def classic_staking(spark, sf):
    k = Classic(spark, sf)
    return classic_gold.ez_staking(k.msgs, k.hourly, k.labels).select(
        "tx_id", "action", "delegator_address", "delegator_address_name", "validator_address", "validator_address_label",
        "event_amount", "price_usd", "event_amount_usd", "currency",
    )


@query(f"""
WITH {C}, r AS (
  SELECT hash, day, 'withdraw_delegator_rewards' AS action, 0 AS i, n {M6} AS a, 'uluna' AS cur, 'user2' AS val, u AS del FROM c WHERE kind = 'reward' AND ok
  UNION ALL SELECT hash, day, 'withdraw_delegator_rewards', 1, k {M6}, 'uusd', 'user2', u FROM c WHERE kind = 'reward' AND ok
  UNION ALL SELECT hash, day, 'withdraw_validator_commission', 0, n {M6}, 'uluna', 'user3', u FROM c WHERE kind = 'commission' AND ok)
SELECT hash AS tx_id, action, i AS position, val AS validator, a2.name AS validator_address_name, del AS delegator, a1.name AS delegator_address_name,
  a AS event_amount, a * price AS event_amount_usd, symbol AS currency
FROM r LEFT JOIN px ON r.day = px.day AND cur = px.currency LEFT JOIN lab a1 ON del = a1.address LEFT JOIN lab a2 ON val = a2.address
""")
def classic_rewards(spark, sf):
    k = Classic(spark, sf)
    gold = classic_gold.ez_reward(
        classic_silver.withdraw_delegator_rewards(k.events, k.msgs),
        classic_silver.withdraw_validator_commission(k.events, k.msgs), k.hourly, k.labels,
    )
    return gold.select(
        "tx_id", "action", F.col("event_attributes_amount_index").alias("position"), "validator", "validator_address_name",
        "delegator", "delegator_address_name", "event_amount", "event_amount_usd", "currency",
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS proposer, a1.address AS proposer_address_name, id AS proposal_id, 'text' AS proposal_type, 'D' AS description,
  'T' || id AS title, n {M6} AS deposit_amount, n {M6} * price AS deposit_amount_usd, 'uluna' AS deposit_currency
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uluna' LEFT JOIN lab a1 ON u = a1.address WHERE kind = 'proposal' AND ok
""")
def classic_proposals(spark, sf):
    k = Classic(spark, sf)
    return classic_gold.ez_gov_submit_proposal(k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "proposer", "proposer_address_name", "proposal_id", "proposal_type", "description", "title",
        "deposit_amount", "deposit_amount_usd", "deposit_currency",
    )


DAILY = """
b AS (SELECT u, day, arg_max(n, CAST(id AS BIGINT) % 86400) AS n FROM c WHERE kind = 'delegate' GROUP BY 1, 2),
iv AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY u ORDER BY day), DATE '2010-01-02') AS until FROM b)
"""


@query(f"""
WITH {C}, {DAILY}
SELECT hash AS tx_id, c.u AS voter, a1.project AS voter_address_label, id AS proposal_id, 'yes' AS option,
  CASE WHEN CAST(substr(c.u, 5) AS INTEGER) BETWEEN 20 AND 24 THEN CAST(d * 1000 + CAST(substr(c.u, 5) AS INTEGER) AS DOUBLE) ELSE iv.n END AS voting_power
FROM c LEFT JOIN lab a1 ON c.u = a1.address LEFT JOIN iv ON iv.u = c.u AND c.day >= iv.day AND c.day < iv.until
WHERE kind = 'vote' AND ok
""")
def classic_votes(spark, sf):
    k = Classic(spark, sf)
    validators = classic_gold.dim_validator_labels(k.all_labels)
    gold = classic_gold.ez_gov_vote(k.msgs, k.daily, cl.voting_power(spark, sf), validators, k.labels)
    return gold.select("tx_id", "voter", "voter_address_label", "proposal_id", "option", "voting_power")


@query(f"""
WITH {C}, {DAILY}
SELECT u AS address, count(*) AS changes, CAST(sum(datediff('day', day, until)) AS BIGINT) AS days,
  CAST(sum(CAST(n AS BIGINT) * datediff('day', day, until)) AS BIGINT) AS cent_days FROM iv GROUP BY u
""")
def daily_balance_days(spark, sf):
    k = Classic(spark, sf)
    changes = k.balances.groupBy("address").agg(F.count_distinct(F.to_date("block_timestamp")).alias("changes"))
    totals = k.daily.groupBy("address").agg(
        F.count(F.lit(1)).alias("days"), F.sum(F.col("balance").cast("bigint")).alias("cent_days")
    )
    return totals.join(changes, "address")


@query(f"""
WITH {C} SELECT block_id, address, power AS voting_power FROM (SELECT d AS block_id, 'vp' || x AS address, d * 1000 + x AS power FROM dy, range(20, 25) AS r(x))
""")
def validator_voting_power(spark, sf):
    gold = classic_gold.dim_validator_voting_power(cl.voting_power(spark, sf))
    return gold.select("block_id", "address", "voting_power")


# ---------------------------------------------------------------- swaps and pools


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS trader, k {M6} AS swap_fee_amount, k {M6} * us.price AS swap_fee_amount_usd, us.symbol AS swap_fee_currency,
  kr.symbol AS ask_currency, n {M6} AS offer_amount, n {M6} * us.price AS offer_amount_usd, us.symbol AS token_0_currency,
  k {M6} AS token_1_amount, k {M6} * kr.price AS token_1_amount_usd, us.symbol || ' to ' || kr.symbol AS swap_pair
FROM c LEFT JOIN px us ON c.day = us.day AND us.currency = 'uusd' LEFT JOIN px kr ON c.day = kr.day AND kr.currency = 'ukrw'
WHERE kind = 'swap' AND ok
""")
def classic_swaps(spark, sf):
    k = Classic(spark, sf)
    return classic_gold.ez_swaps(k.msgs, k.events, k.hourly).select(
        "tx_id", "trader", "swap_fee_amount", "swap_fee_amount_usd", "swap_fee_currency", "ask_currency", "offer_amount",
        "offer_amount_usd", "token_0_currency", "token_1_amount", "token_1_amount_usd", "swap_pair",
    )


POOL_SWAPS = f"""
SELECT hash AS tx_id, CAST(2 AS BIGINT) AS tx_index, u AS sender, n {M6} AS offer_amount, n {M6} * us.price AS offer_amount_usd, 'uusd' AS offer_currency,
  k {M6} AS return_amount, k {M6} * kr.price AS return_amount_usd, 'ukrw' AS return_currency, 'pool1' AS pool_address, CAST(NULL AS VARCHAR) AS pool_name
FROM c LEFT JOIN px us ON c.day = us.day AND us.currency = 'uusd' LEFT JOIN px kr ON c.day = kr.day AND kr.currency = 'ukrw'
WHERE kind = 'pool_swap'
"""
POOL_SWAP_COLUMNS = [
    "tx_id", "tx_index", "sender", "offer_amount", "offer_amount_usd", "offer_currency", "return_amount",
    "return_amount_usd", "return_currency", "pool_address", "pool_name",
]


# Swaps of a token with eight decimals at pools that may be the other factory's; one table scales it by 10^8, the other by 10^6.
ASTRO_SWAPS = f"""
SELECT hash AS tx_id, CAST(0 AS BIGINT) AS tx_index, u AS sender, n / <unit> AS offer_amount, n / <unit> * odd.price * <scale> AS offer_amount_usd,
  '{classic_dex.EIGHT_DECIMAL_SWAP_TOKEN}' AS offer_currency, k {M6} AS return_amount, k {M6} * us.price AS return_amount_usd, 'uusd' AS return_currency,
  'astro' || CAST(k AS BIGINT) AS pool_address, CAST(NULL AS VARCHAR) AS pool_name
FROM c LEFT JOIN px us ON c.day = us.day AND us.currency = 'uusd'
LEFT JOIN px odd ON c.day = odd.day AND odd.currency = '{classic_dex.EIGHT_DECIMAL_SWAP_TOKEN}' WHERE kind = 'astro_swap'
"""


def _scaled(unit: str, scale: str) -> str:
    return ASTRO_SWAPS.replace("<unit>", unit).replace("<scale>", scale)


@query(f"WITH {C} {_scaled('1e8', '100')}")
def astroport_swaps(spark, sf):
    k = Classic(spark, sf)
    return classic_dex.ez_astroport_swaps(k.actions, k.msgs, k.hourly, k.labels, k.dex).select(*POOL_SWAP_COLUMNS)


@query(f"WITH {C} {POOL_SWAPS} UNION ALL {_scaled('1e6', '1')} AND k NOT IN (SELECT k FROM made)")
def terraswap_swaps(spark, sf):
    """Swaps at pools that the other factory made are left out."""
    k = Classic(spark, sf)
    return classic_dex.ez_terraswap_swaps(k.actions, k.msgs, k.events, k.hourly, k.labels, k.dex).select(*POOL_SWAP_COLUMNS)


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE kind WHEN 'withdraw_lp' THEN 'withdraw_liquidity' ELSE 'provide_liquidity' END AS event_type, u AS sender, n {M6} AS token_0_amount, n {M6} * us.price AS token_0_amount_usd,
  'uusd' AS token_0_currency, k {M6} AS token_1_amount, k {M6} * kr.price AS token_1_amount_usd, 'ukrw' AS token_1_currency,
  CASE kind WHEN 'astro_provide' THEN 'astro' || CAST(k AS BIGINT) ELSE 'pool1' END AS pool_address, CAST(id AS DOUBLE) {M6} AS lp_share_amount,
  CASE kind WHEN 'astro_provide' THEN 'lp2' ELSE 'lp1' END AS lp_pool_address
FROM c LEFT JOIN px us ON c.day = us.day AND us.currency = 'uusd' LEFT JOIN px kr ON c.day = kr.day AND kr.currency = 'ukrw'
WHERE kind IN ('provide', 'withdraw_lp') OR (kind = 'astro_provide' AND k NOT IN (SELECT k FROM made))
""")
def terraswap_lp_actions(spark, sf):
    k = Classic(spark, sf)
    return classic_dex.ez_terraswap_lp_actions(k.actions, k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "event_type", "sender", "token_0_amount", "token_0_amount_usd", "token_0_currency", "token_1_amount",
        "token_1_amount_usd", "token_1_currency", "pool_address", "lp_share_amount", "lp_pool_address",
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE WHEN kind IN ('unstake_lp', 'zap_out') THEN 'unstake_lp' ELSE 'stake_lp' END AS event_type,
  CASE kind WHEN 'unstake_lp' THEN v ELSE u END AS sender, n {M6} AS amount, 'tokLP' AS contract_address, CAST(NULL AS VARCHAR) AS contract_label
FROM c WHERE kind IN ('stake_lp', 'unstake_lp') OR (kind IN ('auto_stake', 'reinvest', 'zap_out', 'zap_in') AND ok)
""")
def terraswap_lp_stake(spark, sf):
    k = Classic(spark, sf)
    return classic_dex.ez_terraswap_lp_stake(k.actions, k.msgs, k.events, k.labels, k.dex).select(
        "tx_id", "event_type", "sender", "amount", "contract_address", "contract_label"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, 'terra1c' || id AS contract_address, CAST(6 AS BIGINT) AS decimals, 'N' || id AS contract_name, 'S' || id AS symbol
FROM c WHERE kind = 'instantiate'
UNION ALL SELECT hash, 'terra1a' || id, 8, 'Name a' || id, 'a' || id FROM c WHERE kind = 'set_up'
UNION ALL SELECT hash, 'terra1b' || id, NULL, NULL, NULL FROM c WHERE kind = 'set_up'
UNION ALL SELECT hash, 'terra1' || kind[1] || id, 8, 'Name ' || kind[1] || id, kind[1] || id FROM c WHERE kind IN ('whitelist', 'relist')
UNION ALL SELECT hash, 'pool' || id, NULL, lab.project || ' LP pool', NULL FROM c JOIN lab ON lab.address = 'user5' WHERE kind = 'pair'
UNION ALL SELECT hash, 'lp' || id, 6, lab.project || ' LP token', NULL FROM c JOIN lab ON lab.address = 'user5' WHERE kind = 'pair'
""")
def contract_dimension(spark, sf):
    """Contracts from instantiation, from set-ups of several contracts, from whitelists with details of the endpoint, and pools."""
    k = Classic(spark, sf)
    return classic_gold.dim_contract_metadata(k.metadata, k.dex).select(
        "tx_id", "contract_address", F.col("decimals").cast("bigint").alias("decimals"), "contract_name", "symbol"
    )


# ---------------------------------------------------------------- lending


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS sender, n {M6} AS bonded_amount, n {M6} * price AS bonded_amount_usd, 'user4' AS validator
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uluna' WHERE kind = 'bond' AND ok
""")
def lending_bonds(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_bonds(k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "sender", "bonded_amount", "bonded_amount_usd", "validator"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, chain AS chain_id, u AS sender, n {M6} AS amount, n {M6} * price AS amount_usd, 'tokA' AS currency
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'tokA' WHERE kind = 'burn' AND ok
""")
def lending_burns(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_burns(k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "chain_id", "sender", "amount", "amount_usd", "currency"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE kind WHEN 'deposit' THEN u ELSE v END AS sender, n {M6} AS deposit_amount, n {M6} * price AS deposit_amount_usd, 'uusd' AS deposit_currency,
  k {M6} AS mint_amount, '{lending.DEPOSIT_TOKEN}' AS mint_currency, {MARKET_NAME} AS contract_label,
  CASE kind WHEN 'deposit' THEN 'Terra' ELSE 'Wormhole' END AS source
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uusd' WHERE kind IN ('deposit', 'bridge_deposit')
""")
def lending_deposits(spark, sf):
    """A deposit is seen by message and by action; both ways give the same row, which is kept once. Bridged ones have actions only."""
    k = Classic(spark, sf)
    return lending.ez_anchor_deposits(k.msgs, k.events, k.actions, k.hourly, k.labels).select(
        "tx_id", "sender", "deposit_amount", "deposit_amount_usd", "deposit_currency", "mint_amount", "mint_currency",
        "contract_label", "source",
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE kind WHEN 'bridge_redeem' THEN v ELSE u END AS sender, n {M6} AS amount, '{lending.DEPOSIT_TOKEN}' AS currency,
  '{lending.MARKET}' AS contract_address, {MARKET_NAME} AS contract_label, CASE kind WHEN 'bridge_redeem' THEN 'Wormhole' ELSE 'Terra' END AS source
FROM c WHERE (kind = 'redeem' AND ok) OR kind IN ('bridge_redeem', 'vault_redeem')
""")
def lending_redeem(spark, sf):
    """Redemptions by event, through the bridge, and through a contract that only leaves actions."""
    k = Classic(spark, sf)
    return lending.ez_anchor_redeem(k.msgs, k.events, k.actions, k.hourly, k.labels).select(
        "tx_id", "sender", "amount", "currency", "contract_address", "contract_label", "source"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE kind WHEN 'borrow' THEN u ELSE v END AS sender, n {M6} AS amount, n {M6} * price AS amount_usd, 'uusd' AS currency,
  {MARKET_NAME} AS contract_label, CASE kind WHEN 'borrow' THEN 'Terra' ELSE 'Wormhole' END AS source
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uusd' WHERE kind IN ('borrow', 'bridge_borrow')
""")
def lending_borrows(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_borrows(k.msgs, k.actions, k.hourly, k.labels).select(
        "tx_id", "sender", "amount", "amount_usd", "currency", "contract_label", "source"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS sender, CASE kind WHEN 'repay' THEN u ELSE 'custody' END AS borrower, n {M6} AS amount, n {M6} * price AS amount_usd,
  'uusd' AS currency, CASE kind WHEN 'repay' THEN 'Terra' ELSE 'Wormhole' END AS source
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uusd' WHERE kind IN ('repay', 'bridge_repay')
""")
def lending_repay(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_repay(k.msgs, k.actions, k.hourly, k.labels).select(
        "tx_id", "sender", "borrower", "amount", "amount_usd", "currency", "source"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, CASE kind WHEN 'collateral' THEN 'withdraw' ELSE 'provide' END AS event_type, u AS sender, n {M6} AS amount, n {M6} * price AS amount_usd,
  'tokA' AS currency, CASE kind WHEN 'collateral' THEN '{lending.MARKET}' ELSE '{lending.COLLATERAL_CONTRACTS[0]}' END AS contract_address, 'Terra' AS source
  FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'tokA' WHERE kind IN ('collateral', 'collateral_in') AND ok
UNION ALL SELECT hash, 'provide', u, n / 1e8, NULL, '{lending.EIGHT_DECIMAL_COLLATERAL}', 'custody', 'Wormhole' FROM c WHERE kind = 'bridge_collateral' AND ok
UNION ALL SELECT hash, 'withdraw', v, k / 1e8, NULL, '{lending.EIGHT_DECIMAL_COLLATERAL}', 'custody', 'Wormhole' FROM c WHERE kind = 'bridge_collateral' AND ok
""")
def lending_collateral(spark, sf):
    """Collateral withdrawn by one message, provided by two, and moved through the bridge in a token with eight decimals."""
    k = Classic(spark, sf)
    return lending.ez_anchor_collateral(k.msgs, k.events, k.actions, k.hourly, k.labels).select(
        "tx_id", "event_type", "sender", "amount", "amount_usd", "currency", "contract_address", "source"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, k {M6} AS bid_fee, CASE WHEN ok THEN '3' END AS premium_rate, v AS borrower, u AS liquidator, n {M6} AS liquidated_amount,
  n {M6} * price AS liquidated_amount_usd, 'uusd' AS liquidated_currency, 'custody' AS contract_address
FROM c LEFT JOIN px ON c.day = px.day AND px.currency = 'uusd' WHERE kind = 'liquidate'
""")
def lending_liquidations(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_liquidations(k.msgs, k.actions, k.hourly, k.labels).select(
        "tx_id", "bid_fee", "premium_rate", "borrower", "liquidator", "liquidated_amount", "liquidated_amount_usd",
        "liquidated_currency", "contract_address",
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, 'stake' AS event_type, u AS sender, n {M6} AS amount, n {M6} * 4 AS amount_usd, CAST(CAST(k AS BIGINT) AS VARCHAR) AS shares
  FROM c WHERE kind = 'gov_stake' AND ok
UNION ALL SELECT hash, 'unstake', u, n {M6}, n {M6} * 4, NULL FROM c WHERE kind = 'gov_unstake' AND ok
""")
def lending_gov_staking(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_gov_staking(k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "event_type", "sender", "amount", "amount_usd", "shares"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, id AS poll_id, CAST(CAST(k AS BIGINT) AS VARCHAR) AS end_time, u AS creator, n {M6} AS amount, 'T' || id AS title, 'L' AS link,
  'D' AS description, 'm' AS msg FROM c WHERE kind = 'poll' AND ok
""")
def lending_polls(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_gov_submit_proposal(k.msgs, k.events, k.labels).select(
        "tx_id", "poll_id", "end_time", "creator", "amount", "title", "link", "description", vstr("msg").alias("msg")
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS voter, id AS poll_id, 'yes' AS vote, n {M6} AS balance FROM c WHERE kind = 'cast' AND ok
""")
def lending_votes(spark, sf):
    k = Classic(spark, sf)
    return lending.ez_anchor_gov_vote(k.msgs, k.labels).select("tx_id", "voter", "poll_id", "vote", "balance")


@query(f"""
WITH {C} SELECT hash AS tx_id, u AS sender, CASE kind WHEN 'rewards' THEN 0 WHEN 'lp_rewards' THEN n {M6} ELSE k {M6} END AS claim_0_amount,
  CASE kind WHEN 'lp_rewards' THEN 0 ELSE n {M6} END AS claim_1_amount, CASE kind WHEN 'lp_rewards' THEN 0 ELSE n {M6} * 4 END AS claim_1_amount_usd,
  {MARKET_NAME} AS claim_1_contract_label FROM c WHERE kind IN ('rewards', 'lp_rewards', 'multi_claim') AND ok
""")
def lending_reward_claims(spark, sf):
    """Rewards of borrowers, of the pool, and of both by two messages of one transaction."""
    k = Classic(spark, sf)
    return lending.ez_anchor_reward_claims(k.msgs, k.events, k.hourly, k.labels).select(
        "tx_id", "sender", "claim_0_amount", "claim_1_amount", "claim_1_amount_usd", "claim_1_contract_label"
    )


@query(f"""
WITH {C} SELECT hash AS tx_id, '1' AS airdrop_id, u AS claimer, n {M6} AS amount, 'airdrop' AS contract_address FROM c WHERE kind = 'claim' AND ok
""")
def airdrop_claims(spark, sf):
    k = Classic(spark, sf)
    return classic_gold.ez_airdrop_claims(k.msgs, k.labels).select("tx_id", "airdrop_id", "claimer", "amount", "contract_address")


# ---------------------------------------------------------------- smaller streams


@query(f"""
WITH {C} SELECT d AS block_id, strftime(day, '%Y-%m-%d') AS day, 'prop' || d % 5 AS proposer_address, CAST(n AS BIGINT) AS tx_count
FROM (SELECT day, d, count(*) AS n FROM c GROUP BY 1, 2)
""")
def classic_blocks(spark, sf):
    log = cl.block_log(spark, sf)
    gold = classic_gold.fact_blocks(classic_silver.blocks(classic_bronze.classic_blocks(log)))
    return gold.select("block_id", day(), "proposer_address", "tx_count")


@query(f"""
WITH {C} SELECT hash AS tx_id, d AS block_id, u AS tx_from, ok, n AS gas_used, 1 AS fees FROM c
""")
def classic_transactions(spark, sf):
    log = cl.transaction_log(spark, sf)
    gold = classic_gold.fact_transactions(classic_silver.transactions(classic_bronze.classic_transactions(log)))
    return gold.select(
        "tx_id", "block_id", vstr("tx_from", "[0]").alias("tx_from"), (F.col("tx_status") == "SUCCEEDED").alias("ok"),
        "gas_used", F.size("fee").alias("fees"),
    )


@query(f"""
WITH {C} SELECT 'columbus-5' AS blockchain, d AS block_number, strftime(day, '%Y-%m-%d') AS day, d / 1000.0::DOUBLE AS tax_rate FROM dy
""")
def classic_tax_rate(spark, sf):
    rate = F.when(F.col("created") == 2000, F.col("d") / 1000.0).otherwise(0.0)
    result = F.to_json(
        F.struct(
            F.col("d").alias("block_number"), F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("block_timestamp"), rate.alias("tax_rate")
        )
    )
    extra = ',"executor":{"chain_id":"columbus-5-long"}'
    log = cl.small_log(spark, sf, "terra-5_tax_rate", result, cl.days(spark, sf), extra)
    return classic_gold.dim_tax_rate(classic_silver.tax_rate(log)).select("blockchain", "block_number", day(), "tax_rate")


@query(f"""
WITH {C}, h AS (SELECT *, 5839538 + d AS height FROM c WHERE kind = 'provide')
SELECT DISTINCT exchange, CAST(height AS BIGINT) AS block_id, id AS contract_address, n {M6} AS total_share, 'uusd' AS token_0_currency,
  k {M6} AS token_0_amount, k {M6} AS token_1_amount FROM h, (VALUES ('a'), ('t')) AS e(exchange)
WHERE exchange = 't' OR height >= 5840738
""")
def pool_reserves(spark, sf):
    """Heights lie on both sides of the first block that one of the exchanges counts."""
    fields = F.struct(
        F.when(F.col("created") == 2000, F.col("n")).otherwise("0").alias("total_share"), F.lit("uusd").alias("asset_1"),
        F.col("k").alias("asset_1_value"), F.lit("ukrw").alias("asset_2"), F.col("k").alias("asset_2_value"),
    )
    result = F.to_json(
        F.struct(
            F.lit("columbus-5").alias("chain_id"), (F.col("d") + 5839538).alias("block_id"), F.lit("terra").alias("blockchain"),
            F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("block_timestamp"), F.col("id").alias("contract_address"), fields.alias("value_obj"),
        )
    )
    rows = cl.orders(spark, sf).where(F.col("kind") == "provide")
    one = classic_bronze.classic_astroport_pool_reserves(cl.small_log(spark, sf, "terra-5_astroport_pool_reserves", result, rows))
    two = classic_bronze.classic_terraswap_pool_reserves(cl.small_log(spark, sf, "terra-5_terraswap_pool_reserves_bison", result, rows))
    gold = lambda df, name: classic_gold.dim_pool_reserves(classic_silver.pool_reserves(df)).withColumn("exchange", F.lit(name))
    return gold(one, "a").unionByName(gold(two, "t")).select(
        "exchange", "block_id", "contract_address", "total_share", "token_0_currency", "token_0_amount", "token_1_amount"
    )


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS token_id, p_name AS token_name, p_brand AS project_name, p_type AS trait FROM part WHERE p_size >= 10
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, 'Galactic Punks', p_type FROM part WHERE p_size < 10
""")
def nft_metadata(spark, sf):
    part = table(spark, sf, "part")
    sink = F.struct(
        F.struct(
            F.array(F.struct(F.lit("db.schema.nft_metadata").alias("destination"))).alias("sinks"), F.lit("terra").alias("blockchain")
        ).alias("model"),
        F.array(
            F.struct(
                F.lit("c").alias("contract_address"), F.lit("name").alias("contract_name"), F.lit("url").alias("image_url"),
                F.col("p_brand").alias("project_name"), F.col("p_partkey").cast("string").alias("token_id"),
                F.struct(F.col("p_type").alias("trait")).alias("token_metadata"), F.col("p_name").alias("token_name"),
            )
        ).alias("results"),
    )
    trait = F.concat(F.lit('[{"trait":"'), F.col("p_type"), F.lit('"}]'))
    punk = F.array(
        F.struct(
            F.lit("p").alias("collection_addr"), F.lit("src").alias("src"), F.col("p_partkey").cast("string").alias("token_id"),
            trait.alias("attributes"), F.lit('{"more":1}').alias("additional_metadata"), F.col("p_name").alias("name"),
        )
    )

    def records(rows, body, key: str):
        metadata = F.to_json(F.struct(F.lit(key).alias("key"), F.lit(1000).alias("CreateTime")))
        return rows.select(F.parse_json(metadata).alias("record_metadata"), F.parse_json(F.to_json(body)).alias("record_content"))

    uploads = records(part.where(F.col("p_size") >= 10), sink, "upload")
    proxy = records(part.where(F.col("p_size") < 10), punk, classic_bronze.PUNK_FEED_KEY)
    gold = classic_gold.dim_nft_metadata(classic_silver.nft_metadata(classic_bronze.classic_nft_metadata(uploads, proxy)))
    trait = F.coalesce(vstr("token_metadata", "trait"), vstr("token_metadata", "traits.trait"))
    return gold.select("token_id", "token_name", "project_name", trait.alias("trait"))


@query(f"""
WITH {C} SELECT u AS address, count(*) AS balances, CAST(sum(CAST(n AS BIGINT)) AS BIGINT) AS cents FROM c WHERE kind = 'delegate' GROUP BY u
""")
def classic_balances(spark, sf):
    return Classic(spark, sf).balances.groupBy("address").agg(
        F.count(F.lit(1)).alias("balances"), F.sum(F.col("balance").cast("bigint")).alias("cents")
    )


@query(f"""
WITH {C}, {DAILY},
held AS (SELECT u, n, CAST(unnest(generate_series(day, until - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM iv),
quotes AS (SELECT symbol, day, avg(price) AS p FROM px GROUP BY 1, 2),
own AS (SELECT *, CAST(substr(u, 5) AS INTEGER) % 2 = 0 AS contract FROM held),
known AS (SELECT d, last_value(p IGNORE NULLS) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS p
  FROM (SELECT DISTINCT d FROM own WHERE contract) LEFT JOIN quotes ON symbol = 'UST' AND day = d)
SELECT strftime(x.d, '%Y-%m-%d') AS day, u AS address, lab.name AS address_name, lab.project AS address_label, currency, is_native, balance, balance * p AS balance_usd
FROM (SELECT d, u, 'LUNA' AS currency, true AS is_native, n AS balance, p FROM held LEFT JOIN quotes ON symbol = 'LUNA' AND day = d
  UNION ALL SELECT own.d, u, 'UST', false, n, p FROM own JOIN known ON own.d = known.d WHERE contract) x LEFT JOIN lab ON u = lab.address
""")
def daily_balances_usd(spark, sf):
    """Balances of every day in USD. Contracts hold a second currency for every other account, whose days without a price
    take the last one."""
    k = Classic(spark, sf)
    even = F.substring("address", F.lit(5), F.length("address")).try_cast("int") % 2 == 0
    synthetic = k.daily.where(even).withColumns({"currency": F.lit("UST"), "balance_type": F.lit("liquid"), "is_native": F.lit(False)})
    gold = classic_gold.dim_daily_balances(k.daily, synthetic, k.prices, classic_gold.dim_labels(k.all_labels), k.labels)
    return gold.select(day("date"), "address", "address_name", "address_label", "currency", "is_native", "balance", "balance_usd")


