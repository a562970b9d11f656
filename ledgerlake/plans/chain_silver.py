"""Typed, deduplicated tables of the current chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import (
    coin_amount, coin_denom, decode_attr, denom_cut, joined_key, safe_json, surrogate_key, varray, vdec, vlong, vmap, vstr,
    vtime, vvar,
)
from ledgerlake.functions.binding import let, runs
from ledgerlake.operators.dedupe import first_value_by, latest_by
from ledgerlake.operators.flatten import flatten_array, split_rows
from ledgerlake.operators.joins import semi, sorted_side, with_next
from ledgerlake.operators.pivot import object_merge
from ledgerlake.plans.chain_bronze import LAST_OLD_BLOCK, block_metas, response_blocks, response_transactions
from ledgerlake.run import Run



def _newest() -> list[Column]:
    return [F.col("_inserted_timestamp").desc()]


# ---------------------------------------------------------------- blocks


def _latest_blocks(bronze: DataFrame, responses: DataFrame) -> DataFrame:
    return latest_by(bronze.unionByName(response_blocks(responses)), ["block_id"], _newest())


def blocks_val_array(bronze: DataFrame, responses: DataFrame, run: Run) -> DataFrame:
    """Validators that signed the *previous* block: the row key is the height of the carried commit.

    The signatures of one commit lie in one row, so the distinct set is taken in the row and nothing is shuffled
    beyond the dedupe.
    """
    latest = _latest_blocks(bronze, responses)
    commit = F.when(F.col("block_id") <= LAST_OLD_BLOCK, vvar("header", "last_commit")).otherwise(F.col("last_commit"))
    signers = F.transform(varray("commit", "signatures"), lambda s: vstr(s, "validator_address"))
    rows = latest.select(commit.alias("commit"), "_inserted_timestamp").select(
        vlong("commit", "height").alias("block_id"),
        F.sort_array(F.array_distinct(F.filter(signers, lambda a: a.isNotNull()))).alias("validator_address_array"),
        "_inserted_timestamp",
    )
    kept = rows.where(F.array_size("validator_address_array") > 0)
    return run.audit(kept.withColumn("blocks_val_id", surrogate_key("block_id")))


def blocks(bronze: DataFrame, responses: DataFrame, validators: DataFrame, run: Run) -> DataFrame:
    """silver.blocks: the latest landing of each block, with the validators of its commit."""
    latest = _latest_blocks(bronze, responses)
    signers = latest_by(
        validators.select("block_id", "validator_address_array", "_inserted_timestamp"), ["block_id"], _newest()
    ).drop("_inserted_timestamp")
    joined = latest.join(signers, "block_id", "left")
    out = joined.select(
        "block_id",
        "block_timestamp",
        "tx_count",
        vstr("header", "app_hash").alias("block_hash"),
        vstr("header", "chain_id").alias("chain_id"),
        vstr("header", "consensus_hash").alias("consensus_hash"),
        vstr("header", "data_hash").alias("data_hash"),
        F.coalesce(vvar("header", "evidence"), F.col("evidence")).alias("evidence"),
        vstr("header", "evidence_hash").alias("evidence_hash"),
        vlong("header", "height").alias("block_height"),
        vvar("header", "last_block_id").alias("last_block_id"),
        "last_commit",
        vstr("header", "last_commit_hash").alias("last_commit_hash"),
        vstr("header", "last_results_hash").alias("last_results_hash"),
        vstr("header", "next_validators_hash").alias("next_validators_hash"),
        vstr("header", "proposer_address").alias("proposer_address"),
        vstr("header", "validators_hash").alias("validators_hash"),
        F.col("_inserted_timestamp").alias("_ingested_at"),
        "_inserted_timestamp",
        "validator_address_array",
        surrogate_key("block_id").alias("blocks_id"),
    )
    return run.audit(out)


# ---------------------------------------------------------------- transactions


def resolve_sender(key: Column, value: Column, payer: Column, grantee: Column, acc_seq: Column) -> Column:
    """Who paid: the first attribute of the first event decides which field to trust."""
    fallback = F.coalesce(grantee, F.split_part(acc_seq, F.lit("/"), F.lit(1)))
    return (
        F.when((key == "granter") & payer.isNotNull(), payer)
        .when((key == "fee") & fallback.isNotNull(), fallback)
        .otherwise(value)
    )


def _old_only(value: Column) -> Column:
    return F.when(F.col("block_id") <= LAST_OLD_BLOCK, value)


def _event_text(event: int, field: str, root: str = "tx_result.events") -> Column:
    return decode_attr(vstr("tx", f"{root}[{event}].attributes[0].{field}"))


def transactions(
    bronze: DataFrame, responses: DataFrame, silver_blocks: DataFrame, run: Run, manual: DataFrame | None = None
) -> DataFrame:
    """silver.transactions: the latest landing of each transaction.

    ``manual`` (repaired transactions) is given on a full refresh only.
    """
    latest = latest_by(bronze.unionByName(response_transactions(responses)), ["tx_id"], _newest())
    signer = "auth_info.signer_infos[0]"
    single = F.when(vstr("tx", f"{signer}.public_key.key").isNotNull(), F.array(vstr("tx", f"{signer}.public_key.key")))
    several = F.transform(varray("tx", f"{signer}.public_key.public_keys"), lambda v: vstr(v))
    rows = latest.select(
        "tx_id",
        "block_id",
        "block_timestamp",
        _old_only(F.try_element_at(F.map_keys(vmap("tx", f"{signer}.mode_info")), F.lit(1))).alias("auth_type"),
        _old_only(F.coalesce(single, several)).alias("authorizer_public_key"),
        resolve_sender(
            _event_text(0, "key"),
            _event_text(0, "value"),
            _old_only(vstr("tx", "auth_info.fee.payer")),
            _old_only(vstr("tx", "body.messages[0].grantee")),
            _event_text(1, "value"),
        ).alias("tx_sender"),
        _old_only(vdec("tx", "auth_info.fee.gas_limit")).alias("gas_limit"),
        vdec("tx", "tx_result.gasUsed").alias("gas_used"),
        _old_only(vdec("tx", "auth_info.fee.amount[0].amount")).alias("fee_raw"),
        _old_only(vstr("tx", "auth_info.fee.amount[0].denom")).alias("fee_denom"),
        _old_only(vstr("tx", "body.memo")).alias("memo"),
        vstr("tx", "tx_result.codespace").alias("codespace"),
        vlong("tx", "tx_result.code").alias("tx_code"),
        F.coalesce(vlong("tx", "tx_result.code") == 0, F.lit(False)).alias("tx_succeeded"),
        "tx",
        "_ingested_at",
        "_inserted_timestamp",
    )
    if manual is not None:
        repaired = manual.withColumns(
            {
                "tx_code": F.lit(None).cast("bigint"),
                "authorizer_public_key": F.lit(None).cast("array<string>"),
                "gas_limit": F.col("gas_limit").cast("decimal(38,0)"),
                "gas_used": F.col("gas_used").cast("decimal(38,0)"),
                "fee_raw": F.col("fee_raw").cast("decimal(38,0)"),
            }
        )
        rows = rows.unionByName(repaired.select(*rows.columns))
    times = silver_blocks.select("block_id", F.col("block_timestamp").alias("_block_time"))
    joined = rows.join(times, "block_id")
    out = joined.withColumns(
        {
            "block_timestamp": F.coalesce("block_timestamp", "_block_time"),
            "transactions_id": surrogate_key("tx_id"),
        }
    )
    return run.audit(out.select(*_first(rows.columns, "tx_id", "block_id"), "transactions_id"))


def _first(columns: list[str], *front: str) -> list[str]:
    return [*front, *[c for c in columns if c not in front]]


def transactions_total_count(responses: DataFrame, run: Run) -> DataFrame:
    """Declared number of transactions per block, latest response."""
    counts = responses.select(
        F.col("block_number").alias("block_id"),
        vlong("data", "result.total_count").alias("total_count"),
        "_inserted_timestamp",
    ).where(F.col("total_count").isNotNull())
    latest = latest_by(counts, ["block_id"], _newest())
    return run.audit(latest.withColumn("transactions_total_count_id", surrogate_key("block_id")))


def manual_transactions(answers: DataFrame) -> DataFrame:
    """Transactions fetched one by one after a failed search."""
    tx = "data.tx_response"
    none = F.lit(None)
    key, value = (decode_attr(vstr("data", f"{tx}.events[0].attributes[0].{f}")) for f in ("key", "value"))
    empty = none.cast("string")
    rows = answers.select(
        vlong("data", f"{tx}.height").alias("block_id"),
        vtime("data", f"{tx}.timestamp").alias("block_timestamp"),
        vstr("data", f"{tx}.codespace").alias("codespace"),
        vlong("data", f"{tx}.gas_used").alias("gas_used"),
        vlong("data", f"{tx}.gas_wanted").alias("gas_wanted"),
        vstr("data", f"{tx}.txhash").alias("tx_id"),
        empty.alias("auth_type"),
        empty.alias("authorizer_public_key"),
        key.alias("msg0_key"),
        value.alias("msg0_value"),
        empty.alias("tx_grantee"),
        empty.alias("tx_granter"),
        empty.alias("tx_payer"),
        empty.alias("acc_seq"),
        resolve_sender(key, value, empty, empty, empty).alias("tx_sender"),
        none.cast("bigint").alias("gas_limit"),
        none.cast("bigint").alias("fee_raw"),
        empty.alias("fee_denom"),
        empty.alias("memo"),
        vvar("data", tx).alias("tx"),
        F.lit("").alias("tx_code"),
        none.cast("boolean").alias("tx_succeeded"),
        F.col("_inserted_timestamp").alias("_ingested_at"),
        "_inserted_timestamp",
    ).where(F.col("block_id").isNotNull())
    return latest_by(rows, ["block_id", "tx_id"], _newest())


# ---------------------------------------------------------------- events of the transaction result

# events as one typed array, so that each is read out of its VARIANT once
PAIRS = "array<struct<key:string,value:string>>"
EVENTS = f"array<struct<type:string,attributes:{PAIRS}>>"
# Actions besides ``*exec*`` that open a group with sub-groups.
GROUPED_ACTIONS = ["/ibc.core.channel.v1.MsgRecvPacket", "/ibc.applications.transfer.v1.MsgTransfer"]


def _positions(events: Column, test) -> Column:
    marked = F.transform(events, lambda e, i: F.when(test(e), i.cast("int")))
    return F.filter(marked, lambda p: p.isNotNull())


def msgs_2(silver_transactions: DataFrame, run: Run) -> DataFrame:
    """One row per event, numbered by the action it belongs to.

    All events of a transaction sit in one row, so the groups are worked out there from three short position lists
    (actions, exec-like actions, module events) and the events are exploded last: no shuffle and no window.

    * ``msg_group``: actions up to here, minus one; null before the first action.
    * ``msg_sub_group``: in an exec-like group, the module events before this one, as long as one still follows in
      the group; otherwise 0, or null when the transaction ends with a ``tx`` event.
    """
    events = varray("tx", "tx_result.events")
    read = F.transform(
        "events",
        lambda e: F.struct(vstr(e, "type").alias("type"), vstr(e, "attributes[0].key").alias("key"), vstr(e, "attributes[0].value").alias("value")),
    )
    heads = F.transform(read, lambda e: F.struct(e["type"].alias("type"), decode_attr(e["key"]).alias("key"), e["value"].alias("value")))

    def exec_like(e):
        # the value stands last, for only that of an action is decoded
        named = let(decode_attr(e["value"]), lambda v: F.lower(v).contains("exec") | v.isin(GROUPED_ACTIONS))
        return (e["type"] == "message") & (e["key"] == "action") & named

    base = silver_transactions.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "_inserted_timestamp", events.alias("events")
    ).select("*", heads.alias("heads"))
    listed = base.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "_inserted_timestamp", "events",
        _positions(F.col("heads"), lambda e: e["key"] == "action").alias("actions"),
        _positions(F.col("heads"), exec_like).alias("execs"),
        _positions(F.col("heads"), lambda e: (e["key"] == "module") & (e["type"] == "message")).alias("modules"),
        F.try_element_at("heads", F.lit(-1))["type"].alias("last_type"),
    )
    rows = listed.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "_inserted_timestamp",
        "actions", "execs", "modules", "last_type",
        F.posexplode("events").alias("msg_index", "msg"),
    )
    here = F.col("msg_index")
    rows = rows.withColumns(
        {
            "started": F.filter("actions", lambda p: p <= here),
            "next_action": F.array_min(F.filter("actions", lambda p: p > here)),
        }
    )
    start = F.array_max("started")
    before = F.size(F.filter("modules", lambda m: (m >= start) & (m < here)))
    follows = F.exists(
        "modules", lambda m: (m >= here) & (F.col("next_action").isNull() | (m < F.col("next_action")))
    )
    grouped = F.size("started") > 0
    in_exec = grouped & F.array_contains("execs", start)
    out = rows.select(
        "block_id",
        "block_timestamp",
        "tx_id",
        "tx_succeeded",
        F.when(grouped, (F.size("started") - 1).cast("bigint")).alias("msg_group"),
        F.when(in_exec & follows, before.cast("bigint"))
        .when(grouped & (F.col("last_type") != "tx"), F.lit(0).cast("bigint"))
        .alias("msg_sub_group"),
        here.cast("bigint").alias("msg_index"),
        vstr("msg", "type").alias("msg_type"),
        "msg",
        "_inserted_timestamp",
        joined_key("-", "tx_id", "msg_index").alias("_unique_key"),
    )
    return run.audit(out.withColumn("msgs_2_id", surrogate_key("_unique_key")))


def msg_attributes_2(messages: DataFrame, run: Run) -> DataFrame:
    """One row per attribute of every event, decoded."""
    # keys and values come out of the event in one pass, as texts of their own
    flat = messages.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_group", "msg_sub_group", "msg_index", "msg_type",
        F.posexplode(F.try_variant_get("msg", "$.attributes", PAIRS)).alias("attribute_index", "attribute"), "_inserted_timestamp",
    )
    out = flat.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_group", "msg_sub_group", "msg_index", "msg_type",
        F.col("attribute_index").cast("bigint").alias("attribute_index"),
        decode_attr(F.col("attribute.key")).alias("attribute_key"),
        decode_attr(F.col("attribute.value")).alias("attribute_value"),
        "_inserted_timestamp",
        joined_key("-", "tx_id", "msg_index", "attribute_index").alias("_unique_key"),
    )
    return run.audit(out.withColumn("msg_attributes_2_id", surrogate_key("_unique_key")))


# ---------------------------------------------------------------- events of the transaction log


LOG_GRAIN = ["block_id", "block_timestamp", "tx_id", "tx_succeeded", "_ingested_at", "_inserted_timestamp"]


def _log_entries(events: str) -> Column:
    """(msg_index, events) of each entry of ``log``, which is JSON text; a broken log yields nothing.

    The text is put in brackets, for a parser that stops after the first value: then a rest is an error or a second
    element. All entries are read in one pass.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col("log"), F.lit("]")))
    values = F.try_variant_get(wrapped, "$", f"array<array<struct<msg_index:bigint,events:{events}>>>")
    whole = F.get(F.filter(F.array(values), lambda v: F.size(v) == 1), F.lit(0))
    # an array of its own: a generator over a bare column would get a filter that reads the log once more
    return F.inline(F.get(whole, F.lit(0)))


def _log_events(silver_transactions: DataFrame, silver_blocks: DataFrame) -> DataFrame:
    """Events of the log with group and sub-group.

    ``msg_index`` is the index of the log entry, so many events share it; the event's position in its entry makes
    the order total. The windows are per transaction, and all rows of a transaction come out of one input row.
    """
    logs = silver_transactions.select(*LOG_GRAIN, vstr("tx", "tx_result.log").alias("log"))
    entries = logs.select(*LOG_GRAIN, _log_entries("array<variant>"))
    flat = entries.select("*", F.posexplode("events").alias("event_index", "msg")).drop("events")
    first_key, first_value = vstr("msg", "attributes[0].key"), vstr("msg", "attributes[0].value")
    rows = flat.withColumns(
        {
            "msg_type": vstr("msg", "type"),
            "is_action": F.coalesce(first_key == "action", F.lit(False)),
            "is_module": F.coalesce(first_key == "module", F.lit(False)),
            "first_value": first_value,
        }
    )
    in_order = Window.partitionBy("tx_id").orderBy("msg_index", "event_index")
    actions = F.sum(F.col("is_action").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("msg_group", F.nullif(actions - 1, F.lit(-1).cast("bigint")))
    group = Window.partitionBy("tx_id", "msg_group")
    is_exec = (F.col("msg_type") == "message") & F.col("is_action") & F.lower("first_value").contains("exec")
    module = F.col("is_module") & (F.col("msg_type") == "message") & F.col("msg_group").isNotNull()
    rows = rows.withColumns(
        {"in_exec": F.max(F.coalesce(is_exec, F.lit(False))).over(group), "is_step": F.coalesce(module, F.lit(False))}
    )
    rows = rows.withColumn("is_step", F.col("is_step") & F.col("in_exec"))
    # Rank among the steps of a group; steps of one log entry tie.
    steps_before = F.sum(F.col("is_step").cast("int")).over(
        group.orderBy("msg_index").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.sum(F.col("is_step").cast("int")).over(Window.partitionBy("tx_id", "msg_group", "msg_index"))
    rows = rows.withColumn("step_rank", F.when(F.col("is_step"), steps_before))
    # Every event meets the steps of its log entry, so an entry with k steps repeats its events k times.
    same_entry = Window.partitionBy("tx_id", "msg_index").orderBy("event_index").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = rows.withColumn("steps", F.collect_list("step_rank").over(same_entry))
    fanned = rows.withColumn("step", F.explode_outer(F.when(F.size("steps") > 0, F.col("steps"))))
    backward = (
        Window.partitionBy("tx_id", "msg_group")
        .orderBy(F.desc("msg_index"), F.desc("event_index"), F.desc("step"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    sub_group = F.coalesce(F.last("step", ignorenulls=True).over(backward), F.lit(0).cast("bigint"))
    named = fanned.withColumn(
        "msg_group", F.when(F.col("msg_group").isNotNull(), joined_key(":", "msg_group", sub_group))
    )
    chain = silver_blocks.select("block_id", "chain_id")
    return named.withColumn("blockchain", F.lit("terra")).join(chain, "block_id")


def msgs(silver_transactions: DataFrame, silver_blocks: DataFrame, run: Run) -> DataFrame:
    """silver.msgs: events of the log, with a running number per transaction in the id."""
    number = F.row_number().over(Window.partitionBy("tx_id").orderBy("msg_index", "event_index", "step"))
    rows = _log_events(silver_transactions, silver_blocks).withColumn("unique_number", number)
    out = rows.select(
        joined_key("-", "tx_id", "msg_index", "unique_number").alias("message_id"),
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "tx_succeeded", "msg_group", "msg_index",
        "msg_type", "msg", "_ingested_at", "_inserted_timestamp",
    )
    return run.audit(out.withColumn("msgs_id", surrogate_key("message_id")))


def msg_attributes(silver_transactions: DataFrame, silver_blocks: DataFrame, run: Run) -> DataFrame:
    """silver.msg_attributes: attributes of the log's events."""
    events = _log_events(silver_transactions, silver_blocks).withColumn("attributes", vvar("msg", "attributes"))
    flat = flatten_array(events, F.col("attributes"), "attribute", "attribute_index")
    order = Window.partitionBy("tx_id").orderBy("msg_index", "event_index", "step", "attribute_index")
    out = flat.withColumn("unique_number", F.row_number().over(order)).select(
        joined_key("-", "tx_id", "msg_index", "attribute_index", "unique_number").alias("message_id"),
        "block_id", "block_timestamp", "blockchain", "chain_id", "tx_id", "tx_succeeded", "msg_group", "msg_index",
        "msg_type", F.col("attribute_index").cast("bigint").alias("attribute_index"),
        vstr("attribute", "key").alias("attribute_key"), vstr("attribute", "value").alias("attribute_value"),
        "_ingested_at", "_inserted_timestamp",
    )
    return run.audit(out.withColumn("msg_attributes_id", surrogate_key("message_id")))


def _event_fields(event: Column) -> Column:
    """(type, values, currencies) of one event: repeated keys get a running suffix, amounts lose their currency."""
    return let(
        let(F.coalesce(event["attributes"], F.array().cast("array<struct<key:string,value:string>>")), _numbered_fields),
        lambda fields: F.struct(
            event["type"].alias("type"),
            _entries(
                F.filter(fields, lambda p: p["key"].isNotNull()),
                lambda p: F.concat(p["key"], p["suffix"]),
                lambda p: F.when(p["key"] == "amount", F.regexp_substr(p["value"], F.lit("[0-9]+"))).otherwise(p["value"]),
            ).alias("values"),
            _entries(
                F.filter(fields, lambda p: p["key"] == "amount"),
                lambda p: F.concat(F.lit("currency"), p["suffix"]),
                lambda p: F.regexp_substr(p["value"], F.lit("[^0-9](.*)")),
            ).alias("currencies"),
        ),
    )


def _numbered_fields(pairs: Column) -> Column:
    """(key, value, suffix): the occurrences of a repeated key are numbered from ``_0``, other keys have no suffix."""
    keys = F.transform(pairs, lambda p: p["key"])
    plain = F.transform(pairs, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"), F.lit("").alias("suffix")))
    order = F.sort_array(F.transform(pairs, lambda p, n: F.struct(p["key"].alias("key"), n.alias("n"))))

    def suffixes(run: Column) -> Column:
        number = lambda r: F.concat(F.lit("_"), r.cast("string"))
        return F.transform(
            run,
            lambda o, r: F.struct(o["n"].alias("n"), F.when(F.size(run) > 1, number(r)).otherwise("").alias("suffix")),
        )

    def numbered(by_place: Column) -> Column:
        return F.transform(
            pairs,
            lambda p, i: F.struct(
                p["key"].alias("key"), p["value"].alias("value"), F.get(by_place, i)["suffix"].alias("suffix")
            ),
        )

    repeated = let(F.sort_array(F.flatten(F.transform(runs(order, lambda o: o["key"]), suffixes))), numbered)
    return F.when(F.size(F.array_distinct(keys)) == F.size(pairs), plain).otherwise(repeated)


def _entries(fields: Column, key, value) -> Column:
    """Map entries without null values."""
    made = F.transform(fields, lambda p: F.struct(key(p).alias("k"), value(p).alias("v")))
    return F.filter(made, lambda e: e["v"].isNotNull())


def _shared_fields(fields: Column) -> Column:
    """``type.field`` of fields that a type sets more than once: by two of its events, or by a name like a numbered one."""

    def named(part: str) -> Column:
        return F.flatten(F.transform(fields, lambda e: F.transform(e[part], lambda p: F.concat_ws(".", e["type"], p["k"]))))

    def twice(names: Column) -> Column:
        def repeated(names: Column) -> Column:
            same = F.transform(names, lambda n, i: F.when((i > 0) & (n == F.get(names, i - 1)), n))
            return F.array_distinct(F.filter(same, lambda n: n.isNotNull()))

        none = F.size(F.array_distinct(names)) == F.size(names)
        return F.when(none, F.array().cast("array<string>")).otherwise(let(F.sort_array(names), repeated))

    return F.array_union(let(named("values"), twice), let(named("currencies"), twice))


def _fields_by_type(events: Column) -> Column:
    """(attributes, shared): type -> field -> value. Events of one type share an object; where two of them set one field,
    there is no object, and ``shared`` names the fields."""

    def merged(kept: Column) -> Column:
        gather = lambda part: F.map_from_entries(F.flatten(F.transform(kept, lambda e: e[part])))
        return let(gather("currencies"), lambda right: object_merge(gather("values"), right))

    def by_type(fields: Column) -> Column:
        types = F.array_distinct(F.transform(fields, lambda e: e["type"]))
        return F.map_from_entries(
            F.transform(types, lambda t: F.struct(t, let(F.filter(fields, lambda e: e["type"] == t), merged)))
        )

    def checked(fields: Column) -> Column:
        return let(
            _shared_fields(fields),
            lambda shared: F.struct(F.when(F.size(shared) == 0, by_type(fields)).alias("attributes"), shared.alias("shared")),
        )

    return let(F.filter(F.transform(events, _event_fields), lambda e: e["type"].isNotNull()), checked)


def checked_messages(silver_transactions: DataFrame, silver_blocks: DataFrame, run: Run) -> DataFrame:
    """All rows of silver.messages with ``shared_fields``. Where it is not empty the message has no single nested object;
    such rows belong in quarantine (``quality.quarantined`` writes both sides in one pass).

    A log entry holds all events of its message, so the nested object is built inside the row.
    ``message_type`` always reads the first message, ``message_value`` the message of the entry.
    """
    logs = silver_transactions.select(*LOG_GRAIN, varray("tx", "body.messages").alias("all_messages"), vstr("tx", "tx_result.log").alias("log"))
    entries = logs.select(*LOG_GRAIN, "all_messages", _log_entries(EVENTS)).where(F.size("events") > 0).withColumn("message_index", F.coalesce("msg_index", F.lit(0).cast("bigint")))
    rows = entries.select(
        joined_key("-", "tx_id", "message_index").alias("message_id"),
        "block_timestamp", "block_id", "tx_id", "tx_succeeded", "message_index",
        vstr(F.get("all_messages", F.lit(0)), "@type").alias("message_type"),
        F.try_element_at("all_messages", (F.col("message_index") + 1).cast("int")).alias("message_value"),
        _fields_by_type(F.col("events")).alias("fields"),
        "_ingested_at", "_inserted_timestamp",
    )
    joined = rows.join(silver_blocks.select("block_id", "chain_id"), "block_id")
    out = joined.select(
        "message_id", "block_timestamp", "block_id", "tx_id", "tx_succeeded", "chain_id", "message_index",
        "message_type", "message_value", F.col("fields.attributes").alias("attributes"), "_ingested_at", "_inserted_timestamp",
        surrogate_key("message_id").alias("messages_id"), F.col("fields.shared").alias("shared_fields"),
    )
    return run.audit(out)


def messages(silver_transactions: DataFrame, silver_blocks: DataFrame, run: Run) -> DataFrame:
    """silver.messages: one row per message with ``attributes`` = event type -> field -> value, without odd ones."""
    rows = checked_messages(silver_transactions, silver_blocks, run)
    return rows.where(F.size("shared_fields") == 0).drop("shared_fields")


# ---------------------------------------------------------------- transfers

EVENT_GRAIN = [
    "block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_group", "msg_sub_group", "msg_index",
    "_inserted_timestamp",
]


def _wanted_pairs(wanted: Sequence[str]) -> Column:
    """Keys and values are read in one pass; only values of wanted keys are decoded."""
    read = F.try_variant_get("msg", "$.attributes", PAIRS)
    named = F.filter(F.transform(read, lambda a: F.struct(decode_attr(a["key"]).alias("k"), a["value"].alias("v"))), lambda p: p["k"].isin(*wanted))
    return F.filter(F.transform(named, lambda p: F.struct(p["k"].alias("k"), decode_attr(p["v"]).alias("v"))), lambda p: p["v"].isNotNull())


def event_fields(messages: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Events of silver.msgs_2 that set any of ``wanted``, with a column for each; read inside the row, no shuffle.

    An event that repeats a key gives its first value, so that first values stand beside each other; such events are
    listed by ``repeated_fields``.
    """
    first = lambda pairs, name: F.get(F.filter(pairs, lambda p: p["k"] == name), F.lit(0))["v"]
    found = F.filter(F.array(_wanted_pairs(wanted)), lambda pairs: F.size(pairs) > 0)
    # a generator is a boundary that later filters do not cross, so an event's attributes are decoded once
    return messages.select("*", F.inline(F.transform(found, lambda p: F.struct(*[first(p, n).alias(n) for n in wanted]))))


def repeated_fields(messages: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(tx_id, msg_index, msg_type, attribute_key) of events that set a wanted key more than once: a data check."""
    keys = F.transform(_wanted_pairs(wanted), lambda p: p["k"])
    rows = messages.select("tx_id", "msg_index", "msg_type", keys.alias("_keys"))
    often = F.filter(F.array_distinct("_keys"), lambda k: F.size(F.filter("_keys", lambda x: x == k)) > 1)
    return rows.select("tx_id", "msg_index", "msg_type", F.explode(often).alias("attribute_key"))


def fee_payer(messages: DataFrame, out: str) -> DataFrame:
    """tx_id -> address of the first account sequence (``address/number``)."""
    address = F.split_part("acc_seq", F.lit("/"), F.lit(1))
    return first_value_by(event_fields(messages, ["acc_seq"]), ["tx_id"], address, F.col("msg_index"), out)


def transfers(messages: DataFrame, run: Run) -> DataFrame:
    """silver.transfers from silver.msgs_2: native transfers; amounts without a digit are dropped."""
    events = event_fields(messages.where(F.col("msg_type") == "transfer"), ["sender", "recipient", "amount"])
    payers = fee_payer(messages.where(F.col("msg_type") == "tx"), "payer")
    out = events.join(payers, "tx_id").select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded",
        F.lit("TERRA").alias("transfer_type"),
        "msg_index",
        F.coalesce("sender", "payer").alias("sender"),
        F.col("recipient").alias("receiver"),
        coin_amount(F.col("amount")).alias("amount"),
        coin_denom(F.col("amount")).alias("currency"),
        "_inserted_timestamp",
        surrogate_key("tx_id", "msg_index").alias("transfers_id"),
    )
    return run.audit(out.where(F.col("amount").isNotNull()))


PACKET_KEYS = ["packet_sequence", "packet_src_channel", "packet_dst_channel"]


def transfers_ibc_packets(messages: DataFrame, run: Run) -> DataFrame:
    """silver.transfers_ibc_packets from silver.msgs_2: send, acknowledge and timeout packets."""
    wanted = messages.where(F.col("msg_type").isin("send_packet", "acknowledge_packet", "timeout_packet"))
    packets = event_fields(wanted, PACKET_KEYS)
    out = packets.select(
        *EVENT_GRAIN[:-1], "msg_type", *PACKET_KEYS, "_inserted_timestamp",
        surrogate_key("tx_id", "msg_index").alias("transfers_ibc_packets_id"),
    )
    return run.audit(out)


def transfers_ibc(messages: DataFrame, packets: DataFrame, run: Run) -> DataFrame:
    """silver.transfers_ibc from silver.msgs_2: transfers that left (and were acknowledged) or arrived through a channel.

    Out: the n-th ``transfer`` of a group belongs to its n-th ``ibc_transfer``. In: matched by group, sub-group and
    receiver. Groups lie inside one transaction.
    """
    nth = Window.partitionBy("tx_id", "msg_group").orderBy("msg_index", "msg_sub_group")
    moved = messages.where((F.col("msg_type") == "transfer") & F.col("msg_group").isNotNull())
    events = event_fields(moved.select(*EVENT_GRAIN, "msg"), ["sender", "recipient", "amount"]).drop("msg").withColumn(
        "t_rank", F.row_number().over(nth)
    )
    acknowledged = packets.where(F.col("msg_type") == "acknowledge_packet")
    sent = semi(packets.where(F.col("msg_type") == "send_packet"), acknowledged, *PACKET_KEYS)
    sending = event_fields(messages.where(F.col("msg_type") == "ibc_transfer"), ["sender", "receiver"])
    grain = ["tx_id", "msg_group", "msg_sub_group", "msg_index"]
    out_side = (
        semi(sending.select(*grain, "sender", "receiver"), sent, "tx_id", "msg_group")
        .withColumn("t_rank", F.row_number().over(nth))
        .select(
            "tx_id", "msg_group", "sender", "t_rank",
            F.col("receiver").alias("out_receiver"), F.lit(True).alias("is_out"),
        )
    )
    arriving = messages.where(F.col("msg_type") == "write_acknowledgement")
    packet = safe_json("packet_data")
    in_side = (
        event_fields(arriving, ["packet_data"])
        .withColumn("packet", packet)
        .select(
            "tx_id", "msg_group", "msg_sub_group",
            vstr("packet", "receiver").alias("recipient"),
            vstr("packet", "sender").alias("in_sender"),
            F.lit(True).alias("is_in"),
        )
    )
    payers = fee_payer(messages.where(F.col("msg_type") == "tx"), "payer")
    joined = (
        events.join(out_side, ["tx_id", "msg_group", "sender", "t_rank"], "left")
        .join(in_side, ["tx_id", "msg_group", "msg_sub_group", "recipient"], "left")
        .join(payers, "tx_id")
        .where(F.col("is_out") | F.col("is_in"))
    )
    out = joined.where(F.col("amount").isNotNull()).select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded",
        F.when(F.col("out_receiver").isNotNull(), "IBC_TRANSFER_OUT")
        .when(F.col("in_sender").isNotNull(), "IBC_TRANSFER_IN")
        .alias("transfer_type"),
        "msg_index",
        F.coalesce("in_sender", "sender", "payer").alias("sender"),
        F.coalesce("out_receiver", "recipient").alias("receiver"),
        coin_amount(F.col("amount")).alias("amount"),
        coin_denom(F.col("amount")).alias("currency"),
        "_inserted_timestamp",
        surrogate_key("tx_id", "msg_index").alias("transfers_ibc_id"),
    )
    return run.audit(out)


# ---------------------------------------------------------------- staking

STAKING_EVENTS = ["delegate", "redelegate", "unbond", "create_validator"]


def staking(messages: DataFrame, run: Run) -> DataFrame:
    """silver.staking from silver.msgs_2: delegations, redelegations and undelegations, one row per coin currency.

    The delegator is the sender named by the event or by the event right after it, anywhere in the same group.
    """
    acted = messages.where(F.col("msg_type").isin(STAKING_EVENTS) & (F.array_size(varray("msg", "attributes")) > 0))
    base = acted.select(*EVENT_GRAIN, "msg_type")
    near = with_next(base.select("tx_id", "msg_index"), "msg_index")
    named = event_fields(
        messages.where(F.col("msg_type").isin(*STAKING_EVENTS, "message")),
        ["validator", "destination_validator", "source_validator", "sender", "amount", "completion_time"],
    )
    fields = semi(named.drop("msg"), near, "tx_id", "msg_index")
    senders = fields.where(F.col("sender").isNotNull()).select("tx_id", "msg_group", F.col("sender").alias("delegator_address"))
    has_validator = (
        F.col("validator").isNotNull() | F.col("destination_validator").isNotNull() | F.col("source_validator").isNotNull()
    )
    details = fields.where(has_validator & F.col("amount").isNotNull()).select(
        "tx_id", "msg_group", "msg_index",
        F.coalesce("validator", "destination_validator").alias("validator_address"),
        F.col("source_validator").alias("validator_src_address"),
        F.col("amount").alias("coins"),
        F.col("completion_time").try_cast("timestamp_ntz").alias("completion_time"),
    )
    renamed = F.replace(F.replace("msg_type", F.lit("unbond"), F.lit("undelegate")), F.lit("create_validator"), F.lit("delegate"))
    actions = base.withColumn("action", renamed).drop("msg_type")
    joined = actions.join(senders, ["tx_id", "msg_group"]).join(details, ["tx_id", "msg_group", "msg_index"])
    amount, currency = denom_cut(F.col("coin"))
    coins = split_rows(joined, F.col("coins"), ",", "coin", "coin_index").withColumns(
        {"coin_amount": amount, "currency": currency}
    )
    callers = fee_payer(semi(messages.select("tx_id", "msg_index", "msg"), base, "tx_id"), "tx_caller_address")
    summed = (
        coins.join(callers, "tx_id")
        .groupBy(
            "block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_caller_address", "action", "msg_group",
            "msg_sub_group", "delegator_address", "currency", "validator_address", "validator_src_address",
            "completion_time", "_inserted_timestamp",
        )
        .agg(F.sum("coin_amount").alias("amount"))
    )
    out = summed.select(
        joined_key(
            "-", "tx_id", "msg_group", F.coalesce("msg_sub_group", F.lit(-1).cast("bigint")), "action", "currency",
            "delegator_address", "validator_address",
        ).alias("staking_id"),
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_caller_address", "action", "msg_group",
        "msg_sub_group", "delegator_address", "amount", "currency", "validator_address", "validator_src_address",
        "completion_time", "_inserted_timestamp",
    )
    return run.audit(out.withColumn("stakings_id", surrogate_key("staking_id")))


# ---------------------------------------------------------------- other tables


def address_labels(combined: DataFrame, run: Run, blockchain: str = "terra") -> DataFrame:
    """silver.address_labels: labels of one chain; soft-deleted rows are removed after the upsert or here."""
    own = combined.where((F.col("blockchain") == blockchain) & ~F.coalesce(F.col("_is_deleted"), F.lit(False)))
    out = own.select(
        "system_created_at", "insert_date", "blockchain", "address", "creator", "label_type", "label_subtype",
        "address_name", "project_name", "_is_deleted", "labels_combined_id",
    )
    return run.audit(out)


def hourly_prices(prices: DataFrame, run: Run, asset: str = "terra-luna-2") -> DataFrame:
    """silver.hourly_prices_coin_gecko: hourly OHLC of one asset."""
    own = prices.where(F.col("id") == asset)
    out = own.select(
        "id", "recorded_hour", "open", "high", "low", "close", "_inserted_timestamp", "hourly_prices_coin_gecko_id"
    )
    return run.audit(out)


def blockchain(answers: DataFrame, run: Run) -> DataFrame:
    """silver.blockchain: block metadata from header-range responses, latest per height."""
    latest = latest_by(block_metas(answers), ["block_id"], _newest())
    return run.audit(latest.withColumn("blockchain_id", surrogate_key(F.to_json("block_id_object"))))


def dex_swaps(silver_messages: DataFrame, silver_transactions: DataFrame) -> DataFrame:
    """silver.dex_swaps: swaps of contract messages; repeated fields pair up through the suffix of their keys.

    ``attributes`` is event type -> field -> value. The fields of a message lie in one row, so its offers meet its
    swap actions inside the row.
    """
    executes = F.lower("message_type").contains("msgexecutecontract")
    swapping = vvar("message_value", "msg.swap").isNotNull() | vvar(
        "message_value", "msg.execute_swap_operations"
    ).isNotNull()
    swaps = silver_messages.where(executes & swapping).withColumn("info", F.col("attributes")["wasm"])

    def suffixes(keys: Column, stem: str) -> Column:
        return F.transform(keys, lambda k: F.substring(k, F.lit(len(stem) + 1), F.length(k)))

    offers = F.filter(F.map_keys("info"), lambda k: F.lower(k).contains("offer_amount"))
    actions = F.map_keys(F.map_filter("info", lambda k, v: F.lower(k).contains("action") & (v == "swap")))
    rows = swaps.withColumn("offer", F.explode(suffixes(offers, "offer_amount"))).withColumn(
        "act", F.explode_outer(suffixes(actions, "action"))
    )

    def field(stem: str, suffix: str = "offer") -> Column:
        exact = F.try_element_at("info", F.concat(F.lit(stem), F.col(suffix)))
        return F.coalesce(exact, F.when(F.col(suffix).isNotNull(), F.try_element_at("info", F.lit(stem))))

    parts = rows.select(
        "block_id", "block_timestamp", "_inserted_timestamp",
        F.lit("Terra").alias("blockchain"),
        "chain_id", "tx_id", F.col("message_index").alias("msg_index"), "tx_succeeded",
        field("offer_amount").try_cast("decimal(38,0)").alias("from_amount"),
        field("offer_asset").alias("from_currency"),
        F.lit(6).alias("from_decimal"),
        field("return_amount").try_cast("decimal(38,0)").alias("to_amount"),
        field("ask_asset").alias("to_currency"),
        F.lit(6).alias("to_decimal"),
        field("_contract_address", "act").alias("pool_id"),
    )
    traders = silver_transactions.select("tx_id", F.col("tx_sender").alias("trader"))
    joined = parts.join(sorted_side(traders), "tx_id").withColumn("swap_id", joined_key("-", "tx_id", "msg_index", "pool_id"))
    order = [F.desc("block_timestamp"), F.asc("from_currency"), F.asc("from_amount"), F.asc("to_amount")]
    return latest_by(joined, ["swap_id"], order).select(
        "swap_id", "block_id", "block_timestamp", "_inserted_timestamp", "blockchain", "chain_id", "tx_id",
        "tx_succeeded", "trader", "from_amount", "from_currency", "from_decimal", "to_amount", "to_currency",
        "to_decimal", "pool_id",
    )
