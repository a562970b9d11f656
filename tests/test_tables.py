"""Upserts: idempotence, batch splits, input order, key moves, errors."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.incremental import KeyedTable
from ledgerlake.incremental.table import date_part, hash_part
from ledgerlake.operators.dedupe import latest_by
from ledgerlake.plans import chain_silver
from ledgerlake.run import Run
from ledgerlake.session import _own_root, new_folder, shared_root
from workload.chainlike import RUN, Chain

SCHEMA = "k bigint, d date, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *data):
    return spark.createDataFrame([(k, date(2024, 1, d), v) for k, d, v in data], SCHEMA)


def new_table(spark, part=None):
    return KeyedTable(spark, new_folder(spark, "t"), ["k"], part if part is not None else date_part("d"))


def test_shared_root_is_the_named_folder(spark):
    assert shared_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_cluster_without_shared_folder_is_an_error():
    for master in ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"]:
        with pytest.raises(RuntimeError):
            _own_root(master)


def test_upsert_is_idempotent_and_keeps_other_partitions(spark):
    table = new_table(spark)
    table.merge(frame(spark, (1, 1, "a"), (2, 1, "b"), (3, 2, "c")))
    for _ in range(2):
        table.merge(frame(spark, (2, 1, "B"), (4, 3, "d")))
    assert rows(table.read()) == rows(frame(spark, (1, 1, "a"), (2, 1, "B"), (3, 2, "c"), (4, 3, "d")))


def test_key_that_changes_partition_leaves_no_copy(spark):
    table = new_table(spark)
    table.merge(frame(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c")))
    table.merge(frame(spark, (1, 5, "A"), (2, 5, "B")))
    assert rows(table.read()) == rows(frame(spark, (1, 5, "A"), (2, 5, "B"), (3, 2, "c")))


def test_null_keys_match_nothing(spark):
    table = new_table(spark)
    table.merge(frame(spark, (None, 1, "a"), (None, 1, "b"), (1, 1, "c")))
    table.merge(frame(spark, (None, 1, "d"), (1, 1, "C")))
    assert sorted(r["v"] for r in table.read().collect()) == ["C", "a", "b", "d"]
    table.delete_insert(frame(spark, (None, 1, "e"), (1, 1, "D")))
    assert sorted(r["v"] for r in table.read().collect()) == ["D", "a", "b", "d", "e"]


def test_a_kept_null_stays(spark):
    table = new_table(spark)
    table.merge(frame(spark, (1, 1, None), (2, 1, "b")))
    table.merge(frame(spark, (1, 2, "new"), (2, 2, "new"), (3, 2, "new")), keep=["v"])
    assert {r["k"]: r["v"] for r in table.read().collect()} == {1: None, 2: "b", 3: "new"}


def test_a_run_after_a_failure_repairs(spark, monkeypatch):
    table, batch = new_table(spark), frame(spark, (1, 5, "A"), (2, 5, "B"))
    table.merge(frame(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c")))
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_remove", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(batch)
    table.merge(batch)
    assert rows(table.read()) == rows(frame(spark, (1, 5, "A"), (2, 5, "B"), (3, 2, "c")))


def test_fixed_partitions_read_only_those_of_the_batch(spark, monkeypatch):
    table = KeyedTable(spark, new_folder(spark, "t"), ["k"], hash_part(4, "k"), moves=False)
    table.merge(frame(spark, *[(k, 1, "a") for k in range(20)]))
    table.merge(frame(spark, (3, 9, "b"), (50, 1, "c")))
    assert rows(table.read()) == rows(frame(spark, *[(k, 1, "a") for k in range(20) if k != 3], (3, 9, "b"), (50, 1, "c")))


def test_merge_refuses_duplicates_but_delete_insert_keeps_them(spark):
    twice = [(1, 1, "a"), (1, 1, "b")]
    with pytest.raises(ValueError):
        new_table(spark).merge(frame(spark, *twice))
    table = new_table(spark)
    table.delete_insert(frame(spark, *twice))
    assert rows(table.read()) == rows(frame(spark, *twice))


def test_kept_columns_and_new_columns(spark):
    table = new_table(spark, hash_part(3, "k"))
    table.merge(frame(spark, (1, 1, "a")).withColumn("first", F.lit("one")), ["first"])
    table.merge(frame(spark, (1, 1, "A"), (2, 1, "b")).withColumns({"first": F.lit("two"), "more": F.lit(1)}), ["first"])
    got = sorted((r["k"], r["v"], r["first"], r["more"]) for r in table.read().collect())
    assert got == [(1, "A", "one", 1), (2, "b", "two", 1)]


def test_null_partition_and_null_key(spark):
    """A null key matches no stored row, as in SQL's MERGE, so both rows without a key stay."""
    table = new_table(spark)
    data = spark.createDataFrame([(None, None, "a"), (1, None, "b")], SCHEMA)
    table.merge(data)
    table.merge(spark.createDataFrame([(None, None, "A")], SCHEMA))
    assert sorted((r["k"] is None, r["v"]) for r in table.read().collect()) == [(False, "b"), (True, "A"), (True, "a")]


def test_delete_where_empties_a_partition(spark):
    table = new_table(spark)
    table.merge(frame(spark, (1, 1, "x"), (2, 2, "x"), (3, 2, "y")))
    table.delete_where(F.col("v") == "x")
    assert rows(table.read()) == rows(frame(spark, (3, 2, "y")))


def test_any_split_into_batches_gives_the_same_state(spark):
    rng = random.Random(5)
    data = [(rng.randrange(20), i, f"v{i}") for i in range(60)]
    source = spark.createDataFrame(data, "k bigint, seq bigint, v string")
    want = {k: v for k, _, v in sorted(data, key=lambda r: r[1])}
    for cuts in ([60], [20, 60], [10, 11, 35, 60]):
        table, low = KeyedTable(spark, new_folder(spark, "s"), ["k"], hash_part(4, "k")), 0
        for high in cuts:
            batch = source.where(F.col("seq").between(low, high - 1)).orderBy(F.rand(cuts[0]))
            table.merge(latest_by(batch, ["k"], [F.desc("seq")]))
            low = high
        assert {r["k"]: r["v"] for r in table.read().collect()} == want


def test_incremental_silver_equals_full_rebuild(spark):
    """silver.msgs_2 built in two runs over a growing transaction table equals one run over all of it."""
    transactions = Chain(spark, "/root/testdata/sf0.001").transactions
    full = chain_silver.msgs_2(transactions, RUN).drop("inserted_timestamp", "modified_timestamp", "_invocation_id")
    table = KeyedTable(spark, new_folder(spark, "msgs"), ["_unique_key"], F.date_trunc("year", "block_timestamp").cast("date"))
    cut = datetime(1998, 1, 1)
    early, late = Run(datetime(2011, 1, 1)), Run(datetime(2012, 1, 1))
    table.merge(chain_silver.msgs_2(transactions.where(F.col("block_timestamp") < F.lit(cut)), early), ["inserted_timestamp"])
    again = transactions.where(F.col("block_timestamp") >= F.lit(datetime(1997, 6, 1)))
    table.merge(chain_silver.msgs_2(again, late), ["inserted_timestamp"])
    columns = [c for c in full.columns if c != "msg"]
    got = table.read()
    assert got.select(columns).exceptAll(full.select(columns)).isEmpty()
    assert full.select(columns).exceptAll(got.select(columns)).isEmpty()
    first = got.where(F.col("block_timestamp") < F.lit(cut)).agg(F.max("inserted_timestamp")).first()[0]
    assert first == datetime(2011, 1, 1)
