"""Chunked operators against plain windows, with a hot key, null keys and single-row keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import ordered
from ledgerlake.operators.gaps import fill_gaps, sequence_gaps


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = rng.choice(["hot"] * 6 + [None, "a", "b", f"k{i}"])
        data.append((i, key, rng.randrange(500), rng.choice([None, None, rng.randrange(99)]), rng.random() < 0.2))
    return spark.createDataFrame(data, "id bigint, k string, t bigint, v int, flag boolean").cache()


ORDER = ["t", "id"]


def chunk():
    return ordered.id_chunk(F.col("t"), 37)


def same(a, b, columns):
    key = lambda r: tuple((x is None, x) for x in r)
    left = sorted([tuple(r) for r in a.select("id", *columns).collect()], key=key)
    right = sorted([tuple(r) for r in b.select("id", *columns).collect()], key=key)
    assert left == right


def window():
    return Window.partitionBy("k").orderBy(*ORDER)


def test_running_count(rows):
    got = ordered.running_count(rows, ["k"], ORDER, chunk(), F.col("flag"), "n")
    want = rows.withColumn("n", F.sum(F.col("flag").cast("int")).over(window().rowsBetween(Window.unboundedPreceding, 0)))
    same(got, want, ["n"])


def test_event_groups_start_at_null(rows):
    got = ordered.event_groups(rows, ["k"], ORDER, chunk(), F.col("flag"), "g").where("k = 'hot'").orderBy(*ORDER).collect()
    expected, group = [], None
    for row in got:
        if row["flag"]:
            group = 0 if group is None else group + 1
        expected.append(group)
    assert [r["g"] for r in got] == expected


def test_carry_forward_and_backward(rows):
    w = window()
    got = ordered.carry_forward(rows, ["k"], ORDER, chunk(), F.col("v"), "f")
    want = rows.withColumn("f", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same(got, want, ["f"])
    got = ordered.carry_backward(rows, ["k"], ORDER, chunk(), F.col("v"), "b")
    want = rows.withColumn("b", F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    same(got, want, ["b"])


def test_lag_numbers_and_ranks(rows):
    same(ordered.previous_value(rows, ["k"], ORDER, chunk(), F.col("v"), "p"), rows.withColumn("p", F.lag("v").over(window())), ["p"])
    same(ordered.row_numbers(rows, ["k"], ORDER, chunk(), "n"), rows.withColumn("n", F.row_number().over(window())), ["n"])
    plain = rows.withColumn("d", F.dense_rank().over(Window.partitionBy("k").orderBy("t")))
    same(ordered.dense_ranks(rows, ["k"], "t", chunk(), "d"), plain, ["d"])


def test_global_order_and_tiles(rows):
    plain = rows.withColumn("n", F.row_number().over(Window.orderBy(*ORDER)))
    same(ordered.row_numbers(rows, [], ORDER, chunk(), "n"), plain, ["n"])
    for tiles in (1, 7, 10, 2000):
        plain = rows.withColumn("g", F.ntile(tiles).over(Window.orderBy(*ORDER)))
        same(ordered.ntiles(rows, ORDER, chunk(), tiles, "g"), plain, ["g"])


def test_gaps_of_any_length(spark):
    ids = spark.createDataFrame([(1,), (2,), (5,), (25_010,), (25_011,)], "id bigint")
    gaps = sequence_gaps(ids, "id", width=3)
    assert sorted((r["prev_id"], r["id"], r["gap"]) for r in gaps.collect()) == [(2, 5, 2), (5, 25_010, 25_004)]
    filled = [r[0] for r in fill_gaps(gaps, "prev_id", "id", "x").select("x").collect()]
    assert sorted(filled) == [3, 4, *range(6, 25_010)]


@pytest.mark.parametrize("width", [1, 37])
def test_global_orders_in_two_levels(spark, rows, width):
    """Without keys, over chunks that fill several blocks and a null order value."""
    wide = rows.selectExpr("id", "if(id = 5, null, t * 40000) as t", "v", "flag")
    w = Window.orderBy(*ORDER)
    at = ordered.id_chunk(F.col("t"), width)
    got = ordered.row_numbers(wide, [], ORDER, at, "n")
    got = ordered.running_count(got, [], ORDER, at, F.col("flag"), "c")
    got = ordered.carry_forward(got, [], ORDER, at, F.col("v"), "f")
    got = ordered.carry_backward(got, [], ORDER, at, F.col("v"), "b")
    got = ordered.previous_value(got, [], ORDER, at, F.col("v"), "p")
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    want = wide.withColumns({
        "n": F.row_number().over(w), "c": F.sum(F.col("flag").cast("int")).over(before), "f": F.last("v", True).over(before),
        "b": F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)), "p": F.lag("v").over(w),
    })
    same(got, want, ["n", "c", "f", "b", "p"])


@pytest.mark.parametrize("keys", [["k"], []])
def test_steps_share_one_scan(rows, keys):
    steps = {
        "c": ordered.count_of(F.col("flag")), "n": ordered.number(), "f": ordered.last_of(F.col("v")),
        "b": ordered.next_of(F.col("v")), "v": ordered.before(F.col("v")),
    }
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    upto, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    got = ordered.scan_steps(rows, keys, ORDER, chunk(), steps)
    want = rows.withColumns({
        "c": F.sum(F.col("flag").cast("int")).over(upto), "n": F.row_number().over(w), "f": F.last("v", True).over(upto),
        "b": F.first("v", True).over(after), "p": F.lag("v").over(w),
    }).drop("v").withColumnRenamed("p", "v")
    same(got, want, ["c", "n", "f", "b", "v"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == (1 if keys else 2)


def test_a_hot_hour_is_cut_by_density(spark):
    """An hour with 5,000 of 5,200 rows: no slot of it holds much more than the rows asked for."""
    calm = spark.range(200).selectExpr("id", "timestamp_seconds(id * 7200) as ts")
    hot = spark.range(5000).selectExpr("id + 200 as id", "timestamp_micros(7200000000 + id * 500000) as ts")
    rows = calm.union(hot)
    hour = ordered.time_chunk(F.col("ts"))
    cuts = ordered.density_cuts(rows, "ts", hour, 300)
    at = ordered.density_chunk(F.col("ts"), hour, cuts)
    sizes = [r["count"] for r in rows.groupBy(at.alias("at")).count().collect()]
    assert len(cuts) >= 16 and max(sizes) <= 400 and len(sizes) < 250
    w = Window.orderBy("ts", "id")
    same(ordered.row_numbers(rows, [], ["ts", "id"], at, "n"), rows.withColumn("n", F.row_number().over(w)), ["n"])
    assert ordered.density_cuts(rows, "ts", hour, 10_000) == []
    assert ordered.density_cuts(rows.limit(0), "ts", hour, 10) == []


def test_sub_groups_need_six_exchanges(spark, monkeypatch):
    """Four for the scan, which is written once, and two for the groups' totals."""
    from workload import event_ops

    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    seen = []
    settle = event_ops.settle
    monkeypatch.setattr(event_ops, "settle", lambda df, label: (seen.append(exchanges(df)), settle(df, label))[1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen.append(exchanges(event_ops.sub_group_backfill(spark, "/root/testdata/sf0.001")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sum(seen) <= 6
