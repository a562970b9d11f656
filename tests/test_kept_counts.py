"""Distinct counts that are kept by hour, and hours that a stream publishes and a repair mends."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.incremental.distinct import Dictionary, HourlyDistinct
from ledgerlake.session import new_folder
from ledgerlake.streaming import ClosedHours

START = datetime(2024, 1, 1)
SEEN = "at timestamp_ntz, who string, n bigint"


def _rows(spark, *rows):
    return spark.createDataFrame([(None if h is None else START + timedelta(hours=h), w, n) for h, w, n in rows], SEEN)


def test_counts_merge_in_any_order_and_again(spark):
    kept = HourlyDistinct(spark, new_folder(spark, "distinct"), "at", ["who", "n"], buckets=3)
    assert kept.counts() is None
    first = _rows(spark, (30, "a", 1), (30, "b", 40_000), (31, None, None), (None, "z", 9))
    second = _rows(spark, (2, "a", -7), (30, "a", 1), (30, "c", 2), (30.5, "", 1 << 50), (2.2, "a", 0))
    for batch in (first, second, first, _rows(spark)):
        kept.add(batch)
    hour = lambda h: START + timedelta(hours=h)
    assert sorted(map(tuple, kept.counts().collect())) == [(hour(2), 1, 2), (hour(30), 4, 4), (hour(31), 0, 0)]
    assert sorted(map(tuple, kept.counts("day").collect())) == [(hour(0), 1, 2), (hour(24), 4, 4)]
    assert [tuple(r) for r in kept.counts("year").collect()] == [(hour(0), 4, 6)]


def test_counts_equal_those_of_all_rows(spark):
    rows = spark.range(30_000).select(
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 40 as int), cast(id % 60 as int))").alias("at"),
        # one text fills a third of the rows
        F.expr("if(id % 3 = 0, 'hot', 'w' || id % 997)").alias("who"), F.expr("pmod(xxhash64(id), 100000)").alias("n"), "id",
    )
    kept = HourlyDistinct(spark, new_folder(spark, "distinct"), "at", ["who", "n"], buckets=4)
    for turn in (2, 0, 1):
        kept.add(rows.where(F.col("id") % 3 == turn))
    want = rows.groupBy(F.date_trunc("hour", "at").cast("timestamp_ntz").alias("hour")).agg(F.count_distinct("who"), F.count_distinct("n"))
    assert kept.counts().exceptAll(want).isEmpty() and want.exceptAll(kept.counts()).isEmpty()
    numbers = kept.dictionary("who").read()
    assert numbers.count() == numbers.select("number").distinct().count() == rows.select("who").distinct().count()


def test_numbers_stay_and_are_dense(spark):
    names = Dictionary(spark, new_folder(spark, "names"), buckets=2)
    text = lambda n: spark.range(n).select(F.concat(F.lit("t"), "id").alias("value"))
    names.extend(text(50))
    before = {r.value: r.number for r in names.read().collect()}
    names.extend(text(80).union(text(80)).union(spark.sql("select cast(null as string)")))
    after = {r.value: (r.bucket, r.number) for r in names.read().collect()}
    assert len(after) == 80 and all(after[v][1] == n for v, n in before.items())
    for bucket in (0, 1):
        own = sorted(n for b, n in after.values() if b == bucket)
        assert own == list(range((bucket << 40) + 1, (bucket << 40) + 1 + len(own)))


def _hours(rows):
    return rows.groupBy("hour").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("who").alias("who"))


def _published(closed):
    return sorted(tuple(r) for r in closed.published.read().select("hour", "n", "who").collect())


@pytest.mark.parametrize("part", ["day", "month"])
def test_late_rows_are_listed_and_repaired(spark, part):
    closed = ClosedHours(spark, new_folder(spark, "closed"), ["n"], "at", _hours, timedelta(hours=2), part)
    hour = lambda h: START + timedelta(hours=h)
    closed.take(_rows(spark))
    assert closed.mark() is None
    closed.take(_rows(spark, (0, "a", 1), (1, "a", 2), (4.5, "b", 3), (1, "x", None), (None, "x", 4)))
    assert closed.mark() == hour(2) and _published(closed) == [(hour(0), 1, 1), (hour(1), 1, 1)]
    # late rows, a re-send, an hour that was empty, a row inside the bound
    batch = _rows(spark, (0.5, "c", 5), (0, "a", 1), (-30, "d", 6), (3, "b", 7))
    for _ in range(2):
        closed.take(batch)
    assert closed.mark() == hour(2) and len(_published(closed)) == 2
    assert sorted(r.hour for r in closed.listed.read().collect()) == [hour(-30), hour(0)]
    for _ in range(2):
        closed.repair()
        assert _published(closed) == [(hour(-30), 1, 1), (hour(0), 2, 2), (hour(1), 1, 1)]
    closed.take(_rows(spark, (40, "e", 8)))
    assert _published(closed)[3:] == [(hour(3), 1, 1), (hour(4), 1, 1)]
    closed.repair()
    assert len(_published(closed)) == 5
