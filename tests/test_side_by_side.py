"""Models that do not read each other run side by side; the order of inputs, failures and session settings hold."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.incremental.models import FromHour, Fresh, IdRange, Model, ModelSet
from ledgerlake.run import Run
from ledgerlake.session import new_folder, whole_variants

RUN = Run(datetime(2024, 5, 1), "first")
SHREDDING = "spark.sql.variant.inferShreddingSchema"


def raw(spark):
    return {"raw": spark.range(20).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("_inserted_timestamp"))}


def models(meet, failing=()):
    def copy(name):
        def build(inputs, run):
            meet()
            if name in failing:
                raise RuntimeError(name)
            return inputs["raw"]

        return Model(name, ["id"], IdRange("id", 10), {"raw": Fresh()}, build)

    both = Model("both", ["id"], IdRange("id", 10), {"a": Fresh(), "b": Fresh()}, lambda i, run: i["a"].join(i["b"].select("id"), "id"))
    return [copy("a"), copy("b"), both]


def test_two_models_run_at_once_and_the_third_after_them(spark):
    built = ModelSet(spark, new_folder(spark, "set"), models(threading.Barrier(2, timeout=60).wait))  # one after the other would break the barrier
    before = spark.conf.get(SHREDDING, None)
    built.update(raw(spark), RUN)
    assert [built.table(n).read().count() for n in ("a", "b", "both")] == [20, 20, 20]
    assert {(r.run, r.model, r.part) for r in built.log().collect()} == {(0, m, p) for m in ("a", "b", "both") for p in ("p0", "p1")}
    assert spark.conf.get(SHREDDING, None) == before


def test_a_failure_ends_the_run_and_is_made_good(spark):
    root = new_folder(spark, "set")
    with pytest.raises(RuntimeError, match="b"):
        ModelSet(spark, root, models(lambda: None, ["b"])).update(raw(spark), RUN)
    lost = ModelSet(spark, root, models(lambda: None))
    assert lost.log() is None and lost.table("both").read() is None
    lost.update(raw(spark), RUN)
    assert [lost.table(n).read().count() for n in ("a", "b", "both")] == [20, 20, 20]


def test_bounds_count_as_reads():
    model = Model("m", ["id"], IdRange("id"), {"x": FromHour("y")}, lambda i, run: i["x"])
    assert model.reads() == {"x", "y"}


def test_the_last_of_several_writes_restores_the_setting(spark):
    before, df = spark.conf.get(SHREDDING, None), spark.range(1)
    first, second = whole_variants(df), whole_variants(df)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHREDDING) == "false"
    second.__exit__(None, None, None)
    assert spark.conf.get(SHREDDING, None) == before
