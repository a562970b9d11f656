"""Stream entries read in one pass against single reads, and how often the derived log is made."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.functions import vlong, vstr, vvar
from ledgerlake.plans import classic_bronze
from ledgerlake.sources.sink_log import named, stream_results, typed_results
from workload import classiclike

CONTENTS = [
    '{"model":{"name":"m"},"results":[{"a":"x","n":"12","v":{"p":[1,null]}},{"a":7,"n":1.0,"v":null},{"a":null,"n":"no","v":"t"},{}]}',
    '{"model":{"name":"m"},"results":[{"a":{"b":1},"n":99999999999999999999,"v":[1]},{"a":1.50,"n":true},{"a":1e3,"n":2.7},{"A":"other"}]}',
    '{"model":{"name":"m"},"results":[5,"text",null,[{"a":"inner"}],{"a":"after","n":3}]}',
    '{"model":{"name":"m"},"results":{"a":"no array"}}', '{"model":{"name":"m"},"results":[]}', '{"model":{"name":"m"}}',
    '{"model":{"name":"other"},"results":[{"a":"x"}]}', '[]', "null",
]


def test_one_pass_equals_single_reads(spark):
    log = spark.createDataFrame([(i, c) for i, c in enumerate(CONTENTS)], "i int, c string").select(
        F.parse_json(F.lit('{"CreateTime":1000}')).alias("record_metadata"), F.parse_json("c").alias("record_content"),
        F.timestamp_seconds("i").cast("timestamp_ntz").alias("_inserted_timestamp"),
    )
    single = stream_results(log, named("m")).select(
        "system_created_at", "_inserted_timestamp", vstr("t", "a").alias("a"), vlong("t", "n").alias("n"), vvar("t", "v").alias("v")
    )
    both = [sorted(map(str, df.select("*", F.to_json("v").alias("j"), F.col("v").isNull().alias("z")).drop("v").collect())) for df in (single, typed_results(log, named("m"), ["a string", "n bigint", "v variant"]))]
    assert both[0] == both[1] and len(both[0]) == 13


@pytest.mark.parametrize("rows", [
    lambda s, d: classic_bronze.classic_msgs(classiclike.message_log(s, d)),
    lambda s, d: classic_bronze.classic_msg_events_actions(classiclike.event_log(s, d), all_events=True),
])
def test_a_record_is_made_and_read_once(spark, rows):
    text = rows(spark, entry.SMALL)._jdf.queryExecution().executedPlan().toString()
    # both parts of the union: the content and the metadata, each once; before, the filter on the stream parsed the content again
    assert text.count("parseJson") == 4 and text.count("ArrayType(StructType") == 1
