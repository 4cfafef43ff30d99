from __future__ import annotations

from pyspark.sql import functions as F

from tests import sample
from tidemark.functions import params
from tidemark.sources import raw


def bags(spark, *bag_list):
    rows = [sample.event(i, "e", "u", bag) for i, bag in enumerate(bag_list)]
    return raw.with_defaults(sample.frame(spark, rows)).orderBy("event_timestamp")


def test_first_of_a_repeated_key_counts_and_an_absent_key_is_null(spark):
    df = bags(spark, [sample.param("a", integer=1), sample.param("a", integer=2)], [])
    bag = F.col("event_params")
    got = df.select(
        params.value(bag, "a", "int_value"), params.value(bag, "b", "int_value"),
        params.has_key(bag, "a"), params.count(bag),
    ).collect()
    assert [tuple(r) for r in got] == [(1, None, True, 2), (None, None, False, 0)]


def test_null_keys_null_entries_and_null_bags_get_defaults(spark):
    rows = [(1, [(None, ("x", None, None, None)), None]), (2, None)]
    schema = sample.SCHEMA
    df = spark.createDataFrame(
        [(None, ts, None, bag, None, None, None, None, None) for ts, bag in rows], schema)
    got = raw.with_defaults(df).orderBy("event_timestamp").collect()
    assert [p.key for p in got[0].event_params] == ["", ""]
    assert got[0].event_params[0].value.string_value == "x"
    assert got[1].event_params == [] and got[1].user_properties == []
    assert (got[0].event_date, got[0].event_name, got[0].platform) == ("", "", "")
    assert got[0].user_pseudo_id is None


def test_lookup_reads_only_the_sub_field_asked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    sample.frame(spark, sample.first_rows()).write.parquet(path)
    df = spark.read.schema(sample.SCHEMA).parquet(path)
    plan = df.select(params.value(F.col("event_params"), "page", "string_value"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "string_value" in text and "double_value" not in text
