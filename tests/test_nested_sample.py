"""The nested sample through load, checks and flatten, twice, with a new key in between."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidemark.functions import params
from tidemark.operators import quality
from tidemark.plans import build, load
from tidemark.sources import raw

DAY = date(2099, 1, 1)


@pytest.fixture
def export(spark, tmp_path):
    root = str(tmp_path / "export")
    sample.write_day(spark, sample.first_rows(), root)
    return root


def test_load_keeps_nested_values(spark, app, export):
    assert load.load_files(app, export, DAY, DAY, "run-1") == {DAY: "success"}
    bag, properties = F.col("event_params"), F.col("user_properties")
    got = raw.with_computed_day(app.raw()).orderBy("event_timestamp").select(
        params.count(bag).alias("n"),
        params.value(bag, "ga_session_id", "int_value").alias("session"),
        params.value(bag, "page", "string_value").alias("page"),
        params.value(properties, "_worth", "double_value").alias("ltv"),
        params.value(properties, "_worth", "set_timestamp_micros").alias("set_at"),
        "user_pseudo_id", "event_date_d", "geo.country", "publisher", "items", "_is_intraday",
    ).collect()
    assert [r.n for r in got] == [2, 0, 1]
    assert (got[0].session, got[0].page, got[0].ltv, got[0].set_at) == (123, "home", 1.5, 417)
    assert got[2].user_pseudo_id is None
    assert {r.event_date_d for r in got} == {DAY}
    assert {r.country for r in got} == {"Vietnam"}
    assert got[0].publisher is None and got[0]["items"] == [] and got[0]._is_intraday == 1


def test_second_load_replaces_the_day(app, export):
    load.load_files(app, export, DAY, DAY, "run-1")
    load.load_files(app, export, DAY, DAY, "run-2")
    assert [r._run_id for r in app.raw().collect()] == ["run-2"] * 3
    assert sorted(r.run_id for r in app.log().collect()) == ["run-1", "run-2"]


def test_quality_numbers(app, export):
    load.load_files(app, export, DAY, DAY, "run-1")
    got = quality.metrics(app.raw()).first()
    assert tuple(got) == (DAY, 3, 1, 1, 3, 2)
    assert quality.nested_readable(app.raw()).first().nested_readable


def test_flatten_adds_columns_as_keys_appear(spark, app, export):
    load.load_files(app, export, DAY, DAY, "run-1")
    done = build.flatten_days(app, DAY, DAY, "run-1")
    assert done.statuses == {DAY: "success"}
    assert set(done.new_columns) == {
        "ga_session_id_int", "page_str", "_worth_double", "up_user_id_str"}
    row = app.flat().filter("event_timestamp = 1000").first()
    assert (row.ga_session_id_int, row.page_str, row.up_user_id_str, row.event_date,
            row.device_operating_system, row.geo_country) == (
        123, "home", "acc-9", DAY, "Android", "Vietnam")

    sample.write_day(spark, [*sample.first_rows(), sample.new_key_row()], export)
    load.load_files(app, export, DAY, DAY, "run-2")
    again = build.flatten_days(app, DAY, DAY, "run-2")
    assert again.new_columns == ["fresh_key_str"]
    assert app.flat().count() == 4
    assert app.flat().filter("event_timestamp = 4000").first().fresh_key_str == "grüezi"

    third = build.flatten_days(app, DAY, DAY, "run-3")
    assert third.new_columns == [] and app.flat().count() == 4
    seen = {r.column_name: r.n_seen for r in app.registry().filter("key = 'page'").collect()}
    assert seen == {"page_str": 1}


def test_a_day_flattened_earlier_reads_null_for_later_columns(spark, app, tmp_path):
    root = str(tmp_path / "export")
    sample.write_day(spark, sample.first_rows(), root)
    sample.write_day(spark, [sample.new_key_row()], root, "dt=2099-01-02")
    load.load_files(app, root, DAY, "2099-01-02", "run-1")
    build.flatten_days(app, DAY, DAY, "run-1")
    build.flatten_days(app, "2099-01-02", "2099-01-02", "run-1")
    got = {r.event_timestamp: r.fresh_key_str for r in app.flat().collect()}
    assert got == {1000: None, 2000: None, 3000: None, 4000: "grüezi"}
