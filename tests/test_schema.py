from __future__ import annotations

from datetime import date

import pytest

from tidemark.functions import days
from tidemark.schema.flat import BASE, reserved_names
from tidemark.schema.raw import RAW, STORED_RAW


def test_raw_has_31_declared_columns_and_5_of_metadata():
    assert len(RAW.names) == len(set(RAW.names)) == 31
    assert STORED_RAW.names[31:] == [
        "_dt", "_ingested_at", "_run_id", "_source_table", "_is_intraday"]


def test_flat_has_139_fixed_columns():
    names = [c.name for c in BASE]
    assert len(names) == len(set(names)) == 139
    groups = {"stlc_": 69, "device_": 17, "cts_": 12, "geo_": 6, "app_info_": 5, "privacy_": 3,
              "traffic_source_": 3, "publisher_": 4, "user_ltv_": 2, "event_dimensions_": 1}
    for prefix, count in groups.items():
        assert sum(n.startswith(prefix) for n in names) == count, prefix
    assert {"device_web_browser", "stlc_gads_account_name", "stlc_cm360_site_id"} <= set(names)
    assert reserved_names()[-3:] == ["_dt", "_ingested_at", "_run_id"]


def test_event_timestamp_stays_an_integer():
    assert RAW["event_timestamp"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("text", ["27-08-2026", "2026-8-27", "20260827", "", "2026-08-27x"])
def test_bad_days_are_refused(text):
    with pytest.raises(ValueError):
        days.check_day(text)


def test_range_must_be_in_order():
    assert days.check_range("2026-08-01", date(2026, 8, 2)) == (date(2026, 8, 1), date(2026, 8, 2))
    with pytest.raises(ValueError):
        days.check_range("2026-08-02", "2026-08-01")
