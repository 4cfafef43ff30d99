from __future__ import annotations

from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

import bench
from tests import sample
from tidemark.operators import flatten, marts, quality, retention
from tidemark.operators.registry import DynamicColumn
from tidemark.shaped import queries

SF = "/root/testdata/sf0.001"
D1 = date(2099, 1, 1)


def flat_of(spark, rows):
    from tidemark.schema.raw import RAW
    from tidemark.sources import raw

    df = sample.frame(spark, rows)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW.fields if f.name not in df.columns}
    full = raw.with_defaults(df.withColumns(missing)).withColumn("_dt", F.lit(D1))
    dynamic = [DynamicColumn("event_params", k, "int_value", f"{k}_int")
               for k in ("ga_session_id", "session_engaged", "engagement_time_msec")]
    return flatten.flatten(full, dynamic, "r")


def session_event(ts, user, session=None, engaged=None, name="e", platform="ANDROID"):
    params = []
    if session is not None:
        params.append(sample.param("ga_session_id", integer=session))
    if engaged is not None:
        params.append(sample.param("session_engaged", integer=engaged))
    return sample.event(ts, name, user, params, platform=platform)


def test_kpi_equals_the_plain_form(spark):
    flat = queries._flat(spark, SF)
    got = marts.MARTS[0].from_flat(flat)
    plain = bench.naive_kpi(flat).toDF(*[c if c != "engagement_sec" else "ms" for c in got.columns])
    plain = plain.withColumn("engagement_sec", F.round(F.col("ms") / 1000, 3))
    for df in (got, plain):
        assert df.count() == 30

    def rows(df):
        return [tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                for r in df.select(*got.columns).orderBy("_dt").collect()]

    assert rows(got) == rows(plain)


def test_sessions_of_a_missing_user_count_and_missing_sessions_do_not(spark):
    flat = flat_of(spark, [
        session_event(1, "a", 1), session_event(2, "a", 1), session_event(3, "a", 2),
        session_event(4, None, 1), session_event(5, None, 2), session_event(6, "b"),
        session_event(7, "b", None, 1), session_event(8, "b", None, 1), session_event(9, "", 1, 1),
    ])
    kpi = marts.MARTS[0].from_flat(flat).first()
    assert (kpi.dau, kpi.sessions, kpi.engaged_sessions, kpi.events) == (3, 5, 2, 9)


def test_latest_value_wins_and_ties_are_settled(spark):
    flat = flat_of(spark, [
        session_event(1, "a", platform="X"), session_event(2, "a", platform="B"),
        session_event(2, "a", platform="C"), session_event(1, "", platform="Z"),
        session_event(9, None),
    ])
    got = {r.user_pseudo_id: r for r in marts.MARTS[3].from_flat(flat).collect()}
    assert set(got) == {"a", ""}
    assert (got["a"].platform, got["a"].events, got["a"].is_new) == ("C", 3, 0)


def test_event_names_are_parameters(spark):
    flat = flat_of(spark, [session_event(1, "a", name="buy"), session_event(2, "a", name="buy")])
    names = marts.EventNames(purchase="buy")
    kpi = marts.MARTS[0].from_flat(flat, names).first()
    assert (kpi.purchases, kpi.buyers) == (2, 1)


def test_cascade_has_no_expand(spark):
    for mart in marts.MARTS:
        df = mart.from_flat(queries._flat(spark, SF))
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_retention_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(date(2024, 1, d), f"u{u}", int(rng.random() < 0.3))
            for d in range(1, 12) for u in range(20) if rng.random() < 0.5]
    want = defaultdict(set)
    for c, user, new in rows:
        for a, other, _ in rows:
            if new and user == other and a >= c:
                want[c, (a - c).days].add(user)
    df = spark.createDataFrame(rows, "_dt date, user_pseudo_id string, is_new int")
    got = {(r.cohort_dt, r.day_n): r.retained_users for r in retention.retention(df).collect()}
    assert got == {k: len(v) for k, v in want.items()}


@pytest.mark.parametrize("source, loaded, intraday, want", [
    (100, 100, False, "ok"), (100, 99, False, "fail"), (1000, 1005, True, "warn"),
    (1000, 1006, True, "fail"), (0, 3, True, "fail"), (0, 0, True, "ok"),
])
def test_row_reconciliation(spark, source, loaded, intraday, want):
    left = spark.createDataFrame([(D1, source)], "_dt date, source_rows bigint")
    right = spark.createDataFrame([(D1, loaded)], "_dt date, loaded_rows bigint")
    got = quality.reconcile_source(left, right, F.lit(intraday)).first()
    assert got.verdict == want


def test_mart_reconciliation_fails_on_a_difference_and_on_an_empty_day(spark):
    flat = spark.createDataFrame([(D1, 5)], "_dt date, flat_rows bigint")
    events = spark.createDataFrame(
        [(D1, 4), (date(2099, 1, 2), 1)], "_dt date, events bigint")
    got = quality.reconcile_marts(flat, events).collect()
    assert {r.verdict for r in got} == {"fail"}
