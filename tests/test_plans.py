from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidemark.plans import build, daily, load, status, upkeep
from tidemark.plans.app import App
from tidemark.schema.raw import RAW
from tidemark.sources import partitions

DAYS = [date(2099, 1, d) for d in range(1, 6)]


def table(spark, per_day, columns=True):
    rows = [
        (day, sample.event(1000 * i, "first_open" if i == 0 else "screen_view", f"u{i % 3}",
                           [sample.param("ga_session_id", integer=i // 2)],
                           date=day.strftime("%Y%m%d")))
        for day, n in per_day.items() for i in range(n)
    ]
    schema = f"_dt date, e {sample.SCHEMA.simpleString()}"
    df = spark.createDataFrame(rows, schema).select("_dt", "e.*")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW.fields if f.name not in df.columns}
    return df.withColumns(missing)


def test_daily_run_from_tables_to_marts(spark, app):
    final = table(spark, {DAYS[0]: 5, DAYS[1]: 3})
    intraday = table(spark, {DAYS[1]: 9, DAYS[3]: 4})
    done = daily.run_days(app, final, intraday, DAYS[0], DAYS[4], "run-1")
    assert set(done.statuses.values()) == {"success", "skipped"}
    log = {r.event_date: (r.status, r.source_table, r.is_intraday, r.rows_inserted)
           for r in app.log().filter("strategy = 'tables'").collect()}
    assert log == {
        DAYS[0]: ("success", "events_20990101", 0, 5),
        DAYS[1]: ("success", "events_20990102", 0, 3),
        DAYS[2]: ("skipped", "", 1, 0),
        DAYS[3]: ("success", "events_intraday_20990104", 1, 4),
        DAYS[4]: ("skipped", "", 1, 0),
    }
    kpi = {r._dt: (r.dau, r.new_users, r.events) for r in app.mart("mart_daily_kpi").collect()}
    assert kpi == {DAYS[0]: (3, 1, 5), DAYS[1]: (3, 1, 3), DAYS[3]: (3, 1, 4)}
    retained = {(r.cohort_dt, r.day_n): r.retained_users for r in app.retention().collect()}
    assert retained[DAYS[0], 0] == 1 and retained[DAYS[0], 3] == 1


def test_a_day_without_source_keeps_what_is_stored(spark, app):
    both = table(spark, {DAYS[0]: 2, DAYS[1]: 2, DAYS[2]: 2})
    none = both.limit(0)
    load.load_tables(app, both, none, DAYS[0], DAYS[2], "run-1")
    load.load_tables(app, both.filter(F.col("_dt") != DAYS[1]), none, DAYS[0], DAYS[2], "run-2")
    got = {r._dt: r._run_id for r in app.raw().select("_dt", "_run_id").distinct().collect()}
    assert got == {DAYS[0]: "run-2", DAYS[1]: "run-1", DAYS[2]: "run-2"}


def test_a_broken_file_fails_only_its_day(spark, app, tmp_path):
    root = tmp_path / "export"
    for day in DAYS[:4]:
        sample.write_day(spark, sample.first_rows(), str(root), f"dt={day}")
    for path in (root / f"dt={DAYS[1]}").glob("*.parquet"):
        path.write_bytes(b"not parquet")
    for path in (root / f"dt={DAYS[1]}").glob(".*.crc"):
        path.unlink()
    with pytest.raises(status.DaysFailed, match="2099-01-02"):
        load.load_files(app, str(root), DAYS[0], DAYS[4], "run-1")
    log = {r.event_date: r.status for r in app.log().collect()}
    assert log == {DAYS[0]: "success", DAYS[1]: "failed", DAYS[2]: "success",
                   DAYS[3]: "success", DAYS[4]: "skipped"}
    assert app.raw().groupBy("_dt").count().count() == 3


def test_one_bad_file_of_many_is_named(spark, app, tmp_path, monkeypatch):
    """The bad file's name stands in the log, and the range is not halved to find its day."""
    from tidemark.sources import folders

    root = tmp_path / "export"
    for day in DAYS[:3]:
        folder = str(root / f"dt={day}")
        sample.frame(spark, sample.first_rows() * 17).repartition(50).write.parquet(folder)
    bad = sorted((root / f"dt={DAYS[1]}").glob("*.parquet"))[7]
    folders.overwrite(spark, str(bad), b"cut off")
    jobs = []
    over = status.over_range
    monkeypatch.setattr(status, "over_range", lambda job, a, b: over(lambda x, y: jobs.append((x, y)) or job(x, y), a, b))
    with pytest.raises(status.DaysFailed, match=str(DAYS[1])):
        load.load_files(app, str(root), DAYS[0], DAYS[4], "run-1")
    assert jobs == [(DAYS[0], DAYS[4])]
    log = {r.event_date: (r.status, r.error_message) for r in app.log().collect()}
    assert log == {DAYS[0]: ("success", ""), DAYS[1]: ("failed", f"files that can't be read: {bad.name}"),
                   DAYS[2]: ("success", ""), DAYS[3]: ("skipped", ""), DAYS[4]: ("skipped", "")}
    assert {r["_dt"]: r["count"] for r in app.raw().groupBy("_dt").count().collect()} == {DAYS[0]: 51, DAYS[2]: 51}


def test_a_day_of_two_types_loads(spark, app, tmp_path):
    root = str(tmp_path / "export")
    rows = sample.frame(spark, sample.first_rows()).withColumn("batch_page_id", F.lit(5).cast("bigint"))
    rows.coalesce(1).write.parquet(f"{root}/dt={DAYS[0]}")
    text = rows.withColumn("batch_page_id", F.lit("6")).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    text.coalesce(1).write.mode("append").parquet(f"{root}/dt={DAYS[0]}")
    assert load.load_files(app, root, DAYS[0], DAYS[0], "run-1") == {DAYS[0]: "success"}
    got = sorted(tuple(r) for r in app.raw().select("event_timestamp", "batch_page_id").collect())
    assert got == [(1000, 5), (1000, 6), (2000, 5), (2000, 6), (3000, 5), (3000, 6)]


def test_files_without_rows_fail_the_day(spark, app, tmp_path):
    root = str(tmp_path / "export")
    sample.write_day(spark, [], root, f"dt={DAYS[0]}")
    with pytest.raises(status.DaysFailed):
        load.load_files(app, root, DAYS[0], DAYS[0], "run-1")
    assert [r.error_message for r in app.log().collect()] == ["no rows loaded"]


def test_range_is_halved_to_find_the_failing_days():
    calls = []

    def job(a, b):
        calls.append((a, b))
        days = [a + timedelta(days=i) for i in range((b - a).days + 1)]
        if DAYS[3] in days:
            raise ValueError("bad day")
        return dict.fromkeys(days, "success")

    got = status.over_range(job, DAYS[0], DAYS[4])
    assert got.pop(DAYS[3]).startswith("failed") and set(got.values()) == {"success"}
    assert len(got) == 4


@pytest.mark.parametrize("text,in_data", [
    ("[FAILED_READ_FILE.NO_HINT] Encountered error while reading file x. Caused by: not a Parquet file", True),
    ("[FAILED_READ_FILE.NO_HINT] while reading x. Caused by: org.apache.hadoop.security.AccessControlException: denied", False),
    ("[FAILED_READ_FILE.NO_HINT] while reading x. Caused by: java.net.SocketTimeoutException: timeout", False),
    ("[CAST_INVALID_INPUT] The value 'soon' cannot be cast", True),
    ("[UNRESOLVED_COLUMN] a column", False),
])
def test_the_cause_of_a_failed_read_decides(text, in_data):
    from pyspark.errors import PySparkException

    assert status.lies_in_data(PySparkException(text)) == in_data


def test_mart_of_an_unflattened_day_is_an_error(spark, app):
    with pytest.raises(ValueError, match="flatten"):
        build.build_mart_day(app, DAYS[0], "run-1")


def test_expiry_and_compaction(spark, app):
    rows = table(spark, dict.fromkeys(DAYS, 40))
    other = App(spark, app.root + "-other")
    load.load_tables(other, rows, rows.limit(0), DAYS[0], DAYS[4], "run-1")
    partitions.replace_days(
        other.raw().repartition(6), app.path("events_raw"), set(DAYS), rebalance=False
    )
    before = app.raw().orderBy("_dt", "event_timestamp").collect()
    upkeep.compact_days(app, DAYS[0], DAYS[3])
    assert app.raw().orderBy("_dt", "event_timestamp").collect() == before
    report = {r._dt: (r.files, r.rows) for r in upkeep.storage_report(app).collect()}
    assert all(report[d] == (1, 40) for d in DAYS[:4]) and report[DAYS[4]][0] > 1

    assert upkeep.expire(app, 0, "2100-01-01") == []
    assert upkeep.expire(app, 3, DAYS[4]) == DAYS[:2]
    assert {r._dt for r in app.raw().select("_dt").distinct().collect()} == set(DAYS[2:])


@pytest.mark.parametrize("seed", range(2))
def test_flat_rows_equal_raw_rows_for_any_bags(spark, app, seed):
    rng = random.Random(seed)
    keys = ["a", "b", "a-b", "a.b", "1", "", "user_id", "geo_city", "Ä", "A"]

    def bag():
        return [sample.param(rng.choice(keys), rng.choice([None, "x"]), rng.choice([None, 1]),
                             rng.choice([None, 0.5]), rng.choice([None, 2.5]))
                for _ in range(rng.randint(0, 6))]

    rows = [(DAYS[0], sample.event(i, "e", "u", bag())) for i in range(60)]
    schema = table(spark, {DAYS[0]: 1})
    df = spark.createDataFrame([r[1] for r in rows], sample.SCHEMA).withColumn("_dt", F.lit(DAYS[0]))
    df = df.withColumns({c: F.lit(None).cast(schema.schema[c].dataType)
                         for c in schema.columns if c not in df.columns})
    load.load_tables(app, df, df.limit(0), DAYS[0], DAYS[0], "r")
    build.flatten_days(app, DAYS[0], DAYS[0], "r")
    flat = {r.event_timestamp: r for r in app.flat().collect()}
    assert len(flat) == 60
    names = {(c.source, c.key, c.sub_field): c.name for c in app.columns()}
    for _, e in rows:
        first = {}
        for key, values in e[3]:
            first.setdefault(key, values)
        for (source, key, sub), column in names.items():
            index = ["string_value", "int_value", "float_value", "double_value"].index(sub)
            want = first[key][index] if key in first else None
            assert flat[e[1]][column] == want, (key, sub)


def test_a_systemic_error_is_met_once():
    calls = []

    def job(a, b):
        calls.append((a, b))
        raise PermissionError("no write access")

    got = status.over_range(job, date(2024, 1, 1), date(2024, 12, 31))
    assert len(calls) == 1 and len(got) == 366
    assert set(got.values()) == {"failed: no write access"}


def test_one_bad_day_costs_a_logarithm_of_attempts():
    calls = []

    def job(a, b):
        calls.append((a, b))
        if a <= date(2024, 5, 17) <= b:
            raise ValueError("bad row")
        return dict.fromkeys(status.span(a, b), "success")

    got = status.over_range(job, date(2024, 1, 1), date(2024, 12, 31))
    assert [d for d, s in got.items() if s != "success"] == [date(2024, 5, 17)]
    assert len(calls) <= 2 * 9 + 1


def bagless(df, day):
    empty = F.array().cast(df.schema["event_params"].dataType)
    return df.withColumn("event_params", F.when(F.col("_dt") == day, empty).otherwise(F.col("event_params")))


def test_a_day_that_fails_its_checks_stops_no_other(spark, app):
    rows = table(spark, dict.fromkeys(DAYS[:4], 4))
    nameless = F.when((F.col("_dt") == DAYS[2]) & (F.col("event_timestamp") > 1000), None)
    rows = rows.withColumn("user_pseudo_id", nameless.otherwise(F.col("user_pseudo_id")))
    with pytest.raises(status.DaysFailed, match="2099-01-02.*checks: no event_params"):
        daily.run_days(app, bagless(rows, DAYS[1]), rows.limit(0), DAYS[0], DAYS[4], "run-1")
    log = {r.event_date: (r.status, r.stage, r.message, r.warnings) for r in app.daily_log().collect()}
    assert log == {
        DAYS[0]: ("success", "marts", "", ""),
        DAYS[1]: ("failed", "checks", "no event_params could be read", "100.0% of rows have no event_params"),
        DAYS[2]: ("success", "marts", "", "50.0% of rows have no user"),
        DAYS[3]: ("success", "marts", "", ""),
        DAYS[4]: ("skipped", "load", "", ""),
    }
    built = {r._dt for r in app.mart("mart_daily_kpi").collect()}
    assert built == {DAYS[0], DAYS[2], DAYS[3]}
    assert {r._dt for r in app.flat().select("_dt").collect()} == built


def test_skipped_days_in_between_are_left_alone(spark, app):
    first = bagless(table(spark, {DAYS[1]: 3}), DAYS[1])
    load.load_tables(app, first, first.limit(0), DAYS[1], DAYS[1], "old")
    rows = table(spark, {DAYS[0]: 2, DAYS[2]: 2})
    done = daily.run_days(app, rows, rows.limit(0), DAYS[0], DAYS[2], "new")
    assert done.statuses == {DAYS[0]: "success", DAYS[1]: "skipped", DAYS[2]: "success"}
    assert {r._dt for r in app.flat().select("_dt").collect()} == {DAYS[0], DAYS[2]}


@pytest.mark.parametrize("stage", ["load", "flatten", "marts"])
def test_a_failing_stage_fails_its_day_only(spark, app, monkeypatch, stage):
    rows = table(spark, dict.fromkeys(DAYS[:3], 2))
    module, name = {"load": (load, "try_tables"), "flatten": (build, "try_flatten"), "marts": (build, "try_marts")}[stage]
    real = getattr(module, name)

    def one_day_fails(*args, **kwargs):
        done = real(*args, **kwargs)
        statuses = done.statuses if stage == "flatten" else done
        statuses[DAYS[1]] = "failed: broken"
        return done

    monkeypatch.setattr(module, name, one_day_fails)
    done = daily.try_days(app, rows, rows.limit(0), DAYS[0], DAYS[2], "r")
    assert {d: (o.status, o.message) for d, o in done.outcomes.items()} == {
        DAYS[0]: ("success", ""), DAYS[1]: ("failed", "broken"), DAYS[2]: ("success", "")}
    assert {r.event_date: r.stage for r in app.daily_log().collect()}[DAYS[1]] == stage
    assert {r._dt for r in app.mart("mart_daily_kpi").collect()} >= {DAYS[0], DAYS[2]}


def test_intraday_drift_is_told(spark, app, monkeypatch):
    monkeypatch.setattr("tidemark.operators.quality.INTRADAY_DRIFT", 0.5)
    rows = table(spark, {DAYS[0]: 4})
    real = load.partitions.replace_days

    def drifting(df, path, *args, **kwargs):
        if path.endswith("events_raw"):
            df = df.filter("event_timestamp > 0")
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(load.partitions, "replace_days", drifting)
    done = daily.try_days(app, rows.limit(0), rows, DAYS[0], DAYS[0], "r")
    assert done.outcomes[DAYS[0]].warnings == ["row counts drift: loaded 3, source 4"]
    assert done.statuses == {DAYS[0]: "success"}


def files_per_day(root):
    import pathlib

    return {p.name: len(list(p.glob("*.parquet"))) for p in pathlib.Path(root).glob("_dt=*")}


def test_one_file_per_small_day(spark, app):
    days = [date(2099, 2, d) for d in range(1, 9)]
    rows = table(spark, dict.fromkeys(days, 40)).repartition(40)
    load.load_tables(app, rows, rows.limit(0), days[0], days[-1], "r")
    build.flatten_days(app, days[0], days[-1], "r")
    for name in ("events_raw", "events_flat"):
        assert set(files_per_day(app.path(name)).values()) == {1}


def test_a_large_day_is_several_tasks(spark, app):
    rows = table(spark, {DAYS[0]: 400}).repartition(8)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[0], "r")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert list(files_per_day(app.path("events_raw")).values())[0] > 1


def test_compacted_days_share_no_task_and_no_cut(spark, app):
    rows = table(spark, dict(zip(DAYS, (10, 70, 30, 50, 40))))
    load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[4], "r")
    before = app.raw().orderBy("_dt", "event_timestamp").collect()
    largest = max(r.bytes for r in upkeep.storage_report(app).collect())
    upkeep.compact_days(app, DAYS[0], DAYS[4], largest)
    assert files_per_day(app.path("events_raw")) == {f"_dt={d}": 1 for d in DAYS}
    upkeep.compact_days(app, DAYS[1], DAYS[1], largest // 2)
    assert files_per_day(app.path("events_raw")) == {f"_dt={d}": 3 if d == DAYS[1] else 1 for d in DAYS}
    assert app.raw().orderBy("_dt", "event_timestamp").collect() == before


def test_a_broken_compaction_leaves_the_day(spark, app, monkeypatch):
    rows = table(spark, dict.fromkeys(DAYS[:3], 10))
    load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[2], "r")
    before = app.raw().orderBy("_dt", "event_timestamp").collect()
    real, moves = upkeep.folders.rename, []

    def breaks(spark, path, target):
        moves.append(path)
        if len(moves) == 2:
            raise OSError("disk gone")
        real(spark, path, target)

    monkeypatch.setattr(upkeep.folders, "rename", breaks)
    with pytest.raises(OSError):
        upkeep.compact_days(app, DAYS[0], DAYS[2])
    monkeypatch.setattr(upkeep.folders, "rename", real)
    assert upkeep.recover(app) == [DAYS[0]]
    assert app.raw().orderBy("_dt", "event_timestamp").collect() == before

    monkeypatch.setattr(upkeep.partitions, "replace_days", lambda *a, **k: set())
    with pytest.raises(upkeep.CountsDiffer):
        upkeep.compact_days(app, DAYS[0], DAYS[2])
    assert app.raw().orderBy("_dt", "event_timestamp").collect() == before


def test_flat_rows_are_compacted_too(spark, app):
    rows = table(spark, dict.fromkeys(DAYS[:2], 10))
    load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[1], "r")
    build.flatten_days(app, DAYS[0], DAYS[1], "r")
    before = app.flat().orderBy("_dt", "event_timestamp").collect()
    assert upkeep.compact_days(app, DAYS[0], DAYS[1], name="events_flat") == set(DAYS[:2])
    assert app.flat().orderBy("_dt", "event_timestamp").collect() == before


def test_a_range_lists_its_own_days_only(spark, app):
    rows = table(spark, dict.fromkeys(DAYS, 2))
    load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[4], "r")
    files = app.raw(DAYS[1], DAYS[2]).inputFiles()
    assert {f.split("_dt=")[1][:10] for f in files} == {str(DAYS[1]), str(DAYS[2])}
    assert app.raw(DAYS[1], DAYS[2]).count() == 4 and app.raw("2098-01-01", "2098-01-02").count() == 0


def test_storage_total(spark, app):
    rows = table(spark, dict.fromkeys(DAYS[:2], 10))
    load.load_tables(app, rows, rows.limit(0), DAYS[0], DAYS[1], "r")
    total = upkeep.storage_total(app).first()
    assert (total.files, total.rows, total.too_large) == (2, 20, False)


def test_drift_of_files_that_disagree(spark, tmp_path):
    from pyspark.sql import types as T

    from tidemark.operators import drift

    root = str(tmp_path)
    declared = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    spark.range(2).selectExpr("id AS a", "'x' AS b").write.parquet(f"{root}/dt=2099-01-01")
    spark.range(2).selectExpr("'1' AS a", "'x' AS b").write.parquet(f"{root}/dt=2099-01-02")
    spark.range(2).selectExpr("id AS a", "1 AS c").write.parquet(f"{root}/dt=2099-01-03")
    spark.range(2).selectExpr("id AS a", "'x' AS b").write.parquet(f"{root}/dt=2099-01-04")
    spark.range(2).selectExpr("'1' AS a", "'x' AS b").write.mode("append").parquet(f"{root}/dt=2099-01-04")
    got = {tuple(r) for r in drift.schema_drift(spark, root, DAYS[0], DAYS[4], declared).collect()}
    assert got == {
        (DAYS[1], "a", "mismatched", "bigint", "string"),
        (DAYS[2], "b", "missing", "string", None), (DAYS[2], "c", "extra", None, "int"),
        (DAYS[3], "a", "mismatched", "bigint", "string"),
    }
