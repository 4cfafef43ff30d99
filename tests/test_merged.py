"""Tables of a merged base and deltas, and sums of key counts by month."""

from __future__ import annotations

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import sample
from tidemark.operators import discover, registry
from tidemark.plans import build, load
from tidemark.plans.app import App
from tidemark.schema.raw import RAW
from tidemark.sources import folders, merged

SCHEMA = "run int, v int"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def stored(spark, path):
    return sorted(tuple(r) for r in merged.read(spark, path, SCHEMA).collect())


def test_many_runs_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored(spark, path) == []
    for run in range(60):
        merged.append(rows(spark, (run, 1), (run, 2)), path, most=4)
    assert stored(spark, path) == [(run, v) for run in range(60) for v in (1, 2)]
    assert len(glob.glob(f"{path}/*/*.parquet")) <= 2 + 2 * 4


def test_merging_keeps_what_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    for run in range(10):
        newest = lambda r: r.groupBy("v").agg(F.max("run").alias("run"))
        merged.append(rows(spark, (run, run % 2), (run, 7)), path, newest, most=3)
    got = stored(spark, path)
    assert {(8, 0), (9, 1), (9, 7)} <= set(got) and len(got) <= 3 + 2 * 3


def test_a_listed_table_outlives_one_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    for run in range(3):
        merged.append(rows(spark, (run, run)), path, most=4)
    listed = merged.read(spark, path, SCHEMA)
    for run in range(3, 6):
        merged.append(rows(spark, (run, run)), path, most=4)
    assert listed.count() == 3 and len(stored(spark, path)) == 6


def test_a_broken_merge_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for run in range(3):
        merged.append(rows(spark, (run, run)), path, most=4)

    def breaks(_):
        raise OSError("no space")

    with pytest.raises(OSError):
        merged.append(rows(spark, (3, 3)), path, breaks, most=4)
    assert len(stored(spark, path)) == 4
    rename = folders.rename
    monkeypatch.setattr(folders, "rename", lambda s, a, b: rename(s, a, b) if "delta" in b else breaks(s))
    with pytest.raises(OSError):
        merged.append(rows(spark, (4, 4)), path, most=4)
    monkeypatch.undo()
    merged.append(rows(spark, (5, 5)), path, most=4)
    assert stored(spark, path) == [(n, n) for n in range(6)]
    assert len(glob.glob(f"{path}/base-*")) == 1


DAYS = (date(2099, 1, 30), date(2099, 1, 31), date(2099, 2, 1), date(2099, 3, 5))


def bags(day, *keys):
    return [(*sample.event(1000 + i, "e", "u", [sample.param(k, integer=1)]), day) for i, k in enumerate(keys)]


@pytest.fixture
def months(spark, tmp_path):
    app = App(spark, str(tmp_path / "app"))

    def run(days, run_id):
        made = [r for day, keys in days.items() for r in bags(day, *keys)]
        have = spark.createDataFrame(made, T.StructType([*sample.SCHEMA.fields, T.StructField("_dt", T.DateType())]))
        missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW.fields if f.name not in have.columns}
        have = have.withColumns(missing).withColumn("geo", F.lit(None).cast(RAW["geo"].dataType))
        have = have.select(*RAW.names, "_dt")
        load.load_tables(app, have, have.limit(0), min(days), max(days), run_id)
        return build.flatten_days(app, min(days), max(days), run_id)

    return app, run


def counted(app):
    return {(r.key, r.first_seen, r.last_seen, r.n_seen) for r in app.registry().collect()}


def test_a_replaced_day_is_taken_back(spark, months):
    app, run = months
    run({DAYS[0]: ["a", "a"], DAYS[1]: ["a", "b"], DAYS[2]: ["a", "c"], DAYS[3]: ["b"]}, "run-1")
    assert counted(app) == {("a", DAYS[0], DAYS[2], 4), ("b", DAYS[1], DAYS[3], 2), ("c", DAYS[2], DAYS[2], 1)}
    names = {r.key: r.column_name for r in app.registry().collect()}
    done = run({DAYS[2]: ["b", "d", "d"]}, "run-2")
    assert done.new_columns == ["d_int"]
    assert counted(app) == {("a", DAYS[0], DAYS[1], 3), ("b", DAYS[1], DAYS[3], 3), ("c", DAYS[2], DAYS[2], 0),
                            ("d", DAYS[2], DAYS[2], 2)}
    run({DAYS[2]: ["b", "d", "d"]}, "run-3")
    fresh = {(r.key, r.first_seen, r.last_seen, r.n_seen) for r in registry.seen(discover.discover_keys(app.raw())).collect()}
    assert fresh == {row for row in counted(app) if row[3]}
    assert names.items() <= {r.key: r.column_name for r in app.registry().collect()}.items()


def test_a_run_opens_its_own_month(spark, months):
    app, run = months
    run({DAYS[0]: ["a"], DAYS[1]: ["a"], DAYS[2]: ["a"], DAYS[3]: ["b"]}, "run-1")
    opened = build.months_of(app, {DAYS[1]}).inputFiles()
    assert opened and all("_dt=2099-01-" in path for path in opened)
