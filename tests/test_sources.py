from __future__ import annotations

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidemark.shaped import events as shaped_events
from tidemark.shaped import queries
from tidemark.sources import broken, files, folders, footers, partitions, raw

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def days_frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v int, _dt date")


def stored(spark, table):
    return sorted(tuple(r) for r in spark.read.parquet(table).select("v", "_dt").collect())


def test_replacing_a_day_with_nothing_empties_it(spark, tmp_path):
    table = str(tmp_path / "t")
    partitions.replace_days(days_frame(spark, (1, D1), (2, D2), (3, D3)), table, {D1, D2, D3})
    written = partitions.replace_days(days_frame(spark, (20, D2)), table, {D2, D3})
    assert written == {D2}
    assert stored(spark, table) == [(1, D1), (20, D2)]
    assert folders.stored_days(spark, table) == [D1, D2]


def test_rows_outside_the_days_are_not_written(spark, tmp_path):
    table = str(tmp_path / "t")
    partitions.replace_days(days_frame(spark, (1, D1), (2, D2)), table, {D2})
    assert stored(spark, table) == [(2, D2)]


def test_stored_files_are_compressed_and_sorted(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = days_frame(spark, (3, D1), (1, D1), (2, D1)).coalesce(1)
    partitions.replace_days(rows, table, {D1}, ["v"])
    (path,) = glob.glob(f"{table}/_dt=2024-01-01/*.parquet")
    assert "zstd" in path
    assert [r.v for r in spark.read.parquet(path).collect()] == [1, 2, 3]


@pytest.mark.parametrize("folder", ["dt=2099-01-01", "2099-01-01", "dt=20990101", "20990101"])
def test_every_day_layout_is_found(spark, tmp_path, folder):
    root = str(tmp_path / "export")
    sample.write_day(spark, sample.first_rows(), root, folder)
    (found,) = files.day_folders(files.parquet_files(spark, root)).collect()
    assert found["_dt"] == date(2099, 1, 1) and found["folder"].endswith("/" + folder)
    assert found["files"] == 1 and found["bytes"] > 0
    rows = raw.scan_days(spark, [found["folder"]])
    assert rows.groupBy("_dt").count().collect() == [(date(2099, 1, 1), 3)]


def test_the_first_layout_wins(spark, tmp_path):
    root = str(tmp_path / "export")
    for folder in ("20990101", "2099-01-01", "dt=20990101"):
        sample.write_day(spark, sample.first_rows(), root, folder)
    (found,) = files.day_folders(files.parquet_files(spark, root)).collect()
    assert found["folder"].endswith("/2099-01-01")


def test_nothing_found_gives_no_row(spark, tmp_path):
    assert files.day_folders(files.parquet_files(spark, str(tmp_path / "none"))).count() == 0


def test_export_clears_the_older_snapshot(spark, tmp_path):
    root = str(tmp_path)
    partitions.export_snapshot(days_frame(spark, (1, D1), (2, D1)), root, D1)
    target = partitions.export_snapshot(days_frame(spark, (3, D1)), root, D1)
    assert stored(spark, target) == [(3, D1)]
    assert all("snappy" in p for p in glob.glob(f"{target}/*.parquet"))


def test_scan_matches_names_whatever_their_case(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).select(
        F.lit("x").alias("EVENT_NAME"), F.lit(5).alias("Event_Timestamp"), F.lit(1).alias("other")
    ).write.parquet(path)
    row = raw.scan(spark, path).first()
    assert (row.event_name, row.event_timestamp, row.geo) == ("x", 5, None)


@pytest.mark.parametrize("final, intraday, want", [
    (True, True, [("final", 0)]), (True, False, [("final", 0)]),
    (False, True, [("intraday", 1)]), (False, False, []),
])
def test_final_wins_over_intraday(spark, final, intraday, want):
    def side(name, there):
        return spark.createDataFrame([(name, D1)] if there else [], "name string, _dt date")

    got = raw.prefer_final(side("final", final), side("intraday", intraday)).collect()
    assert [(r["name"], r._is_intraday) for r in got] == want


def write_files(spark, folder, types):
    """One file for each type of the column ``n``, two rows each."""
    for at, kind in enumerate(types):
        rows = spark.createDataFrame([(f"e{at}", str(2 * at)), (f"e{at}", str(2 * at + 1))], "event_name string, n string")
        one = rows.select("event_name", F.col("n").cast(kind).alias("event_timestamp"))
        one.coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("odd", [0, 1, 3])
def test_odd_files_are_found_by_halving(spark, tmp_path, monkeypatch, odd):
    """Few files of another type among n take about log n merges each, a sound list takes one."""
    n, folder = 32, str(tmp_path / "day")
    kinds = ["bigint"] * n
    for at in range(odd):
        kinds[at * 11] = "string"
    write_files(spark, folder, kinds)
    calls, merge = [], footers.merged_schema
    monkeypatch.setattr(footers, "merged_schema", lambda *how: calls.append(1) or merge(*how))
    found = footers.schema_groups(spark, [folder])
    assert len(found) == (2 if odd else 1)
    assert len(calls) <= 1 + odd * 2 * 6
    if odd:
        assert sorted(len(paths) for _, paths in found) == [odd, n - odd]
    rows = raw.scan(spark, folder)
    assert sorted(r[0] for r in rows.select("event_timestamp").collect()) == list(range(2 * n))


def test_sound_files_are_one_scan(spark, tmp_path):
    folder = str(tmp_path / "day")
    write_files(spark, folder, ["bigint", "bigint"])
    plan = raw.scan(spark, folder)._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert plan.count("FileScan") == 1 and "cast" not in plan


def test_a_value_that_cannot_be_cast_breaks_the_scan(spark, tmp_path):
    folder = str(tmp_path / "day")
    write_files(spark, folder, ["bigint"])
    bad = spark.createDataFrame([("e", "soon")], "event_name string, event_timestamp string")
    bad.coalesce(1).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw.scan(spark, folder).collect()
    nested = spark.createDataFrame([("e", "x")], "event_name string, event_params string")
    nested.coalesce(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="event_params"):
        raw.scan(spark, str(tmp_path / "other"))


def spoil(path, at, length):
    from pathlib import Path

    path = Path(path)
    data = bytearray(path.read_bytes())
    data[at : at + length] = b"\xff" * length
    path.write_bytes(bytes(data))
    crc = path.with_name(f".{path.name}.crc")
    if crc.exists():
        crc.unlink()


def test_broken_files_by_name(spark, tmp_path):
    """No Parquet at all, a footer cut off, and pages overwritten; an empty file is sound."""
    folder = str(tmp_path / "a day")
    write_files(spark, folder, ["bigint"] * 5 + ["string"])
    spark.createDataFrame([], "event_name string").coalesce(1).write.mode("append").parquet(folder)
    paths = sorted(glob.glob(f"{folder}/*.parquet"))
    empty = next(p for p in paths if spark.read.parquet(p).count() == 0)
    full = [p for p in paths if p != empty]
    folders.overwrite(spark, full[0], b"not parquet")
    spoil(full[1], 4, 40)
    folders.overwrite(spark, full[2], open(full[2], "rb").read()[:-30])
    judged = broken.check_files(spark, files.parquet_files(spark, folder), raw.RAW).collect()
    assert {r.path.removeprefix("file:") for r in judged if r.broken} == set(full[:3])
    assert {r.path.removeprefix("file:"): r.rows for r in judged if not r.broken} == {**{p: 2 for p in full[3:]}, empty: 0}
    assert broken.check_files(spark, files.parquet_files(spark, str(tmp_path / "none")), raw.RAW).count() == 0


def test_rows_dealt_by_day(spark):
    """A large day is parted, small ones and missing ones stay whole, and no row is lost."""
    sizes = {"2024-01-01": 3000, "2024-01-02": 40, "2024-01-03": 30, None: 20}
    rows = [(i, d) for d, n in sizes.items() for i in range(n)]
    table = spark.createDataFrame(rows, "event_id long, day string").selectExpr("event_id", "CAST(day AS DATE) AS _dt")
    tasks = shaped_events.dealt(table, most=500).rdd.glom().collect()
    got = [[(r.event_id, None if r._dt is None else str(r._dt)) for r in task] for task in tasks]
    assert sorted((r for task in got for r in task), key=str) == sorted(rows, key=str)
    assert max(map(len, got)) < 700
    where = {d: {k for k, task in enumerate(got) if any(r[1] == d for r in task)} for d in sizes}
    assert len(where["2024-01-01"]) == 6
    assert all(len(where[d]) == 1 for d in ("2024-01-02", "2024-01-03", None))
    assert shaped_events.dealt(table.limit(0)).count() == 0


def test_listing_keeps_the_files_of_a_job_together(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / f"dt={day}").mkdir()
        for job in ("aaaa", "bbbb"):
            for task in range(2):
                (tmp_path / f"dt={day}" / f"part-0000{task}-{job}.c000.snappy.parquet").write_bytes(b"x")
    jobs = [path.split("-")[-1][:4] for path in footers._listed(spark, [str(tmp_path)])]
    assert jobs == ["aaaa"] * 4 + ["bbbb"] * 4


def test_a_day_of_ordinary_size_is_one_file(spark, tmp_path):
    """However many tasks read the rows, and however few bytes the session puts in a partition."""
    path = str(tmp_path / "events.parquet")
    spark.sql(
        "SELECT id AS event_id, timestamp_seconds(1704067200 + id % 3 * 86400 + id) AS ts, id % 90 AS user_id, "
        "'view' AS event_type, CAST(id AS DOUBLE) AS value, concat('{\"k\": ', id % 9, '}') AS props FROM range(3000)"
    ).repartition(8).write.parquet(path)
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.files.openCostInBytes": "100m"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        got = [r["files"] for r in queries.QUERIES["file_statistics"](spark, str(tmp_path)).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == [1, 1, 1]


def test_rows_spread_over_all_cores(spark, tmp_path):
    """A file of one row group is read by one task, but its rows are made whole by all."""
    table = spark.range(4000).withColumnRenamed("id", "event_id").coalesce(1)
    got = shaped_events.spread(table).rdd.glom().map(len).collect()
    assert sum(got) == 4000 and len(got) == spark.sparkContext.defaultParallelism
    assert max(got) <= 4000 // len(got) + 1
    assert shaped_events.spread(table.limit(0)).count() == 0


def test_few_files_in_a_task_that_writes_days(spark, tmp_path, monkeypatch):
    """Rows that are sorted and written by the tasks that read them come from few files each."""
    table, copy = str(tmp_path / "days"), str(tmp_path / "copy")
    rows = spark.range(4000).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 4 AS INT)) AS _dt")
    days = partitions.replace_days(rows, table, {date(2024, 1, d) for d in range(1, 5)})
    sizes = [r["length"] for r in files.parquet_files(spark, table).collect()]
    monkeypatch.setattr(partitions, "TASK_BYTES", max(sizes))
    names = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0",
             "spark.sql.files.maxPartitionBytes": "1MB"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        read = partitions.read_days(spark, table, rows.schema).withColumn("task", F.spark_partition_id())
        assert partitions.replace_days(read, copy, days, ["id"], rebalance=False) == days
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1MB"
        got = spark.read.parquet(copy)
        assert got.count() == 4000 and got.select("task").distinct().count() == 4
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
