"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, difference
from tidemark.shaped import oracle
from tidemark.shaped.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


SQL = oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_days_around_the_month_are_not_left_out(spark, tmp_path):
    """Jobs work on the range that the rows have, whatever it is."""
    rows = spark.read.parquet(f"{SF}/events.parquet").limit(6)
    shifts = [F.expr(f"ts - INTERVAL {n} DAYS") for n in (0, 60, -60)]
    for shift in shifts:
        rows.withColumn("ts", shift).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    for name in ("replace_days", "expired_days", "run_log", "daily_log"):
        got = QUERIES[name](spark, str(tmp_path)).toPandas()
        assert difference(got, con.execute(SQL[name]).df()) is None, name


@pytest.mark.parametrize("name,column", [
    ("qc_verdicts", "user_verdict"), ("qc_verdicts", "params_verdict"),
    ("qc_verdicts", "names_verdict"), ("qc_nested", "nested_readable"),
    ("row_reconcile", "verdict"), ("flat_reconcile", "verdict"), ("mart_reconcile", "verdict"),
    ("range_status", "status"), ("daily_log", "status"), ("daily_log", "warnings"),
])
def test_verdicts_differ_between_days(name, column):
    rows = connect("/root/testdata/sf0.01").execute(SQL[name]).df()
    assert rows[column].nunique() >= 2


def test_entry(spark):
    assert entry.entry(spark).count() == 30


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(SQL[name]).df()
    assert difference(got, want) is None
