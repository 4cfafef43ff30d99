"""Time the headline operators on stored tables; prints one JSON line.

The export-shaped rows of ``$BENCH_SF_DIR`` are first loaded, flattened and built into
marts with the range jobs, once.  Each operator is then timed on the stored tables,
with the rows thrown away, as the better of two runs.  ``naive`` has the plain forms of
the same results: one array search per column, and exact distinct counts left to Spark.
Two cases are ten times as large: flattening into 300 discovered columns, and the KPI mart.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import discover, flatten, marts, quality, reports, retention
from tidemark.operators.registry import DynamicColumn
from tidemark.plans import build, load
from tidemark.plans.app import App
from tidemark.shaped import events
from tidemark.shaped.queries import span

RUNS = 2
KPI_INPUT = (
    "_dt", "user_pseudo_id", "event_name", "ga_session_id_int", "session_engaged_int",
    "engagement_time_msec_int", "event_value_in_usd", "publisher_ad_revenue_in_usd",
    "platform", "geo_country", "app_info_version", "event_timestamp", "event_ts",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job, runs: int = RUNS) -> float:
    best = float("inf")
    for _ in range(runs):
        started = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def naive_flatten(raw: DataFrame, dynamic) -> DataFrame:
    """One search of the whole bag per column."""
    return flatten.base_columns(raw, "event_params", "user_properties").select(
        "*", *[
            F.get(F.filter(F.col(c.source), lambda p: p["key"] == c.key), F.lit(0))["value"][
                c.sub_field].alias(c.name)
            for c in dynamic
        ]
    ).drop("event_params", "user_properties")


def naive_kpi(flat: DataFrame) -> DataFrame:
    """All distinct counts in one aggregation over events."""
    user, session_id, name = F.col("user_pseudo_id"), F.col("ga_session_id_int"), F.col("event_name")
    pair = F.struct(user, session_id)

    def users(event: str):
        return F.count_distinct(F.when(name == event, user))

    def times(event: str):
        return F.count_if(name == event)

    return flat.groupBy("_dt").agg(
        F.count_distinct(user), users("first_open"),
        F.count_distinct(F.when(session_id.isNotNull(), pair)),
        F.count_distinct(F.when(F.col("session_engaged_int") == 1, pair)),
        F.sum(F.coalesce("engagement_time_msec_int", F.lit(0))), F.count("*"),
        times("send_prompt"), users("send_prompt"), times("prompt_result"), times("chat_start"),
        times("paywall_view"), users("paywall_view"),
        times("in_app_purchase"), users("in_app_purchase"),
        F.sum(F.when(name == "in_app_purchase", F.coalesce("event_value_in_usd", F.lit(0.0)))),
        F.sum(F.coalesce("publisher_ad_revenue_in_usd", F.lit(0.0))), users("app_remove"),
    )


def wide_rows(rows: DataFrame, copies: int = 10, keys: int = 300, entries: int = 25) -> DataFrame:
    """``rows`` several times over, with bags of some of very many keys."""
    kind = rows.schema["event_params"].dataType.simpleString()
    key = f"concat('key_', CAST((event_timestamp DIV 1000 + copy * 7 + i * 13) % {keys} AS STRING))"
    value = "named_struct('string_value', NULL, 'int_value', i, 'float_value', NULL, 'double_value', NULL)"
    bag = f"transform(sequence(1, {entries}), i -> named_struct('key', {key}, 'value', {value}))"
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return many.withColumn("event_params", F.expr(f"CAST({bag} AS {kind})")).drop("copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session.prepare(session.local(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    app = App(spark, session.scratch_path(spark, "bench"))
    # The input, as day folders of files; made beforehand and not timed.
    source = session.scratch_path(spark, "source")
    rows = events.exported(spark, sf_dir)
    rows.repartition(8, "_dt").write.partitionBy("_dt").parquet(source)
    exported = spark.read.schema(rows.schema).parquet(source)
    none = exported.limit(0)

    first, last = span(spark, sf_dir)
    times = {}
    times["load_raw"] = timed(lambda: load.load_tables(app, exported, none, first, last, "r"), 1)
    times["flatten_days"] = timed(lambda: build.flatten_days(app, first, last, "r"), 1)
    times["build_marts"] = timed(lambda: build.build_marts(app, first, last, "r"), 1)

    raw, flat, columns = app.raw(), app.flat(), app.columns()
    users = app.mart("mart_user_daily")
    operators = {
        "discover_keys": discover.discover_keys(raw),
        "explore_event_params": discover.profile_event_params(raw),
        "flatten": flatten.flatten(raw, columns, "r"),
        **{mart.name: mart.from_flat(flat) for mart in marts.MARTS},
        "mart_retention": retention.retention(users),
        "qc_metrics": quality.metrics(raw),
        "event_counts": reports.event_counts(raw),
    }
    for name, df in operators.items():
        times[name] = timed(lambda: consume(df))
    naive = {
        "flatten": timed(lambda: consume(naive_flatten(raw, columns))),
        "mart_daily_kpi": timed(lambda: consume(naive_kpi(flat))),
    }
    wide = wide_rows(raw)
    at = session.scratch_path(spark, "wide")
    wide.repartition(int(os.environ.get("BENCH_CPUS", "8"))).write.parquet(at)
    wide = spark.read.schema(wide.schema).parquet(at)
    many = [
        DynamicColumn("event_params", f"key_{k}", "int_value", f"key_{k}_int") for k in range(300)
    ]
    times["flatten_wide"] = timed(lambda: consume(flatten.flatten(wide, many, "r")), 1)
    naive["flatten_wide"] = timed(lambda: consume(naive_flatten(wide, many)), 1)
    # Ten times the flat rows, by ten times the users.
    copies = flat.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).withColumn(
        "user_pseudo_id", F.concat("user_pseudo_id", F.lit("-"), F.col("copy").cast("string"))
    ).select(*KPI_INPUT)
    at = session.scratch_path(spark, "large")
    copies.write.parquet(at)
    large = spark.read.schema(copies.schema).parquet(at)
    times["mart_daily_kpi_large"] = timed(lambda: consume(marts.MARTS[0].from_flat(large)))
    naive["mart_daily_kpi_large"] = timed(lambda: consume(naive_kpi(large)))
    print(json.dumps({
        "metric": "total_best_of_runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "naive": naive,
        "rows": raw.count(),
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    sys.stdout.flush()
    session.clear_scratch(spark)


if __name__ == "__main__":
    main()
