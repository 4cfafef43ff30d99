"""The registered queries: every operator over the export-shaped test rows.

Each takes a session and a table folder and gives a DataFrame.  Sums of money are
rounded here, and only here, because the order of a float sum is not fixed.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.functions import days, params
from tidemark.operators import (
    discover, drift, flatten, marts, quality, registry, reports, retention,
)
from tidemark.operators.registry import DynamicColumn
from tidemark.plans import build, daily, load, status, upkeep
from tidemark.plans.app import App
from tidemark.schema import tables
from tidemark.shaped import canonical, events
from tidemark.sources import broken, files, folders, merged, partitions, raw

# From this day on there are only intraday rows; before the other one only final rows.
FINAL_UNTIL = date(2024, 1, 20)
INTRADAY_FROM = date(2024, 1, 11)

# The columns discovery finds, in registry order.
DYNAMIC = [
    DynamicColumn("event_params", "", "int_value", "_empty_int"),
    DynamicColumn("event_params", "7th_try", "float_value", "_7th_try_float"),
    DynamicColumn("event_params", "engagement_time_msec", "int_value", "engagement_time_msec_int"),
    DynamicColumn("event_params", "ga_session_id", "int_value", "ga_session_id_int"),
    DynamicColumn("event_params", "k", "int_value", "k_int"),
    DynamicColumn("event_params", "score", "double_value", "score_double"),
    DynamicColumn("event_params", "screen-name", "string_value", "screen_name_str"),
    DynamicColumn("event_params", "session_engaged", "int_value", "session_engaged_int"),
    DynamicColumn("user_properties", "_worth", "double_value", "_worth_double"),
    DynamicColumn("user_properties", "k", "int_value", "up_k_int"),
    DynamicColumn("user_properties", "user_id", "string_value", "up_user_id_str"),
]

QUERIES = {}


def query(fn):
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session.prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(events.loaded(spark, sf_dir), DYNAMIC, "run-1")


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    mart = next(m for m in marts.MARTS if m.name == name)
    return mart.from_flat(_flat(spark, sf_dir))


def _rounded(df: DataFrame) -> DataFrame:
    money = {"revenue_usd": 2, "ad_revenue_usd": 4}
    return df.withColumns({c: F.round(c, d) for c, d in money.items() if c in df.columns})


def _app(spark: SparkSession, name: str) -> App:
    return App(spark, session.scratch_path(spark, name))


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Final rows up to one day, intraday rows from an earlier one; both lie by day."""
    rows = events.exported(spark, sf_dir, events.dealt)
    return (
        rows.filter(F.col("_dt") <= F.lit(FINAL_UNTIL)),
        rows.filter(F.col("_dt") >= F.lit(INTRADAY_FROM)),
    )


def span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last day of the rows, the range that the jobs below work on."""
    found = events.source(spark, sf_dir).agg(F.min("_dt"), F.max("_dt")).first()
    return (found[0] or INTRADAY_FROM, found[1] or FINAL_UNTIL)


def wider(first: date, last: date) -> tuple[date, date]:
    """The range with days around it that have no rows."""
    return first - timedelta(days=2), last + timedelta(days=3)


def _loaded_app(spark: SparkSession, sf_dir: str, name: str) -> App:
    app = _app(spark, name)
    load.load_tables(app, *_sources(spark, sf_dir), *span(spark, sf_dir), "run-1", by_day=True)
    return app


def _uneven_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As ``_sources``, with days that fail or warn at a check."""
    return tuple(events.uneven(rows) for rows in _sources(spark, sf_dir))


def _lossy_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows of which some days have lost a few."""
    rows = events.loaded(spark, sf_dir).filter(f"NOT ({events.LOST})")
    return flatten.flatten(rows, DYNAMIC, "run-1")


# --- sources and sinks ------------------------------------------------------------


def _exported_files(spark: SparkSession, sf_dir: str) -> str:
    """Day folders as an export leaves them: some columns missing, one not declared."""
    root = session.scratch_path(spark, "export")
    rows = (
        events.exported(spark, sf_dir, events.dealt)
        .drop("publisher", "event_original_occurrence_timestamp")
        .withColumnRenamed("stream_id", "Stream_ID")
        .withColumn("note", F.lit("not declared"))
    )
    partitions.export_days(rows, root, rebalance=False)
    return root


@query
def raw_scan(spark, sf_dir):
    """Whole rows, nested parts as one text each."""
    rows = raw.scan(spark, f"{_exported_files(spark, sf_dir)}/dt=*")
    return rows.selectExpr(*canonical.whole_row(spark=True))


def _mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Day folders whose files disagree: numbers as text, text as numbers, also in a bag."""
    root = session.scratch_path(spark, "mixed")
    rows = events.exported(spark, sf_dir, events.dealt)
    bag = F.transform("event_params", lambda p: F.when(p.isNotNull(), F.struct(
        p["key"].alias("key"),
        F.struct(
            p["value"]["int_value"].cast("string").alias("int_value"),
            p["value"]["double_value"].cast("float").alias("double_value"),
        ).alias("value"),
    )))
    of = F.col("event_bundle_sequence_id") % 4
    for part, changed in (
        (0, rows),
        (1, rows.withColumn("event_bundle_sequence_id", F.col("event_bundle_sequence_id").cast("string"))),
        (2, rows.withColumn("stream_id", F.col("stream_id").cast("int")).withColumn("event_params", bag)),
        (3, rows.withColumn("batch_page_id", F.col("batch_page_id").cast("int")).drop("geo")),
    ):
        kept = changed.where(of == part).withColumnRenamed("_dt", "dt")
        kept.write.mode("append").partitionBy("dt").parquet(root)
    return root


@query
def mixed_type_scan(spark, sf_dir):
    """Days with files of other types, whole rows by the declared ones."""
    rows = raw.scan_days(spark, [f"{_mixed_files(spark, sf_dir)}/dt=*"])
    value = F.col("event_params")["value"]
    return rows.select(
        *[c for c in raw.RAW.names if not isinstance(raw.RAW[c].dataType, (T.ArrayType, T.StructType))],
        F.col("geo.country").alias("country"),
        F.col("device.web_info.browser").alias("browser"),
        F.array_join(F.transform(F.col("event_params")["key"], lambda k: F.coalesce(k, F.lit("?"))), "|").alias("keys"),
        F.array_join(F.transform(value["int_value"].cast("array<string>"), lambda v: F.coalesce(v, F.lit("?"))), "|").alias("ints"),
        F.array_join(F.transform(value["string_value"], lambda v: F.coalesce(v, F.lit("?"))), "|").alias("texts"),
        "_dt",
    )


@query
def broken_files(spark, sf_dir):
    """Files by day and part, some of them cut short or not Parquet at all."""
    root = session.scratch_path(spark, "broken")
    by_part = lambda rows: events.dealt(rows, F.col("_dt"), F.col("event_id") % 5, most=None)
    rows = events.exported(spark, sf_dir, by_part).withColumn("part", F.col("event_bundle_sequence_id") % 5)
    rows.write.partitionBy("_dt", "part").parquet(root)
    listed = files.parquet_files(spark, root)
    day = F.regexp_extract("path", "_dt=([^/]+)", 1).cast("date")
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint")
    number = F.dayofmonth(day)
    spoiled = listed.where((number % 3 == 1) & (part == number % 5))
    for row in spoiled.select("path").collect():  # a file a day at most
        folders.overwrite(spark, row["path"], b"PAR1 cut off")
    judged = broken.check_files(spark, listed, raw.RAW)
    return judged.select(day.alias("_dt"), part.alias("part"), "rows", "broken")


@query
def raw_defaults(spark, sf_dir):
    """Whole rows as they are stored, nested parts as one text each."""
    rows = events.loaded(spark, sf_dir, events.spread)
    return rows.selectExpr(*canonical.whole_row(spark=True), "_dt")


@query
def day_layouts(spark, sf_dir):
    """Every day lies in a plain-digit folder, the final days also in a dashed one."""
    root = session.scratch_path(spark, "layouts")
    final, _ = _sources(spark, sf_dir)
    dashed = final.withColumn("_dt", F.date_format("_dt", "yyyy-MM-dd"))
    digits = events.exported(spark, sf_dir, events.dealt).withColumn("_dt", F.date_format("_dt", "yyyyMMdd"))
    partitions.export_days(dashed.unionByName(digits), root, rebalance=False)
    found = files.day_folders(files.parquet_files(spark, root))
    # One folder per calendar day.
    folders = [r["folder"] for r in found.collect()]
    rows = raw.scan_days(spark, folders)
    return rows.groupBy(
        "_dt", F.regexp_extract("_folder", "[^/]+$", 0).alias("folder")
    ).agg(F.count("*").alias("rows"))


@query
def file_statistics(spark, sf_dir):
    listed = files.parquet_files(spark, _exported_files(spark, sf_dir))
    return files.day_statistics(listed).select(
        "_dt", "files", (F.col("bytes") > 0).alias("has_bytes")
    )


@query
def final_over_intraday(spark, sf_dir):
    chosen = raw.prefer_final(*_sources(spark, sf_dir))
    return chosen.selectExpr("_dt", "_is_intraday", *canonical.whole_row(spark=True))


@query
def raw_load(spark, sf_dir):
    chosen = raw.prefer_final(*_sources(spark, sf_dir))
    stored = raw.load_columns(chosen, "run-1", "events", F.col("_is_intraday"))
    return stored.selectExpr(
        *canonical.whole_row(spark=True), "_ingested_at IS NOT NULL AS has_ingested_at",
        "_dt", "_run_id", "_source_table", "_is_intraday",
    )


@query
def replace_days(spark, sf_dir):
    """All days, then the later ones again with a second run; no day is duplicated."""
    app = _app(spark, "replace")
    final, intraday = _sources(spark, sf_dir)
    first, last = span(spark, sf_dir)
    load.load_tables(app, final, intraday, first, last, "run-1", by_day=True)
    load.load_tables(app, final, intraday, INTRADAY_FROM, max(last, INTRADAY_FROM), "run-2", by_day=True)
    return app.raw().groupBy("_dt", "_run_id").agg(F.count("*").alias("rows"))


@query
def snapshot_export(spark, sf_dir):
    root = session.scratch_path(spark, "snapshot")
    rows = events.exported(spark, sf_dir, events.spread)
    for _ in range(2):
        target = partitions.export_snapshot(rows, root, FINAL_UNTIL)
    return raw.scan(spark, target).selectExpr(*canonical.whole_row(spark=True))


@query
def run_log(spark, sf_dir):
    app = _app(spark, "log")
    load.load_tables(app, *_sources(spark, sf_dir), *wider(*span(spark, sf_dir)), "run-1", by_day=True)
    return app.log().select(
        "event_date", "source_table", "is_intraday", "strategy", "source_row_count",
        "files_read", "rows_inserted", "run_id", "status", "error_message",
    )


@query
def load_existing_files(spark, sf_dir):
    app = _app(spark, "files")
    first, last = span(spark, sf_dir)
    load.load_files(app, _exported_files(spark, sf_dir), first, wider(first, last)[1], "run-1")
    counted = app.raw().groupBy("_dt", "_is_intraday").agg(F.count("*").alias("rows"))
    return app.log().join(counted, F.col("event_date") == F.col("_dt"), "left").select(
        "event_date", "is_intraday", "_is_intraday", "rows", "rows_inserted", "status",
        "files_read", (F.col("bytes_read") > 0).alias("has_bytes"),
    )


@query
def ttl_survivors(spark, sf_dir):
    kept = reports.survivors(events.loaded(spark, sf_dir), 15, "2024-01-25")
    return kept.select("_dt", "event_timestamp", "event_name", "user_pseudo_id")


@query
def expired_days(spark, sf_dir):
    app = _loaded_app(spark, sf_dir, "expire")
    upkeep.expire(app, 15, "2024-01-25")
    return quality.day_counts(app.raw(), "rows")


@query
def compacted_storage(spark, sf_dir):
    app = _loaded_app(spark, sf_dir, "compact")
    upkeep.compact_last_week(app, span(spark, sf_dir)[1] + timedelta(days=1))
    report = upkeep.storage_report(app)
    return report.select(
        "_dt", "rows", "files", (F.col("bytes") > 0).alias("has_bytes"), "too_many_files"
    )


@query
def storage_total(spark, sf_dir):
    total = upkeep.storage_total(_loaded_app(spark, sf_dir, "storage"))
    return total.select("files", "rows", (F.col("bytes") > 0).alias("has_bytes"), "too_large")


@query
def range_status(spark, sf_dir):
    rows = events.loaded(spark, sf_dir)
    checked = quality.reconcile_flat(
        quality.day_counts(rows, "raw_rows"),
        quality.day_counts(_lossy_flat(spark, sf_dir), "flat_rows"),
    )
    return status.range_status(spark, *wider(*span(spark, sf_dir)), checked)


# --- projections, filters, lookups ------------------------------------------------


@query
def flat_base(spark, sf_dir):
    return flatten.base_columns(events.loaded(spark, sf_dir))


@query
def event_date_fallback(spark, sf_dir):
    return events.loaded(spark, sf_dir).select(
        "event_timestamp", "event_date", "_dt",
        days.event_day(F.col("event_date"), F.col("_dt")).alias("day"),
    )


@query
def event_date_d(spark, sf_dir):
    rows = raw.with_computed_day(events.loaded(spark, sf_dir))
    return rows.select("event_timestamp", "event_date", "event_date_d")


@query
def event_ts(spark, sf_dir):
    rows = events.loaded(spark, sf_dir)
    return rows.select("event_timestamp", F.timestamp_micros("event_timestamp").alias("event_ts"))


@query
def flat_dynamic(spark, sf_dir):
    return _flat(spark, sf_dir).select("_dt", "event_timestamp", *[c.name for c in DYNAMIC])


@query
def param_lookup(spark, sf_dir):
    bag = F.col("event_params")
    return events.loaded(spark, sf_dir).select(
        "event_timestamp",
        params.value(bag, "ga_session_id", "int_value").alias("ga_session_id"),
        params.value(bag, "screen-name", "string_value").alias("screen_name"),
    )


@query
def user_prop_lookup(spark, sf_dir):
    bag = F.col("user_properties")
    return events.loaded(spark, sf_dir).select(
        "event_timestamp", "user_pseudo_id",
        params.value(bag, "_worth", "double_value").alias("ltv"),
        params.value(bag, "_worth", "set_timestamp_micros").alias("ltv_set"),
    )


@query
def param_exists(spark, sf_dir):
    rows = events.loaded(spark, sf_dir)
    return rows.filter(params.has_key(F.col("event_params"), "7th_try")).groupBy("_dt").agg(
        F.count("*").alias("n")
    )


@query
def param_keys(spark, sf_dir):
    rows = events.loaded(spark, sf_dir).filter("event_name = 'send_prompt'")
    return rows.select(
        "event_timestamp", F.array_join(params.keys(F.col("event_params")), "|").alias("keys")
    )


@query
def param_count(spark, sf_dir):
    n = params.count(F.col("event_params"))
    return events.loaded(spark, sf_dir).select(
        "event_timestamp", n.alias("n_params"), (n == 0).alias("is_empty")
    )


@query
def kpi_missing_dynamic(spark, sf_dir):
    return _rounded(marts.MARTS[0].from_flat(flatten.base_columns(events.loaded(spark, sf_dir))))


@query
def peek_day(spark, sf_dir):
    """The whole first row of a day, by time and number."""
    order = ["event_timestamp", "event_bundle_sequence_id"]
    return reports.peek(_flat(spark, sf_dir), "2024-01-15", order).drop("_ingested_at")


@query
def local_day(spark, sf_dir):
    moment = F.timestamp_micros("event_timestamp")
    rows = events.loaded(spark, sf_dir).select(
        days.local_day(moment, "Asia/Ho_Chi_Minh").alias("local_day")
    )
    return rows.groupBy("local_day").agg(F.count("*").alias("n"))


@query
def kpi_trend(spark, sf_dir):
    return _rounded(reports.kpi_trend(_mart(spark, sf_dir, "mart_daily_kpi")))


@query
def flat_selection(spark, sf_dir):
    return _flat(spark, sf_dir).filter(F.col("_dt") == F.lit(date(2024, 1, 15))).select(
        "event_date", "event_name", "ga_session_id_int", "screen_name_str", "geo_country"
    )


# --- unnesting and aggregation ----------------------------------------------------


@query
def discover_keys(spark, sf_dir):
    return discover.discover_keys(events.loaded(spark, sf_dir))


@query
def explore_event_params(spark, sf_dir):
    return discover.profile_event_params(events.loaded(spark, sf_dir))


@query
def explore_user_props(spark, sf_dir):
    return discover.profile_user_properties(events.loaded(spark, sf_dir))


@query
def mart_daily_kpi(spark, sf_dir):
    return _rounded(_mart(spark, sf_dir, "mart_daily_kpi"))


@query
def mart_daily_events(spark, sf_dir):
    return _mart(spark, sf_dir, "mart_daily_events")


@query
def mart_daily_geo(spark, sf_dir):
    return _rounded(_mart(spark, sf_dir, "mart_daily_geo"))


@query
def mart_user_daily(spark, sf_dir):
    return _rounded(_mart(spark, sf_dir, "mart_user_daily"))


@query
def event_counts(spark, sf_dir):
    return reports.event_counts(events.loaded(spark, sf_dir))


@query
def partition_counts(spark, sf_dir):
    return quality.day_counts(events.loaded(spark, sf_dir), "rows")


@query
def mart_retention(spark, sf_dir):
    return retention.retention(_mart(spark, sf_dir, "mart_user_daily"))


@query
def retention_pct(spark, sf_dir):
    return retention.retention_percent(
        retention.retention(_mart(spark, sf_dir, "mart_user_daily"))
    )


# --- quality ----------------------------------------------------------------------


@query
def qc_metrics(spark, sf_dir):
    return quality.metrics(events.broken(spark, sf_dir))


@query
def qc_verdicts(spark, sf_dir):
    return quality.verdicts(quality.metrics(events.broken(spark, sf_dir)))


@query
def qc_nested(spark, sf_dir):
    return quality.nested_readable(events.broken(spark, sf_dir))


@query
def row_reconcile(spark, sf_dir):
    """Rows per day against those of a load that lost some, later days as intraday."""
    rows = events.loaded(spark, sf_dir)
    return quality.reconcile_source(
        quality.day_counts(rows, "source_rows"),
        quality.day_counts(rows.filter(f"NOT ({events.LOST})"), "loaded_rows"),
        F.col("_dt") > F.lit(FINAL_UNTIL),
    )


@query
def flat_reconcile(spark, sf_dir):
    return quality.reconcile_flat(
        quality.day_counts(events.loaded(spark, sf_dir), "raw_rows"),
        quality.day_counts(_lossy_flat(spark, sf_dir), "flat_rows"),
    )


@query
def content_reconcile(spark, sf_dir):
    """Whole rows of two tables day by day: the same in another order, altered, or lost."""
    rows = events.loaded(spark, sf_dir)
    moved = events.loaded(spark, sf_dir, lambda source: source.repartition("micros"))
    day, number = F.dayofmonth("_dt"), F.col("event_bundle_sequence_id")
    entry = F.struct(F.lit("k").alias("key"), F.get("event_params", F.lit(0))["value"].alias("value"))
    other = moved.withColumns({
        "platform": F.when((day % 5 == 1) & (number % 7 == 0), F.lit("WEB")).otherwise(F.col("platform")),
        "event_params": F.when(
            (day % 5 == 2) & (number % 97 == 0), F.array(entry)
        ).otherwise(F.col("event_params")),
    }).filter(f"NOT ({events.LOST})")
    return quality.reconcile_content(quality.fingerprints(rows), quality.fingerprints(other))


@query
def mart_reconcile(spark, sf_dir):
    return quality.reconcile_marts(
        quality.day_counts(_flat(spark, sf_dir), "flat_rows"),
        next(m for m in marts.MARTS if m.name == "mart_daily_events").from_flat(
            _lossy_flat(spark, sf_dir)
        ),
    )


# --- registry and schema evolution ------------------------------------------------


def _daily_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's findings as if appended to the registry on that day."""
    return discover.discover_keys(events.loaded(spark, sf_dir)).select(
        "source", "key", "sub_field",
        F.concat_ws("/", "source", "key").alias("column_name"),
        F.lit("any").alias("column_type"),
        F.col("_dt").alias("first_seen"), F.col("_dt").alias("last_seen"),
        F.col("n").alias("n_seen"), F.col("_dt").cast("timestamp").alias("updated_at"),
    )


@query
def registry_latest(spark, sf_dir):
    return registry.latest(_daily_registry(spark, sf_dir)).drop("updated_at")


@query
def registry_merged(spark, sf_dir):
    """Each day's findings appended by a run of its own, with merges in between."""
    path = session.scratch_path(spark, "registry")
    rows = session.stored(_daily_registry(spark, sf_dir), session.scratch_path(spark, "found"))
    first, last = span(spark, sf_dir)
    for day in status.span(first, last):
        found = rows.where(F.col("first_seen") == F.lit(day))
        merged.append(found, path, registry.latest, most=4)
    return registry.latest(merged.read(spark, path, tables.REGISTRY)).drop("updated_at")


@query
def registry_replaced(spark, sf_dir):
    """The registry's counts after all days, and after some of them again with fewer rows."""
    app = _loaded_app(spark, sf_dir, "replaced")
    first, last = span(spark, sf_dir)
    build.flatten_days(app, first, last, "run-1")
    fewer = [rows.filter(f"NOT ({events.LOST})") for rows in _sources(spark, sf_dir)]
    load.load_tables(app, *fewer, INTRADAY_FROM, max(last, INTRADAY_FROM), "run-2", by_day=True)
    build.flatten_days(app, INTRADAY_FROM, max(last, INTRADAY_FROM), "run-2")
    return app.registry().drop("updated_at")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered keys, kept as a table like the per-day counts of an app."""
    found = discover.discover_keys(events.loaded(spark, sf_dir))
    return session.stored(found, session.scratch_path(spark, "found"))


@query
def registry_upsert(spark, sf_dir):
    found = _found(spark, sf_dir)
    earlier = found.filter(F.col("_dt") <= F.lit(FINAL_UNTIL))
    later = found.filter(F.col("_dt") > F.lit(FINAL_UNTIL))
    known = registry.upsert(registry.empty(spark), earlier)
    known = session.stored(known, session.scratch_path(spark, "registry"))
    return registry.upsert(known, later)


@query
def registry_rebuild(spark, sf_dir):
    return registry.from_counts(registry.empty(spark), _found(spark, sf_dir))


@query
def column_names(spark, sf_dir):
    """Names for keys that meet after clean-up, met by keys of the other bag."""
    source = events.source(spark, sf_dir)
    made = [
        ("event_params", "concat(event_type, '-', CAST(k % 7 AS STRING))"),
        ("event_params", "concat(event_type, '.', CAST(k % 5 AS STRING))"),
        ("event_params", "concat(event_type, '_', CAST(k % 3 AS STRING))"),
        ("event_params", "concat(event_type, ' ', CAST(k % 4 AS STRING))"),
        ("user_properties", "concat(event_type, '_', CAST(k % 6 AS STRING))"),
        ("user_properties", "concat(event_type, '~', CAST(k % 2 AS STRING))"),
    ]
    triples = source.select(
        F.explode(F.array(*[
            F.struct(F.lit(s).alias("source"), F.expr(k).alias("key")) for s, k in made
        ])).alias("t")
    ).select("t.*", F.lit("int_value").alias("sub_field")).distinct()
    taken = spark.range(1).select(F.lit("click_0_int").alias("column_name"))
    return registry.name_columns(triples, taken)


@query
def added_columns(spark, sf_dir):
    rows = registry_rebuild(spark, sf_dir)
    return registry.added_columns(rows, rows.filter("source = 'event_params'"))


@query
def column_coverage(spark, sf_dir):
    return drift.column_coverage(events.exported(spark, sf_dir))


@query
def schema_drift(spark, sf_dir):
    """Days exported alike, without a column, and with a column of another type."""
    root = session.scratch_path(spark, "drift")
    rows = events.exported(spark, sf_dir, events.dealt).withColumn("note", F.lit("not declared"))
    text = F.col("event_bundle_sequence_id").cast("string")
    day = F.dayofmonth("_dt") % 3
    partitions.export_days(rows.filter(day == 0), root, rebalance=False)
    partitions.export_days(rows.filter(day == 1).drop("publisher"), root, rebalance=False)
    partitions.export_days(rows.filter(day == 2).withColumn("event_bundle_sequence_id", text), root, rebalance=False)
    return drift.schema_drift(spark, root, *span(spark, sf_dir))


@query
def flatten_days(spark, sf_dir):
    """Load, discover, name and flatten; the columns are the ones found."""
    app = _loaded_app(spark, sf_dir, "flatten")
    build.flatten_days(app, *span(spark, sf_dir), "run-1")
    return app.flat().select(
        "_dt", "event_date", "event_timestamp", "event_ts", "event_name", "user_pseudo_id",
        "platform", "geo_country", "app_info_version", "device_web_browser",
        "stlc_dv360_partner_name", *[c.name for c in app.columns()], "_run_id",
    )


@query
def daily_run(spark, sf_dir):
    """Source tables, some days bad, to stored marts; the KPI mart as it was stored."""
    app = _app(spark, "daily")
    daily.try_days(app, *_uneven_sources(spark, sf_dir), *span(spark, sf_dir), "run-1", by_day=True)
    return _rounded(app.mart("mart_daily_kpi").drop("_built_at"))


@query
def daily_log(spark, sf_dir):
    """How each day of such a run ended, and what it warns of."""
    app = _app(spark, "daily")
    daily.try_days(app, *_uneven_sources(spark, sf_dir), *wider(*span(spark, sf_dir)), "run-1", by_day=True)
    return app.daily_log().drop("started_at", "finished_at")


@query
def stored_retention(spark, sf_dir):
    """The retention view over the stored per-user mart."""
    app = _loaded_app(spark, sf_dir, "retention")
    build.flatten_days(app, *span(spark, sf_dir), "run-1")
    build.build_marts(app, *span(spark, sf_dir), "run-1")
    return app.retention()


@query
def retention_incremental(spark, sf_dir):
    """The retention view from the kept day sets, after some days were replaced."""
    app = _loaded_app(spark, sf_dir, "day_sets")
    first, last = span(spark, sf_dir)
    build.flatten_days(app, first, last, "run-1")
    build.build_marts(app, first, last, "run-1")
    fewer = [rows.filter(f"NOT ({events.LOST})") for rows in _sources(spark, sf_dir)]
    again = (INTRADAY_FROM, max(last, INTRADAY_FROM))
    load.load_tables(app, *fewer, *again, "run-2", by_day=True)
    build.flatten_days(app, *again, "run-2")
    build.build_marts(app, *again, "run-2")
    return app.retention()
