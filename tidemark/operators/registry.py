"""The registry of discovered flat columns: (source, key, sub_field) -> column name.

The registry is append-only; the newest row of a triple counts.  A name, once
given, stays: later runs only move the dates and counts.  Counts are kept per day and
summed per month, so a run that replaces days sums their months again and no others.

Every registry row is a column of the flat table, so the registry is as small as a
table is wide.  That is the bound on what ``columns`` brings to the driver, where
the names are needed to write down the flat projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.schema.flat import BASE, METADATA, SOURCES, SUB_FIELDS, reserved_names

TRIPLE = ["source", "key", "sub_field"]


def latest(registry: DataFrame) -> DataFrame:
    """The newest row of every triple."""
    newest = F.max_by(
        F.struct(*[c for c in registry.columns if c not in TRIPLE]),
        F.struct("updated_at", "last_seen", "n_seen"),
    )
    return registry.groupBy(*TRIPLE).agg(newest.alias("row")).select(*TRIPLE, "row.*")


def _literal_map(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])[key]


def stem(source: Column, key: Column) -> Column:
    """A key as a safe identifier: foreign characters to ``_``, no leading digit."""
    clean = F.regexp_replace(key, "[^0-9A-Za-z_]", "_")
    clean = F.when(clean == "", F.lit("_empty")).otherwise(clean)
    clean = F.when(clean.rlike("^[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)
    is_user_id = (source == "user_properties") & (key == "user_id")
    return F.when(is_user_id, F.lit("up_user_id")).otherwise(clean)


_NUMBERED = "^(.*[^0-9])([1-9][0-9]{0,8})$"


def _ranked(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Numbered names: of the rows (prefixed, at) that share a prefixed name, in order, the k-th
    gets the k-th number from 2 up that no taken name has.

    The i-th taken number t of a name has t - i - 1 free ones before it; so the k-th row's number
    is k + 1 plus the taken numbers with fewer than k free ones before them.
    """
    stem, number = F.regexp_extract("name", _NUMBERED, 1), F.regexp_extract("name", _NUMBERED, 2)
    numbers = taken.filter(F.col("name").rlike(_NUMBERED)).select(
        stem.alias("stem"), number.cast("bigint").alias("number")
    ).filter("number >= 2")
    i = F.row_number().over(Window.partitionBy("stem").orderBy("number"))
    gaps = numbers.select("stem", (F.col("number") - i - 1).alias("value"), F.lit(1).alias("is_taken"))
    mine = rows.withColumn("stem", F.lower("prefixed"))
    k = F.row_number().over(Window.partitionBy("stem").orderBy("at"))
    mine = mine.withColumns({"value": k.cast("bigint"), "is_taken": F.lit(0)})
    both = mine.unionByName(gaps, allowMissingColumns=True)
    before = Window.partitionBy("stem").orderBy("value", "is_taken").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    passed = F.sum("is_taken").over(before)
    named = both.withColumn("number", F.col("value") + 1 + passed).filter("is_taken = 0")
    return named.select(*TRIPLE, F.concat("prefixed", F.col("number").cast("string")).alias("column_name"))


def name_columns(new: DataFrame, taken: DataFrame) -> DataFrame:
    """Column names for new triples: adds ``column_name``.

    A name is ``<stem>_<suffix>``; when that is taken, ``ep_``/``up_`` goes in front,
    and when that is taken too, a number from 2 goes behind.  ``taken`` has the
    names already given (``column_name``); the fixed columns are always taken.
    Names are given in a fixed order -- event_params first, then by key, then by
    sub-field -- and compared without case, as Spark resolves columns.

    All rows claim at once, a name goes to the first of its claimants in that order, and those
    who lose go on to their next name, until nobody loses: as every name prefers the same order,
    that is what giving names one by one comes to.  A round per nesting of prefixes is enough.
    Plain and prefixed names never end in a digit, so numbers are given at last, by ranks.
    """
    source, key = F.col("source"), F.col("key")
    suffixes = {sub: suffix for sub, (suffix, _) in SUB_FIELDS.items()}
    positions = {sub: str(i) for i, sub in enumerate(SUB_FIELDS)}
    fixed = F.explode(F.array(*[F.lit(name) for name in reserved_names()]))
    used = (
        taken.select("column_name")
        .unionByName(new.sparkSession.range(1).select(fixed.alias("column_name")))
        .select(F.lower("column_name").alias("name")).distinct()
    )
    rows = (
        new.select(*TRIPLE)
        .withColumn("plain", F.concat(
            stem(source, key), F.lit("_"), _literal_map(suffixes, F.col("sub_field"))))
        .withColumn("prefixed", F.concat(
            _literal_map(SOURCES, source), F.lit("_"), F.col("plain")))
        .withColumn("at", F.struct("source", "key", _literal_map(positions, F.col("sub_field"))))
        .withColumns({"level": F.lit(0), "lost": F.lit(True)})
    )
    spark = new.sparkSession
    while True:
        claiming = rows.filter("level < 2").withColumn(
            "name", F.lower(F.when(F.col("level") == 0, F.col("plain")).otherwise(F.col("prefixed")))
        )
        first = F.min("at").over(Window.partitionBy("name"))
        told = claiming.join(used.withColumn("used", F.lit(True)), "name", "left").withColumn(
            "lost", F.col("used").isNotNull() | (F.col("at") != first)
        ).drop("used", "name")
        told = told.withColumn("level", F.col("level") + F.col("lost").cast("int"))
        settled = rows.filter("level = 2").withColumn("lost", F.lit(False))
        rows = session.stored(told.unionByName(settled), session.scratch_path(spark, "names"))
        if rows.filter("lost").isEmpty():
            break
    given = F.when(F.col("level") == 0, F.col("plain")).otherwise(F.col("prefixed"))
    whole = rows.filter("level < 2").select(*TRIPLE, given.alias("column_name"))
    return whole.unionByName(_ranked(rows.filter("level = 2").select(*TRIPLE, "prefixed", "at"), used))


def _with_names(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Adds name and type to triples: the known name if any, else a new one."""
    kept = seen.join(known.select(*TRIPLE, "column_name"), TRIPLE, "left")
    new = name_columns(kept.filter("column_name IS NULL"), known).withColumnRenamed(
        "column_name", "new_name"
    )
    types = {sub: kind.simpleString() for sub, (_, kind) in SUB_FIELDS.items()}
    return (
        kept.join(new, TRIPLE, "left")
        .withColumn("column_name", F.coalesce("column_name", "new_name"))
        .withColumn("column_type", _literal_map(types, F.col("sub_field")))
    )


def seen(found: DataFrame) -> DataFrame:
    return seen_by(found)


def months(counts: DataFrame) -> DataFrame:
    """Counts per day summed by month: first and last day, and count, of each triple."""
    month = F.trunc("_dt", "month").alias("month")
    return seen_by(counts.withColumn("month", month), "month").withColumnRenamed("month", "_dt")


def seen_by(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by, *TRIPLE).agg(
        F.min("_dt").alias("first_seen"), F.max("_dt").alias("last_seen"),
        F.sum("n").alias("n_seen"),
    )


def seen_months(partial: DataFrame) -> DataFrame:
    """Days and counts of each triple from the sums of its months."""
    return partial.groupBy(*TRIPLE).agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("n_seen").alias("n_seen"),
    )


def with_counts(names: DataFrame, found: DataFrame) -> DataFrame:
    """The named triples with the days and counts of ``found``.

    A triple that no stored day holds any more keeps its name and days, with a count of 0.
    """
    now = found.select(
        *TRIPLE, F.col("first_seen").alias("first"), F.col("last_seen").alias("last"),
        F.col("n_seen").alias("n"),
    )
    return names.join(now, TRIPLE, "left").select(
        *TRIPLE, "column_name", "column_type",
        F.coalesce("first", "first_seen").alias("first_seen"),
        F.coalesce("last", "last_seen").alias("last_seen"),
        F.coalesce("n", F.lit(0)).alias("n_seen"),
        "updated_at",
    )


_ROW = [*TRIPLE, "column_name", "column_type", "first_seen", "last_seen", "n_seen"]


def upsert(known: DataFrame, found: DataFrame) -> DataFrame:
    """Registry rows to append for newly found keys, counts added to the known ones.

    ``known`` is the latest registry, ``found`` the result of key discovery.  A known
    triple keeps name, type and first day.  Running a day twice adds its counts twice;
    ``from_counts`` does not.
    """
    before = known.select(
        *TRIPLE, F.col("first_seen").alias("old_first"), F.col("last_seen").alias("old_last"),
        F.col("n_seen").alias("old_n"),
    )
    return (
        _with_names(seen(found), known)
        .join(before, TRIPLE, "left")
        .withColumn("first_seen", F.coalesce("old_first", "first_seen"))
        .withColumn("last_seen", F.greatest("old_last", "last_seen"))
        .withColumn("n_seen", F.col("n_seen") + F.coalesce("old_n", F.lit(0)))
        .select(*_ROW)
    )


def from_counts(known: DataFrame, counts: DataFrame) -> DataFrame:
    """Registry rows from the stored counts of all days; only names come from ``known``.

    The counts are replaced day by day, so a re-run changes nothing and an earlier
    day moves ``first_seen`` back.
    """
    return from_seen(known, seen(counts))


def from_seen(known: DataFrame, found: DataFrame) -> DataFrame:
    """As ``from_counts``, of counts already summed up by ``seen``.

    Naming reads them several times; held as a local table, as small as the flat table is
    wide, they are summed once.
    """
    return _with_names(found, known).select(*_ROW)


def added_columns(registry: DataFrame, existing: DataFrame) -> DataFrame:
    """Registry columns that a table (its names in ``column_name``) does not have yet."""
    names = existing.select(F.lower("column_name").alias("existing"))
    return registry.select("column_name", "column_type").join(
        names, F.lower("column_name") == F.col("existing"), "left_anti"
    )


@dataclass(frozen=True)
class DynamicColumn:
    """A discovered flat column."""

    source: str
    key: str
    sub_field: str
    name: str

    @property
    def type(self) -> T.DataType:
        return SUB_FIELDS[self.sub_field][1]


def columns(registry: DataFrame) -> list[DynamicColumn]:
    """The latest registry as a list of columns, in a fixed order."""
    rows = latest(registry).select(*TRIPLE, "column_name").orderBy(*TRIPLE).collect()
    return [DynamicColumn(*row) for row in rows]


def flat_schema(dynamic: list[DynamicColumn]) -> T.StructType:
    """Read schema of the flat table.

    Days written before a column was found give NULL for it, so widening the table
    rewrites nothing.
    """
    return T.StructType(
        [T.StructField(c.name, c.type) for c in (*BASE, *dynamic)] + METADATA.fields
    )


def empty(spark: SparkSession) -> DataFrame:
    from tidemark.schema.tables import REGISTRY

    return spark.createDataFrame([], REGISTRY)
