"""Cohort retention over the per-user mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def retention(user_daily: DataFrame) -> DataFrame:
    """Users of each first-open cohort active ``day_n`` days later.

    A user may be new on several days and then belongs to several cohorts.  The mart
    holds a user once per day, so within (cohort, day_n) no user repeats and counting
    rows is the exact distinct count; a user has at most one row per calendar day,
    which also bounds what one join key can bring together.
    """
    cohort = user_daily.filter("is_new = 1").select(
        F.col("_dt").alias("cohort_dt"), "user_pseudo_id"
    )
    active = user_daily.select("_dt", "user_pseudo_id")
    return (
        cohort.join(active, "user_pseudo_id")
        .filter("_dt >= cohort_dt")
        .groupBy("cohort_dt", F.date_diff("_dt", "cohort_dt").alias("day_n"))
        .agg(F.count("*").alias("retained_users"))
    )


def day_sets(user_daily: DataFrame) -> DataFrame:
    """The days of each user by month (``_dt``): bit d - 1 of ``active`` and of ``fresh`` for day d."""
    bit = F.expr("shiftleft(1, dayofmonth(_dt) - 1)")
    return user_daily.groupBy("user_pseudo_id", F.trunc("_dt", "month").alias("month")).agg(
        F.bit_or(bit).alias("active"),
        F.bit_or(F.when(F.col("is_new") == 1, bit).otherwise(F.lit(0))).alias("fresh"),
    ).withColumnRenamed("month", "_dt")


def _days_of(month: Column, bits: Column) -> Column:
    """The days whose bits are set."""
    places = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda b: F.getbit(bits.cast("bigint"), b) == 1)
    return F.transform(places, lambda b: F.date_add(month, b))


def retention_of_sets(sets: DataFrame) -> DataFrame:
    """As ``retention``, from the kept day sets; a user's months are a few numbers.

    Nothing is joined: each user's days are read off its own bits.  Where the sets are dealt by
    user, users are not shuffled either.
    """
    months = F.collect_list(F.struct("_dt", "active", "fresh"))
    users = sets.groupBy("user_pseudo_id").agg(months.alias("months"))
    days = {
        kind: F.flatten(F.transform("months", lambda m: _days_of(m["_dt"], m[kind])))  # noqa: B023
        for kind in ("active", "fresh")
    }
    pairs = users.select(days["active"].alias("days"), F.explode(days["fresh"]).alias("cohort_dt")).select(
        "cohort_dt", F.explode("days").alias("day")
    )
    return (
        pairs.filter("day >= cohort_dt")
        .groupBy("cohort_dt", F.date_diff("day", "cohort_dt").alias("day_n"))
        .agg(F.count("*").alias("retained_users"))
    )


def retention_percent(retained: DataFrame, days: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Cohort size, and the share of it still active on the given days, in percent.

    A tie at the last digit rounds to the even neighbour.
    """

    def on(day: int) -> Column:
        return F.max(F.when(F.col("day_n") == day, F.col("retained_users")))

    size = on(0)
    return (
        retained.groupBy("cohort_dt")
        .agg(
            size.alias("cohort_size"),
            *[
                F.bround(F.try_divide(on(d), size) * 100, 1).alias(f"d{d}_pct")
                for d in days
            ],
        )
        .orderBy("cohort_dt")
    )
