"""Sketches at rest: distinct users and quantiles per day and segment, merged to any range without reading events again.

A theta sketch of the users and a KLL sketch of the events per user and day, for each date and segment. Sketches of several dates
merge into that of the range; two ranges intersect. Sizes are fixed, whatever the number of users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.functions.columns import between_dates, period_start

#: Entries of a theta sketch, as a power of two, and the size of a KLL sketch.
LG_ENTRIES, KLL_SIZE = 12, 400


def daily_sketches(activity: DataFrame, by: Sequence[str] = (), lg_entries: int = LG_ENTRIES, kll_size: int = KLL_SIZE) -> DataFrame:
    """``activity_date``, the segments, ``users`` and ``event_counts``, from user days. To be stored, by ``TableStore.publish`` for instance."""
    return activity.groupBy("activity_date", *by).agg(
        F.theta_sketch_agg("user_id", lg_entries).alias("users"), F.kll_sketch_agg_bigint("event_count", kll_size).alias("event_counts")
    )


def users_bound(lg_entries: int = LG_ENTRIES) -> float:
    """Relative error of a number of users that one estimate in 370 exceeds: three standard errors, 1 / sqrt(entries) each."""
    return 3 / 2 ** (lg_entries / 2)


def overlap_bound(both: Column, either: Column, lg_entries: int = LG_ENTRIES) -> Column:
    """The same for an intersection, absolute: three times sqrt(either * both / entries), and one user for rounding."""
    return 3 * F.sqrt(either * both / 2**lg_entries) + 1


def rank_bound(kll_size: int = KLL_SIZE) -> float:
    """Error of a quantile's rank, as a share of the rows, that one sketch in a hundred exceeds: about 2.3 / size ** 0.9."""
    return 2.296 / kll_size**0.9021


def sketched_users(sketches: DataFrame, grain: str = "month", by: Sequence[str] = (), lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Estimated distinct users per day, Monday week or month."""
    period = period_start(F.col("activity_date"), grain).alias("period_start")
    merged = sketches.groupBy(period, *by).agg(F.theta_union_agg("users", lg_entries).alias("users"))
    return merged.select("period_start", *by, F.theta_sketch_estimate("users").alias("active_users"))


def sketched_overlap(
    sketches: DataFrame, one: tuple[str | None, str | None], other: tuple[str | None, str | None], by: Sequence[str] = (), lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """Estimated users active in both of two ranges of dates, and in either; ends are inclusive, an open end is None."""

    def of(name: str, dates: tuple[str | None, str | None]) -> Column:
        held = F.when(between_dates("activity_date", *dates), F.col("users"))
        return F.theta_union_agg(held, lg_entries).alias(name)

    merged = sketches.groupBy(*by).agg(of("one", one), of("other", other))
    count = F.theta_sketch_estimate
    return merged.select(
        *by,
        count(F.theta_intersection("one", "other")).alias("both_users"),
        count(F.theta_union("one", "other", lg_entries)).alias("either_users"),
    )


def sketched_quantiles(sketches: DataFrame, points: Sequence[float], grain: str = "month", by: Sequence[str] = (), kll_size: int = KLL_SIZE) -> DataFrame:
    """Estimated quantiles of the events per user and day, a row per period and point."""
    period = period_start(F.col("activity_date"), grain).alias("period_start")
    merged = sketches.groupBy(period, *by).agg(F.kll_merge_agg_bigint("event_counts", kll_size).alias("sketch"))
    rows = [F.struct(F.lit(float(p)).alias("point"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias("event_count")) for p in points]
    return merged.select("period_start", *by, F.inline(F.array(*rows)))
