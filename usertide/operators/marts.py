"""The five reporting marts, built from dimension and fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.functions.columns import period_start
from usertide.schemas import DIM_KEYS, MONEY

# Sessions that reached at least this step, by output column.
_REACHED = {
    "sessions": 1,
    "sessions_view_item": 2,
    "sessions_add_to_cart": 3,
    "sessions_begin_checkout": 4,
    "sessions_purchase": 5,
}

_RATES = {
    "rate_view_item": ("sessions_view_item", "sessions"),
    "rate_add_to_cart_given_view": ("sessions_add_to_cart", "sessions_view_item"),
    "rate_begin_checkout_given_cart": ("sessions_begin_checkout", "sessions_add_to_cart"),
    "rate_purchase_given_checkout": ("sessions_purchase", "sessions_begin_checkout"),
    "rate_purchase_overall": ("sessions_purchase", "sessions"),
}


def _session_reach(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per session its first date, its furthest step and, for ``by``, its earliest values."""
    aggregates = [F.min("session_date").alias("session_date"), F.max("funnel_step").alias("furthest")]
    if not by:
        return steps.groupBy("session_key").agg(*aggregates)
    # First by hash into fixed-width buffers; the minimum over structs sees the few rows left.
    few = steps.groupBy("session_key", *by).agg(F.min("step_ts").alias("step_ts"), *aggregates)
    earliest = F.min(F.struct(F.col("step_ts").isNull().alias("untimed"), "step_ts", *by)).alias("earliest")
    return (
        few.groupBy("session_key")
        .agg(F.min("session_date").alias("session_date"), F.max("furthest").alias("furthest"), earliest)
        .select("session_key", "session_date", "furthest", *[F.col(f"earliest.{c}").alias(c) for c in by])
    )


def _funnel_counts(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    reached = [
        (F.count("*") if step == 1 else F.count_if(F.col("furthest") >= step)).alias(name)
        for name, step in _REACHED.items()
    ]
    return _session_reach(steps, by).groupBy("session_date", *by).agg(*reached)


def _with_rates(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[F.try_divide(a, b).alias(name) for name, (a, b) in _RATES.items()])


def funnel_daily(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sessions per date that reached each step or a later one, with conversion rates.

    A session counts on the first date it has a funnel event. ``by`` adds columns of
    the steps table, such as a dimension key, to the grouping.
    """
    return _with_rates(_funnel_counts(steps, by))


def funnel_by_segment(
    steps: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str], daily: bool = False
) -> DataFrame:
    """The session funnel by attributes of a dimension, over all dates or per date.

    The dimension is joined to the counts per key, not to the steps, and several keys
    with the same attribute are added up afterwards.
    """
    group = (["session_date"] if daily else []) + list(attributes)
    counts = _funnel_counts(steps, [key]).join(dim.select(key, *attributes), key, "left")
    return _with_rates(counts.groupBy(*group).agg(*[F.sum(c).alias(c) for c in _REACHED]))


def with_first_touch(users: DataFrame, activity: DataFrame, keys: Sequence[str] = DIM_KEYS) -> DataFrame:
    """Users with the dimension keys of their first active day; NULL for users without activity."""
    first = activity.groupBy("user_id").agg(F.min(F.struct("activity_date", *keys)).alias("_first"))
    return users.join(first, "user_id", "left").select(
        *[F.col(c) for c in users.columns], *[F.col(f"_first.{k}").alias(k) for k in keys]
    )


def _anchor_dates(users: DataFrame, activity: DataFrame, anchor: str, by: Sequence[str]) -> DataFrame:
    """(user_id, anchor_date) and segments of the users that belong to a cohort."""
    if anchor in ("first_seen", "first_purchase"):
        dated = users.select("user_id", F.col(f"{anchor}_date").alias("anchor_date"), *by)
    elif anchor == "session_start":
        dated = (
            activity.where("had_session_start").groupBy("user_id").agg(F.min("activity_date").alias("anchor_date"))
        )
        if by:
            dated = dated.join(users.select("user_id", *by), "user_id", "left")
    else:
        raise ValueError(f"anchor must be first_seen, first_purchase or session_start, not {anchor!r}")
    return dated.where(F.col("anchor_date").isNotNull())


# Per grain: cohort column, index column, days per period.
_GRAINS = {"week": ("cohort_week", "week_index", 7), "day": ("cohort_date", "day_index", 1)}


def retention_cohorts(
    users: DataFrame,
    activity: DataFrame,
    anchor: str = "first_seen",
    grain: str = "week",
    max_index: int | None = None,
    zero_cells: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Users of each cohort active in each later period, up to ``max_index`` if that is given.

    ``anchor`` is ``first_seen``, ``first_purchase`` or ``session_start``; ``grain`` is
    ``week`` (from Monday) or ``day``. A cell nobody was active in is absent, unless
    ``zero_cells`` asks for every cell up to the last date of activity. ``by`` names columns of
    ``users`` that split the cohorts, such as those of ``with_first_touch``.
    """
    by = list(by)
    if grain not in _GRAINS:
        raise ValueError(f"grain must be week or day, not {grain!r}")
    cohort, index, unit = _GRAINS[grain]
    cohorts = _anchor_dates(users, activity, anchor, by).select(
        "user_id", period_start(F.col("anchor_date"), grain).alias(cohort), *by
    )
    sizes = cohorts.groupBy(cohort, *by).agg(F.count("*").alias("cohort_size"))
    periods = activity.select("user_id", period_start(F.col("activity_date"), grain).alias("_period"))
    # Both dates start a period, so whole periods lie between them.
    since = F.expr(f"datediff(_period, {cohort}) div {unit}")
    inside = F.col(index) >= 0 if max_index is None else F.col(index).between(0, max_index)
    # Duplicate user periods are dropped after the join, under the partitioning by
    # user_id that the join has made already; dropping them before would shuffle twice.
    active = (
        cohorts.join(periods, "user_id")
        .select("user_id", cohort, *by, since.alias(index))
        .where(inside)
        .distinct()
        .groupBy(cohort, *by, index)
        .agg(F.count("user_id").alias("active_users"))
    )
    if zero_cells:
        last = activity.agg(F.max("activity_date").alias("last")).select(period_start(F.col("last"), grain)).scalar()
        # least() passes over a NULL, so no bound leaves the weeks observed.
        observed = F.least(F.lit(max_index).cast("bigint"), (F.datediff(last, F.col(cohort)) / unit).cast("bigint"))
        left = sizes.withColumn(index, F.explode(F.sequence(F.lit(0).cast("bigint"), observed)))
        how = "left"
    else:
        left, how = sizes, "inner"
    # A segment may be NULL, which a join by name would lose.
    right = active.select(*[F.col(c).alias(f"_{c}") for c in (cohort, *by, index)], "active_users")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c in by else F.col(c) == F.col(f"_{c}") for c in (cohort, *by)]
    if zero_cells:
        cells = left.join(right, [*match, F.col(index) == F.col(f"_{index}")], how).fillna(0, ["active_users"])
    else:
        cells = left.join(right, match, how).withColumnRenamed(f"_{index}", index)
    return cells.select(
        cohort,
        *by,
        index,
        "cohort_size",
        "active_users",
        F.try_divide("active_users", "cohort_size").alias("retention_rate"),
    )


def retention_curve(cohorts: DataFrame) -> DataFrame:
    """Retention by period index over the cells of all cohorts of a segment, weighted by cohort size."""
    index = next(c for c in cohorts.columns if c.endswith("_index"))
    cells = {index, "cohort_week", "cohort_date", "cohort_size", "active_users", "retention_rate"}
    by = [c for c in cohorts.columns if c not in cells]
    active, size = F.sum("active_users"), F.sum("cohort_size")
    return (
        cohorts.groupBy(*by, index)
        .agg(
            active.alias("active_users"),
            size.alias("cohort_users"),
            F.try_divide(active, size).alias("retention_rate_weighted"),
        )
        .orderBy(*by, index)
    )


def churn_proxy(
    users: DataFrame,
    activity: DataFrame,
    windows: Sequence[int] = (14, 30, 60),
    as_of: str | None = None,
) -> DataFrame:
    """Days since each user was last active, and a 0/1 flag per inactivity window.

    Counted up to the last date of any activity, or ``as_of``. A user without activity
    has no days and is flagged 0.
    """
    if as_of is None:
        as_of_date = activity.agg(F.max("activity_date")).scalar()
    else:
        as_of_date = F.to_date(F.lit(as_of))
    last = activity.groupBy("user_id").agg(F.max("activity_date").alias("last_active_date"))
    days = F.datediff("as_of_date", "last_active_date").cast("bigint")
    return (
        users.select("user_id", "first_seen_date", "first_purchase_date", "is_purchaser")
        .join(last, "user_id", "left")
        .distinct()
        .withColumn("as_of_date", as_of_date)
        .withColumn("days_since_last_active", days)
        .withColumns(
            {
                f"churn_{n}d": F.when(F.col("days_since_last_active") >= n, 1).otherwise(0).cast("bigint")
                for n in windows
            }
        )
    )


def wow_kpis(
    activity: DataFrame, sessions: DataFrame, fill_weeks: bool = False, with_events: bool = False
) -> DataFrame:
    """Weekly active users, sessions, purchases and revenue, and their change to the week before.

    The week before is the previous week with activity; ``fill_weeks`` adds the weeks
    without any, with zeros, so that it is always the calendar week before.
    ``with_events`` adds the number of events.
    """
    monday = period_start(F.col("activity_date"), "week")
    weekly = activity.groupBy(monday.alias("week_start")).agg(
        F.countDistinct("user_id").alias("wau"),
        F.sum("event_count").alias("events"),
        F.sum("purchase_count").alias("purchases"),
        F.sum(F.coalesce("revenue", F.lit(0).cast(MONEY))).alias("revenue"),
    )
    sessions_weekly = sessions.groupBy(
        period_start(F.col("session_date"), "week").alias("week_start")
    ).agg(F.count("*").alias("sessions"))
    if fill_weeks:
        bounds = activity.agg(F.min(monday).alias("lo"), F.max(monday).alias("hi"))
        weeks = bounds.select(F.explode(F.expr("sequence(lo, hi, interval 7 days)")).alias("week_start"))
        weekly = weeks.join(weekly, "week_start", "left")
    joined = weekly.join(sessions_weekly, "week_start", "left")
    if fill_weeks:
        joined = joined.fillna(0, ["wau", "events", "sessions", "purchases"]).withColumn(
            "revenue", F.coalesce("revenue", F.lit(0).cast(MONEY))
        )

    # One row per calendar week, so a window without partitions stays small.
    by_week = Window.orderBy("week_start")

    def change(name: str) -> list[Column]:
        previous = F.lag(name).over(by_week)
        delta = F.col(name) - previous
        if name == "revenue":  # a difference of amounts is an amount
            delta = delta.cast(MONEY)
        # Decimal by decimal would round to six places.
        kind = "double" if name == "revenue" else "bigint"
        return [
            delta.alias(f"{name}_wow_delta"),
            F.try_divide(delta.cast(kind), previous.cast(kind)).alias(f"{name}_wow_pct"),
        ]

    measures = ["wau", "sessions", "purchases", "revenue"]
    return joined.select(
        "week_start",
        *measures,
        *(["events"] if with_events else []),
        F.try_divide("purchases", "sessions").alias("purchase_per_session"),
        F.try_divide("revenue", "sessions").alias("revenue_per_session"),
        *[column for name in measures for column in change(name)],
    ).orderBy("week_start")
