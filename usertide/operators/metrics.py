"""Metrics of the dictionary: activation, user funnel, activity, churn rate, guardrails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.functions.columns import FUNNEL_STEPS, PURCHASE, between_dates, is_event, period_start
from usertide.operators.facts import first_events
from usertide.operators.marts import retention_cohorts


def _users(approx: bool) -> Column:
    """Distinct users: exact, or estimated with a standard error of 5 percent."""
    return F.approx_count_distinct("user_id") if approx else F.countDistinct("user_id")


def activated_users(
    events: DataFrame,
    event: str = PURCHASE,
    start: str | None = None,
    end: str | None = None,
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Distinct users with the activation event in the period."""
    rows = events.where(is_event(event) & between_dates("event_date_utc", start, end))
    return rows.groupBy(*by).agg(_users(approx).alias("activated_users"))


def step_users(
    events: DataFrame,
    steps: dict[str, int] = FUNNEL_STEPS,
    start: str | None = None,
    end: str | None = None,
    by: Sequence[str] = (),
    first_event_starts: bool = False,
) -> DataFrame:
    """Distinct users per funnel step in the period, not cumulative; a step without users has 0.

    With ``first_event_starts`` the first event of a session that has no ``session_start`` counts as one.
    Users are first made distinct per event, which spreads them over all reducers; a
    distinct count per step in one aggregate would copy each row once per step.
    """
    period = between_dates("event_date_utc", start, end)
    named = events.where(F.col("event_name").isin(list(steps)) & period).select(*by, "event_name", "user_id")
    if first_event_starts:
        opened = first_events(events, by).where(period).select(*by, "event_name", "user_id")
        named = named.unionByName(opened)
    pairs = named.where(F.col("user_id").isNotNull()).distinct()
    counts = pairs.groupBy(*by).agg(*[F.count_if(F.col("event_name") == name).alias(name) for name in steps])
    rows = F.array(
        *[
            F.struct(
                F.lit(number).cast("bigint").alias("funnel_step"),
                F.lit(name).alias("funnel_event_name"),
                F.col(name).alias("users"),
            )
            for name, number in steps.items()
        ]
    )
    return counts.select(*by, F.inline(rows))


def _segment(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in ("funnel_step", "funnel_event_name", "users")]


def step_conversion(users: DataFrame) -> DataFrame:
    """Users of each step over the users of the step before, per segment of ``step_users``."""
    order = Window.partitionBy(*_segment(users)).orderBy("funnel_step")
    previous = F.lag("users").over(order)
    return users.withColumns({"prev_users": previous, "step_conversion": F.try_divide(F.col("users"), previous)})


def dropoff(conversion: DataFrame) -> DataFrame:
    """One minus the conversion of each step."""
    return conversion.withColumn("dropoff_rate", 1 - F.col("step_conversion"))


def overall_conversion(users: DataFrame, first: str = "session_start", last: str = PURCHASE) -> DataFrame:
    """Users of the last step over users of the first, per segment of ``step_users``."""

    def of(name: str):
        return F.sum(F.when(F.col("funnel_event_name") == name, F.col("users")))

    return users.groupBy(*_segment(users)).agg(
        of(first).alias("top_users"),
        of(last).alias("converted_users"),
        F.try_divide(of(last), of(first)).alias("overall_conversion"),
    )


def without_noise(events: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Events but those with these names; events without a name stay."""
    if not exclude:
        return events
    return events.where(~F.coalesce(F.col("event_name").isin(list(exclude)), F.lit(False)))


def active_users(
    events: DataFrame,
    grain: str = "day",
    exclude: Sequence[str] = (),
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Distinct users with a qualifying event per day, Monday week or month."""
    rows = without_noise(events, exclude)
    period = period_start(F.col("event_date_utc"), grain).alias("period_start")
    return rows.groupBy(period, *by).agg(_users(approx).alias("active_users"))


def nday_retention(
    users: DataFrame,
    activity: DataFrame,
    max_day: int | None = None,
    anchor: str = "session_start",
    zero_cells: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of each daily cohort active on day N after its anchor date, up to ``max_day`` if that is given."""
    return retention_cohorts(users, activity, anchor, "day", max_day, zero_cells, by)


def churn_rate(
    activity: DataFrame,
    window_days: int = 30,
    grain: str = "day",
    by: Sequence[str] = (),
    users: DataFrame | None = None,
) -> DataFrame:
    """Users newly inactive for ``window_days`` over users at risk, per period.

    ``by`` names columns of ``users``, one row per user, that split the users; activity of users without a row
    there has NULL segments.

    A user active on date d and next on date n churns on d + X when n is missing or
    after d + X, and stays churned until the day before n. At risk on date T are the
    users first active by T - X that were not churned on T - 1. For a week or month,
    at risk are those of its first date plus those who become so during it; a user
    who returns and is at risk again counts again.

    Only changes per date are counted over the users; the running total then goes
    over one row per calendar day up to the last date of activity.
    """
    x, by = window_days, list(by)
    if by:
        activity = activity.select("user_id", "activity_date").join(users.select("user_id", *by), "user_id", "left")
    by_date = Window.partitionBy("user_id").orderBy("activity_date")
    spells = activity.select(
        "user_id",
        *by,
        F.col("activity_date").alias("d"),
        F.lead("activity_date").over(by_date).alias("n"),
        F.lag("activity_date").over(by_date).isNull().alias("is_first"),
    )
    churns = F.col("n").isNull() | (F.col("n") > F.date_add("d", x))

    def change(test, day, entered: int, left: int, churned: int):
        return F.when(
            test,
            F.struct(
                day.alias("day"),
                F.lit(entered).cast("bigint").alias("entered"),
                F.lit(left).cast("bigint").alias("left"),
                F.lit(churned).cast("bigint").alias("churned"),
            ),
        )

    changes = F.array(
        change(F.col("is_first"), F.date_add("d", x), 1, 0, 0),
        change(churns, F.date_add("d", x), 0, 0, 1),
        change(churns, F.date_add("d", x + 1), 0, 1, 0),
        change(churns & F.col("n").isNotNull(), F.date_add("n", 1), 1, 0, 0),
    )
    per_day = (
        spells.select(*by, F.inline(F.array_compact(changes)))
        .groupBy(*by, "day")
        .agg(*[F.sum(c).alias(c) for c in ("entered", "left", "churned")])
    )
    bounds = activity.agg(F.min("activity_date").alias("lo"), F.max("activity_date").alias("hi"))
    calendar = bounds.where(F.col("lo") <= F.date_sub("hi", x)).select(
        F.explode(F.expr(f"sequence(date_add(lo, {x}), hi)")).alias("day")
    )
    total = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if by:
        # Every segment gets every date: as many rows as segments times days.
        segments = per_day.select(*by).distinct()
        days = calendar.agg(F.collect_list("day").alias("days"))
        every = segments.withColumn("day", F.explode(days.scalar()))
        found = per_day.select(*[F.col(c).alias(f"_{c}") for c in (*by, "day")], "entered", "left", "churned")
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("day") == F.col("_day")]
        dated = every.join(found, match, "left").drop(*[f"_{c}" for c in (*by, "day")])
    else:
        dated = calendar.join(per_day, "day", "left")
    daily = (
        dated.fillna(0, ["entered", "left", "churned"])
        .withColumn("at_risk", F.sum(F.col("entered") - F.col("left")).over(total))
    )
    # The first date of a period counts all at risk on it, the others those who entered.
    opening = F.min(F.struct("day", "at_risk", "entered"))
    at_risk = opening["at_risk"] + F.sum("entered") - opening["entered"]
    return daily.groupBy(period_start(F.col("day"), grain).alias("period_start"), *by).agg(
        F.sum("churned").alias("churned_users"),
        at_risk.alias("at_risk_users"),
        F.try_divide(F.sum("churned"), at_risk).alias("churn_rate"),
    )


def _churn_columns(churn: DataFrame) -> list[str]:
    return [c for c in churn.columns if c.startswith("churn_")]


def churn_by_segment(churn: DataFrame, by: Sequence[str] = ("is_purchaser",)) -> DataFrame:
    """Users and share churned per inactivity window, by columns of the churn mart."""
    flags = _churn_columns(churn)
    return churn.groupBy(*by).agg(
        F.count("*").alias("users"), *[F.avg(c).alias(f"{c}_rate") for c in flags]
    )


def churn_sensitivity(churn: DataFrame) -> DataFrame:
    """Churned users and their share, one row per inactivity window."""
    flags = _churn_columns(churn)
    rows = F.array(
        *[
            F.struct(
                F.lit(int(c.removeprefix("churn_").removesuffix("d"))).cast("bigint").alias("window_days"),
                F.col("users").alias("users"),
                F.col(c).alias("churned_users"),
                F.try_divide(F.col(c), F.col("users")).alias("churned_share"),
            )
            for c in flags
        ]
    )
    totals = churn.agg(F.count("*").alias("users"), *[F.sum(c).alias(c) for c in flags])
    return totals.select(F.inline(rows))


def event_volume(events: DataFrame, grain: str = "day") -> DataFrame:
    """Events per day, Monday week or month."""
    period = period_start(F.col("event_date_utc"), grain).alias("period_start")
    return events.groupBy(period).agg(F.count("*").alias("events"))


def purchases_per_purchaser(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Purchase events per user who purchased, in the period."""
    rows = events.where(is_event(PURCHASE) & between_dates("event_date_utc", start, end))
    count, buyers = F.count("*"), F.countDistinct("user_id")
    return rows.agg(
        count.alias("purchase_events"),
        buyers.alias("purchase_users"),
        F.try_divide(count, buyers).alias("purchases_per_purchaser"),
    )


def new_vs_returning(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Active users per date, split into those first seen that date, those seen before, and others.

    Others have no row in ``users``, or one that first saw them later.
    """
    status = with_user_status(activity, users, "activity_date")
    return status.groupBy("activity_date").agg(
        *[F.count_if(F.col("user_status") == s).alias(f"{s}_users") for s in ("new", "returning", "unknown")],
        F.count("*").alias("active_users"),
    )


def with_user_status(frame: DataFrame, users: DataFrame, date: str = "event_date_utc") -> DataFrame:
    """Add ``user_status``: new on the date a user was first seen, returning after it, unknown otherwise.

    It serves as a segment of events, steps and user days: give it to ``by`` of the metrics and funnels.
    """
    first = users.select(F.col("user_id").alias("_user"), F.col("first_seen_date").alias("_seen"))
    joined = frame.join(first, F.col("user_id") == F.col("_user"), "left")
    status = F.when(F.col(date) == F.col("_seen"), "new").when(F.col(date) > F.col("_seen"), "returning")
    return joined.withColumn("user_status", status.otherwise("unknown")).drop("_user", "_seen")


def profile_events(events: DataFrame, exact: bool = True) -> DataFrame:
    """Deciles of events per user and the share of events with a session id, as (metric, value).

    The exact deciles are taken over how many users have each count, so what meets in
    one task is the number of different counts, not the number of users.
    """
    per_user = events.groupBy("user_id").agg(F.count("*").alias("rows"), F.count("ga_session_id").alias("covered"))
    # Events without a user count for the coverage only.
    known = per_user.withColumn("n", F.when(F.col("user_id").isNotNull(), F.col("rows")))
    points = [i / 10 for i in range(11)]
    if exact:
        spread = known.groupBy("n").agg(
            F.count("*").alias("users"), F.sum("rows").alias("rows"), F.sum("covered").alias("covered")
        )
        quantiles = F.percentile("n", points, F.col("users"))
    else:
        spread, quantiles = known, F.percentile_approx("n", points, 10_000).cast("array<double>")
    row = spread.agg(quantiles.alias("q"), F.try_divide(F.sum("covered"), F.sum("rows")).alias("coverage"))
    metrics = [
        *[(f"events_per_user_p{10 * i:02d}", F.get("q", F.lit(i))) for i in range(11)],
        ("ga_session_id_coverage", F.col("coverage")),
    ]
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in metrics]))
    )
