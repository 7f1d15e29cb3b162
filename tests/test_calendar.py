"""Activity calendars against user days, and stored sketches against exact figures."""

from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

import usertide as ut
from usertide.operators import sketches

START = date(2020, 1, 1)
#: Days since START on which each user is active; and which of these have a session start.
ACTIVE = {
    "once": ([5], [5]),
    "daily": (range(0, 200), [3]),
    "weekly": (range(2, 200, 7), [9, 16]),
    "pauses": ([0, 13, 14, 28, 29, 58, 88, 89, 119, 120, 180], []),
    "edges": ([62, 63, 64, 127, 128, 191, 192], [63]),  # about the ends of words
    "late": ([199], [199]),
}


@pytest.fixture(scope="module")
def days(spark):
    made = [(u, START + timedelta(n), n in starts) for u, (on, starts) in ACTIVE.items() for n in on]
    made += [made[0], (None, START, True), ("undated", None, True)]
    return spark.createDataFrame(made, "user_id string, activity_date date, had_session_start boolean")


@pytest.fixture(scope="module")
def calendar(days):
    return ut.activity_calendar(days)


def known(days):
    return days.where("user_id is not null and activity_date is not null").distinct()


@pytest.mark.parametrize("x,grain", [(1, "day"), (14, "day"), (30, "week"), (63, "day"), (64, "day"), (65, "month"), (150, "day"), (500, "day")])
def test_churn_equals_that_of_user_days(days, calendar, x, grain):
    assert rows(ut.calendar_churn_rate(calendar, x, grain)) == rows(ut.churn_rate(known(days), x, grain))


@pytest.mark.parametrize("max_day", [None, 0, 30])
def test_retention_equals_that_of_user_days(days, calendar, max_day):
    users = known(days).select("user_id").distinct()
    assert rows(ut.calendar_retention(calendar, max_day)) == rows(ut.nday_retention(users, known(days), max_day=max_day))


@pytest.mark.parametrize("n", [1, 7, 28, 64, 100])
def test_rolling_actives_are_those_of_each_window(calendar, n):
    got = {r.activity_date: r.active_users for r in ut.rolling_active_users(calendar, n).collect()}
    want = {
        START + timedelta(t): sum(any(t - n < d <= t for d in on) for on, _ in ACTIVE.values()) for t in range(200)
    }
    assert got == want


def test_calendars_merge_in_any_cut(days, calendar):
    whole = rows(calendar.select("user_id", "first_word", "active", "started"))
    assert [r[0] for r in whole] == sorted(ACTIVE)
    for cut in ("activity_date < '2020-03-01'", "user_id > 'f'", "had_session_start"):
        parts = [ut.activity_calendar(days.where(cut)), ut.activity_calendar(days.where(f"not {cut}"))]
        merged = ut.merge_calendars(*parts, parts[0], ut.activity_calendar(days.limit(0)))
        assert rows(merged.select("user_id", "first_word", "active", "started")) == whole


def test_days_before_1970_and_no_days(spark):
    old = spark.sql("select 'a' as user_id, date'1969-12-31' as activity_date, true as had_session_start")
    calendar = ut.activity_calendar(old.unionByName(old.withColumn("activity_date", F.lit("1970-01-02").cast("date"))))
    assert rows(ut.calendar_retention(calendar), "cohort_date", "day_index") == [(date(1969, 12, 31), 0), (date(1969, 12, 31), 2)]
    assert rows(ut.rolling_active_users(calendar, 2), "active_users") == [(1,), (1,), (1,)]
    none = ut.activity_calendar(old.limit(0))
    for found in (ut.calendar_churn_rate(none), ut.calendar_retention(none), ut.rolling_active_users(none)):
        assert found.count() == 0


@pytest.fixture(scope="module")
def many(spark):
    """60 days, users that come every so many days, and one that has a third of all events."""
    made = spark.range(60 * 20_000).selectExpr("cast(id % 20000 as int) as u", "cast(id div 20000 as int) as d").where("pmod(u * 7 + d, 1 + u % 13) = 0")
    return made.selectExpr(
        "cast(u as string) as user_id", "date_add(date'2020-01-01', d) as activity_date", "u % 3 as segment",
        "if(u = 0, 100000L, 1L + (u * 31 + d * 17) % 97) as event_count",
    )


def test_users_of_merged_sketches_are_within_three_errors(many):
    sketched = ut.daily_sketches(many, by=["segment"])
    for by in ([], ["segment"]):
        exact = many.groupBy(F.trunc("activity_date", "month").alias("period_start"), *by).agg(F.countDistinct("user_id").alias("n"))
        for r in exact.join(ut.sketched_users(sketched, by=by), ["period_start", *by]).collect():
            assert abs(r.active_users - r.n) <= sketches.users_bound() * r.n
            assert r.n > 5000  # more than a sketch holds


def test_overlap_of_two_periods(many):
    found = ut.sketched_overlap(ut.daily_sketches(many), ("2020-01-01", "2020-01-05"), ("2020-01-06", None)).first()
    early = many.where("activity_date <= '2020-01-05'").select("user_id").distinct()
    both = early.join(many.where("activity_date > '2020-01-05'"), "user_id", "left_semi").count()
    either = many.select("user_id").distinct().count()
    assert 0 < abs(found.either_users - either) <= sketches.users_bound() * either
    assert abs(found.both_users - both) <= 3 * (either * both / 4096) ** 0.5 + 1


def test_ranks_of_merged_quantiles(many):
    points = [i / 10 for i in range(1, 10)]
    for by in ([], ["segment"]):
        found = ut.sketched_quantiles(ut.daily_sketches(many, by=by), points, by=by).withColumnRenamed("event_count", "v")
        rows_ = many.withColumn("period_start", F.trunc("activity_date", "month"))
        ranked = rows_.join(found, ["period_start", *by]).groupBy("period_start", *by, "point").agg(
            F.avg((F.col("event_count") < F.col("v")).cast("double")).alias("below"), F.avg((F.col("event_count") <= F.col("v")).cast("double")).alias("upto")
        )
        for r in ranked.collect():
            assert r.below - 2 * sketches.rank_bound() <= r.point <= r.upto + 2 * sketches.rank_bound()
