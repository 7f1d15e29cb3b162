import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from helpers import enriched, raw, rows, staged

import usertide as ut
from usertide.schemas import TABLES


def users(spark, *found):
    """(user, first seen, first purchase) rows of the user dimension."""
    return spark.createDataFrame(
        [(u, None, date.fromisoformat(s) if s else None, None, date.fromisoformat(p) if p else None, bool(p)) for u, s, p in found],
        TABLES["dim_user"],
    )


def activity(spark, *days):
    """(user, date) pairs, or (user, date, overrides), as user days."""
    names = TABLES["fact_user_daily_activity"].names
    made = []
    for user, day, *more in days:
        row = dict.fromkeys(names) | {
            "user_id": user, "activity_date": date.fromisoformat(str(day)), "is_active": True, "event_count": 1,
            "had_session_start": True, "purchase_count": 0,
        } | (more[0] if more else {})
        made.append(tuple(row[n] for n in names))
    return spark.createDataFrame(made, TABLES["fact_user_daily_activity"])


def test_lone_purchase_reaches_every_step(spark):
    events = enriched(
        spark,
        raw("a", "2020-01-01 10:00:00", "purchase"),
        raw("b", "2020-01-01 23:59:00", "session_start"),
        raw("b", "2020-01-02 00:01:00", "view_item"),
        raw("c", "2020-01-03 00:01:00", "session_start"),
    )
    found = rows(ut.funnel_daily(ut.build_fact_funnel_steps(events)))
    assert found[0] == (date(2020, 1, 1), 2, 2, 1, 1, 1, 1.0, 0.5, 1.0, 1.0, 0.5)
    # Nobody viewed on the third: a rate over nobody is NULL.
    assert found[1] == (date(2020, 1, 3), 1, 0, 0, 0, 0, 0.0, None, None, None, 0.0)
    by = ut.funnel_daily(ut.build_fact_funnel_steps(events, grain="session_step"), by=["device_key"])
    assert rows(by, "sessions") == [(1,), (2,)]


def test_funnel_by_segment_adds_up_keys_of_one_attribute(spark):
    events = enriched(
        spark,
        raw("a", "2020-01-01 10:00:00", "session_start", platform="WEB"),
        raw("b", "2020-01-01 10:00:00", "view_item", platform="APP"),
        raw("c", "2020-01-02 10:00:00", "purchase", category="mobile"),
    )
    steps = ut.build_fact_funnel_steps(events)
    dim = ut.build_dim(events, "device_key", ["device_category", "platform"])
    found = ut.funnel_by_segment(steps, dim, "device_key", ["device_category"])
    assert rows(found, "device_category", "sessions", "sessions_view_item", "rate_view_item") == [
        ("desktop", 2, 1, 0.5),
        ("mobile", 1, 1, 1.0),
    ]
    daily = ut.funnel_by_segment(steps, dim, "device_key", ["device_category"], daily=True)
    assert rows(daily, "session_date", "sessions") == [(date(2020, 1, 1), 2), (date(2020, 1, 2), 1)]


def test_weekly_cohorts_start_on_monday_and_skip_empty_cells(spark):
    # Sunday 2021-01-03 and Monday 2021-01-04 fall in different weeks.
    u = users(spark, ("a", "2021-01-03", None), ("b", "2021-01-04", None), ("c", "2021-01-05", None), ("d", None, None))
    a = activity(
        spark, ("a", "2021-01-03"), ("a", "2021-01-04"), ("b", "2021-01-04"), ("b", "2021-01-06"),
        ("b", "2021-01-25"), ("c", "2021-01-05"), ("d", "2021-01-05"), ("a", "2021-06-01"),
    )
    late = (date(2020, 12, 28), 22, 1, 1, 1.0)
    assert late in rows(ut.retention_cohorts(u, a))  # no bound unless one is given
    cohorts = ut.retention_cohorts(u, a, max_index=12)
    assert rows(cohorts) == [
        (date(2020, 12, 28), 0, 1, 1, 1.0),
        (date(2020, 12, 28), 1, 1, 1, 1.0),
        (date(2021, 1, 4), 0, 2, 2, 1.0),
        (date(2021, 1, 4), 3, 2, 1, 0.5),
    ]
    # Week 3 divides by the one cohort that has a cell there.
    assert rows(ut.retention_curve(cohorts)) == [(0, 3, 3, 1.0), (1, 1, 1, 1.0), (3, 1, 2, 0.5)]
    full = ut.retention_cohorts(u, a, zero_cells=True, max_index=3)
    assert full.count() == 8
    assert rows(ut.retention_curve(full))[-1] == (3, 1, 3, pytest.approx(1 / 3))


def test_cohort_anchors_and_day_grain(spark):
    u = users(spark, ("a", "2021-01-01", "2021-01-02"), ("b", "2021-01-01", None))
    a = activity(
        spark, ("a", "2021-01-01", {"had_session_start": False}), ("a", "2021-01-02"), ("a", "2021-01-05"),
        ("b", "2021-01-01"),
    )
    bought = ut.retention_cohorts(u, a, anchor="first_purchase", grain="day", max_index=30)
    assert rows(bought) == [(date(2021, 1, 2), 0, 1, 1, 1.0), (date(2021, 1, 2), 3, 1, 1, 1.0)]
    started = ut.nday_retention(u, a)
    assert rows(started, "cohort_date", "day_index", "cohort_size") == [
        (date(2021, 1, 1), 0, 1), (date(2021, 1, 2), 0, 1), (date(2021, 1, 2), 3, 1),
    ]
    cells = ut.nday_retention(u, a, zero_cells=True)
    assert rows(cells, "cohort_date", "day_index", "active_users")[-4:] == [
        (date(2021, 1, 2), 0, 1), (date(2021, 1, 2), 1, 0), (date(2021, 1, 2), 2, 0), (date(2021, 1, 2), 3, 1),
    ]
    for bad in ({"anchor": "x"}, {"grain": "year"}):
        with pytest.raises(ValueError):
            ut.retention_cohorts(u, a, **bad)


def test_churn_flags_at_the_threshold_and_without_activity(spark):
    u = users(spark, ("a", "2021-01-01", None), ("b", "2021-01-01", None), ("c", "2021-01-01", "2021-01-02"))
    a = activity(spark, ("a", "2021-01-17"), ("c", "2021-01-18"), ("z", "2021-01-31"))
    churn = ut.churn_proxy(u, a)
    columns = ["user_id", "days_since_last_active", "churn_14d", "churn_30d", "churn_60d"]
    assert rows(churn, *columns) == [("a", 14, 1, 0, 0), ("b", None, 0, 0, 0), ("c", 13, 0, 0, 0)]
    later = ut.churn_proxy(u, a, windows=(20,), as_of="2021-02-06")
    assert rows(later, "user_id", "churn_20d") == [("a", 1), ("b", 0), ("c", 0)]
    assert rows(ut.churn_by_segment(churn), "is_purchaser", "users", "churn_14d_rate") == [
        (False, 2, 0.5), (True, 1, 0.0),
    ]
    assert rows(ut.churn_sensitivity(churn)) == [
        (14, 3, 1, pytest.approx(1 / 3)), (30, 3, 0, 0.0), (60, 3, 0, 0.0),
    ]


def test_wow_compares_with_the_previous_present_week(spark):
    a = activity(
        spark, ("a", "2021-01-04", {"purchase_count": 1}), ("b", "2021-01-05"), ("a", "2021-01-18"),
    )
    s = spark.createDataFrame([("k", date(2021, 1, 4)), ("l", date(2021, 1, 11))], "session_key string, session_date date")
    columns = ["week_start", "wau", "sessions", "wau_wow_delta", "wau_wow_pct", "purchases_wow_pct", "revenue"]
    found = rows(ut.wow_kpis(a, s), *columns)
    assert [r[:6] for r in found] == [
        (date(2021, 1, 4), 2, 1, None, None, None),
        (date(2021, 1, 18), 1, None, -1, -0.5, -1.0),
    ]
    assert all(r[6] == 0 for r in found)
    filled = rows(ut.wow_kpis(a, s, fill_weeks=True), *columns)
    assert [r[:5] for r in filled] == [
        (date(2021, 1, 4), 2, 1, None, None),
        (date(2021, 1, 11), 0, 1, -2, -1.0),
        (date(2021, 1, 18), 1, 0, 1, None),
    ]


def brute_churn(days, x, start, end):
    """Churned and at risk per date, from the state of each user on each date."""
    found = {}
    day = start + timedelta(days=x)
    while day <= end:
        churned = at_risk = 0
        for dates in days.values():
            past = [d for d in dates if d <= day]
            before = [d for d in dates if d < day]
            churned += bool(past) and (day - max(past)).days == x
            at_risk += (
                min(dates) <= day - timedelta(days=x) and (day - timedelta(days=1) - max(before)).days < x
            )
        found[day] = (churned, at_risk)
        day += timedelta(days=1)
    return found


@pytest.mark.parametrize("x", [3, 14])
def test_churn_rate_equals_brute_force(spark, x):
    rng = random.Random(x)
    start = date(2021, 1, 1)
    days = {f"u{i}": sorted({start + timedelta(days=rng.randrange(60)) for _ in range(rng.randrange(1, 9))}) for i in range(40)}
    a = activity(spark, *[(u, d) for u, dates in days.items() for d in dates])
    first = min(d for dates in days.values() for d in dates)
    last = max(d for dates in days.values() for d in dates)
    wanted = [(d, c, r) for d, (c, r) in brute_churn(days, x, first, last).items()]
    assert rows(ut.churn_rate(a, x), "period_start", "churned_users", "at_risk_users") == wanted
    monthly = rows(ut.churn_rate(a, x, "month"), "period_start", "churned_users")
    assert sum(c for _, c in monthly) == sum(c for _, c, _ in wanted)


def test_churn_rate_of_a_short_history_is_empty(spark):
    assert ut.churn_rate(activity(spark, ("a", "2021-01-01"), ("a", "2021-01-05")), 14).count() == 0


def test_step_metrics(spark):
    events = staged(
        spark,
        raw("a", "2020-01-01 10:00:00", "session_start"),
        raw("b", "2020-01-01 10:00:00", "session_start"),
        raw("a", "2020-01-01 10:01:00", "view_item"),
        raw("a", "2020-01-01 10:02:00", "view_item"),
        raw("c", "2020-01-02 10:00:00", "purchase"),
        raw(None, "2020-01-02 10:00:00", "purchase"),
    )
    steps = ut.step_users(events)
    assert rows(steps) == [
        (1, "session_start", 2), (2, "view_item", 1), (3, "add_to_cart", 0), (4, "begin_checkout", 0), (5, "purchase", 1),
    ]
    conversion = ut.step_conversion(steps)
    assert rows(conversion, "funnel_step", "step_conversion") == [(1, None), (2, 0.5), (3, 0.0), (4, None), (5, None)]
    assert rows(ut.dropoff(conversion), "dropoff_rate")[2:] == [(None,), (0.5,), (1.0,)]
    assert rows(ut.overall_conversion(steps)) == [(2, 1, 0.5)]
    assert rows(ut.step_users(events, start="2020-01-02"), "users")[:1] == [(0,)]
    assert rows(ut.activated_users(events)) == [(1,)]
    assert rows(ut.purchases_per_purchaser(events)) == [(2, 1, 2.0)]
    assert rows(ut.active_users(events, "month", exclude=["session_start"])) == [(date(2020, 1, 1), 2)]
    assert rows(ut.active_users(events, "month", approx=True)) == [(date(2020, 1, 1), 3)]
    assert rows(ut.activated_users(events, approx=True)) == [(1,)]
    assert rows(ut.event_volume(events, "week")) == [(date(2019, 12, 30), 6)]


def test_new_and_returning_make_up_the_active(spark):
    u = users(spark, ("a", "2021-01-01", None), ("b", "2021-01-02", None))
    a = activity(spark, ("a", "2021-01-01"), ("a", "2021-01-02"), ("b", "2021-01-02"))
    assert rows(ut.new_vs_returning(a, u)) == [(date(2021, 1, 1), 1, 0, 0, 1), (date(2021, 1, 2), 1, 1, 0, 2)]
    # Users without a row are active all the same.
    assert rows(ut.new_vs_returning(a, u.where("user_id = 'a'"))) == [
        (date(2021, 1, 1), 1, 0, 0, 1),
        (date(2021, 1, 2), 0, 1, 1, 2),
    ]


def test_retention_and_churn_by_segment(spark):
    u = users(spark, ("a", "2021-01-04", None), ("b", "2021-01-04", None)).withColumn(
        "kind", F.when(F.col("user_id") == "a", "x")
    )
    a = activity(spark, ("a", "2021-01-04"), ("a", "2021-01-12"), ("b", "2021-01-04"))
    monday = date(2021, 1, 4)
    assert rows(ut.retention_cohorts(u, a, by=["kind"])) == [
        (monday, None, 0, 1, 1, 1.0),
        (monday, "x", 0, 1, 1, 1.0),
        (monday, "x", 1, 1, 1, 1.0),
    ]
    cells = ut.retention_cohorts(u, a, by=["kind"], zero_cells=True)
    assert (monday, None, 1, 1, 0, 0.0) in rows(cells) and cells.count() == 4
    assert rows(ut.retention_curve(cells), "kind", "week_index", "active_users")[1] == (None, 1, 0)
    churn = {(r.period_start.day, r.kind): r.churned_users for r in ut.churn_rate(a, 3, by=["kind"], users=u).collect()}
    assert churn[7, "x"] == churn[7, None] == 1 and churn[12, "x"] == churn[12, None] == 0 and len(churn) == 12


def test_profile(spark):
    events = staged(
        spark,
        *[raw("a", f"2020-01-01 10:00:0{i}") for i in range(5)],
        raw("b", "2020-01-01 10:00:00"),
        raw("c", "2020-01-01 10:00:00", session=None),
        raw("c", "2020-01-01 10:00:01"),
    )
    found = dict(ut.profile_events(events).collect())
    assert (found["events_per_user_p00"], found["events_per_user_p50"], found["events_per_user_p100"]) == (1, 2, 5)
    assert found["events_per_user_p10"] == pytest.approx(1.2)
    assert found["ga_session_id_coverage"] == 7 / 8
    assert dict(ut.profile_events(events, exact=False).collect())["events_per_user_p100"] == 5
