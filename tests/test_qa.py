"""Each injected fault must move exactly its metrics, by exactly its amount."""

import pytest
from helpers import enriched, raw, rows
from pyspark.sql import functions as F

import usertide as ut
from usertide.schemas import TABLES

EVENTS = [
    raw("a", "2020-01-01 10:00:00", "session_start"),
    raw("a", "2020-01-01 10:05:00", "view_item"),
    raw("a", "2020-01-01 10:09:00", "purchase", txn="T1", revenue=5.0),
    raw("a", "2020-01-02 10:00:00", "session_start", session=2, number=2, category="mobile"),
    raw("b", "2020-01-02 11:00:00", "session_start", country="SE"),
    raw("b", "2020-01-02 11:30:00", "purchase", txn="T2", revenue=7.0, country="SE"),
    raw("c", "2020-01-03 12:00:00", "scroll", source="news"),
]

METRICS = {
    "count_dim_date": 3, "count_dim_device": 2, "count_dim_geo": 2, "count_dim_traffic_source": 2,
    "count_dim_user": 3, "count_fact_sessions": 4, "count_fact_funnel_steps": 6,
    "count_fact_user_daily_activity": 4, "count_fact_purchases": 2,
    "recon_events_cnt": 7, "recon_sessions_distinct_from_events": 4, "recon_users_distinct_from_events": 3,
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A clean stored model and its events."""
    events = enriched(spark, *EVENTS)
    store = ut.TableStore(spark, root=str(tmp_path_factory.mktemp("dw")), partitioned=False)
    from usertide.plans.pipeline import load_model

    load_model(store, ut.build_model(events, events))
    return store.model(), events


def clean():
    return {**dict.fromkeys(EXPECTED_NAMES, 0), **METRICS}


EXPECTED_NAMES = [
    "dupes_dim_user_user_id", "dupes_fact_sessions_session_key", "dupes_fact_user_daily_activity_user_day",
    "dupes_fact_purchases_purchase_key", "nulls_fact_sessions_user_id", "nulls_fact_sessions_session_id",
    "nulls_fact_sessions_session_start_ts", "nulls_fact_sessions_session_date",
    "nulls_fact_user_daily_activity_user_id", "nulls_fact_user_daily_activity_activity_date",
    "nulls_fact_purchases_user_id", "nulls_fact_purchases_purchase_ts", "nulls_fact_purchases_purchase_date",
    "nulls_fact_purchases_revenue", "orphans_fact_sessions_dim_user", "orphans_fact_sessions_dim_device",
    "orphans_fact_sessions_dim_geo", "orphans_fact_sessions_dim_traffic_source",
    "funnel_steps_outside_session_window", *METRICS,
]


def test_clean_summary(loaded):
    model, events = loaded
    found = ut.qa_summary(model, events).collect()
    assert [r.metric for r in found] == sorted(EXPECTED_NAMES) and len(found) == 31
    assert {r.metric: r.value for r in found} == clean()


def nulled(column, test):
    return lambda df: df.withColumn(column, F.when(~F.expr(test), F.col(column)))


FAULTS = {
    "user gone": ("dim_user", lambda d: d.where("user_id <> 'a'"), {"count_dim_user": -1, "orphans_fact_sessions_dim_user": 2}),
    "device gone": ("dim_device", lambda d: d.where("device_category <> 'mobile'"), {"count_dim_device": -1, "orphans_fact_sessions_dim_device": 1}),
    "geo gone": ("dim_geo", lambda d: d.where("country <> 'SE'"), {"count_dim_geo": -1, "orphans_fact_sessions_dim_geo": 1}),
    "source gone": ("dim_traffic_source", lambda d: d.where("traffic_source <> 'google'"), {"count_dim_traffic_source": -1, "orphans_fact_sessions_dim_traffic_source": 3}),
    "users twice": ("dim_user", lambda d: d.union(d), {"count_dim_user": 3, "dupes_dim_user_user_id": 3}),
    "sessions twice": ("fact_sessions", lambda d: d.union(d.where("user_id = 'a'")), {"count_fact_sessions": 2, "dupes_fact_sessions_session_key": 2}),
    "days thrice": ("fact_user_daily_activity", lambda d: d.union(d.where("user_id = 'b'")).union(d.where("user_id = 'b'")), {"count_fact_user_daily_activity": 2, "dupes_fact_user_daily_activity_user_day": 1}),
    "purchases twice": ("fact_purchases", lambda d: d.union(d), {"count_fact_purchases": 2, "dupes_fact_purchases_purchase_key": 2}),
    "session without user": ("fact_sessions", nulled("user_id", "session_key = 'b-1'"), {"nulls_fact_sessions_user_id": 1, "orphans_fact_sessions_dim_user": 1}),
    "session without id": ("fact_sessions", nulled("session_id", "user_id = 'a'"), {"nulls_fact_sessions_session_id": 2}),
    "session without start": ("fact_sessions", nulled("session_start_ts", "user_id = 'a'"), {"nulls_fact_sessions_session_start_ts": 2}),
    "session without date": ("fact_sessions", nulled("session_date", "user_id = 'a'"), {"nulls_fact_sessions_session_date": 2}),
    "session without geo": ("fact_sessions", nulled("geo_key", "user_id = 'a'"), {}),
    "day without user": ("fact_user_daily_activity", nulled("user_id", "user_id = 'c'"), {"nulls_fact_user_daily_activity_user_id": 1}),
    "day without date": ("fact_user_daily_activity", nulled("activity_date", "user_id = 'c'"), {"nulls_fact_user_daily_activity_activity_date": 1}),
    "purchase without user": ("fact_purchases", nulled("user_id", "user_id = 'a'"), {"nulls_fact_purchases_user_id": 1}),
    "purchase without time": ("fact_purchases", nulled("purchase_ts", "user_id = 'a'"), {"nulls_fact_purchases_purchase_ts": 1}),
    "purchase without date": ("fact_purchases", nulled("purchase_date", "user_id = 'a'"), {"nulls_fact_purchases_purchase_date": 1}),
    "purchase without revenue": ("fact_purchases", nulled("revenue", "user_id = 'a'"), {"nulls_fact_purchases_revenue": 1}),
    "steps late": ("fact_funnel_steps", lambda d: d.withColumn("step_ts", F.expr("if(funnel_step = 5, step_ts + interval 1 day, step_ts)")), {"funnel_steps_outside_session_window": 2}),
    "session gone": ("fact_sessions", lambda d: d.where("session_key <> 'c-1'"), {"count_fact_sessions": -1}),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_fault_moves_its_metrics_only(loaded, fault):
    model, events = loaded
    table, break_it, deltas = FAULTS[fault]
    found = dict(ut.qa_summary({**model, table: break_it(model[table])}, events).collect())
    moved = {name: found[name] - value for name, value in clean().items() if found[name] != value}
    assert moved == deltas


def test_late_steps_of_copied_sessions_count_per_pair(loaded):
    model, _ = loaded
    late = model["fact_funnel_steps"].withColumn("step_ts", F.expr("step_ts + interval 1 day"))
    sessions = model["fact_sessions"]
    assert ut.qa_steps_outside_session(late, sessions.union(sessions).union(sessions)).first()[0] == 18
    assert ut.qa_steps_outside_session(late.union(late), sessions).first()[0] == 12


def test_reconcile(loaded):
    model, events = loaded
    sessions, users, purchases = model["fact_sessions"], model["dim_user"], model["fact_purchases"]
    assert rows(ut.qa_reconcile(events, sessions, users)) == [
        ("events", 7, 7, 0, True), ("sessions", 4, 4, 0, True), ("users", 3, 3, 0, True),
    ]
    gone = ut.qa_reconcile(events, sessions.where("session_key <> 'a-1'"), users, purchases.union(purchases))
    assert rows(gone) == [
        ("events", 7, 4, -3, False), ("purchases", 2, 4, 2, False), ("sessions", 4, 3, -1, False),
        ("users", 3, 3, 0, True),
    ]
    # Stored slices reconcile like the events they count.
    slices = ut.enrich_events(ut.rollup_events(events.drop("device_key", "geo_key", "traffic_key", "session_key")))
    assert rows(ut.qa_reconcile(slices, sessions, users, purchases))[0] == ("events", 7, 7, 0, True)


def test_unkeyed_events(spark):
    events = enriched(
        spark,
        raw(None, "2020-01-01 10:00:00", "purchase"),
        raw("a", None),
        raw("a", "2020-01-01 10:00:00", session=None),
        raw(None, "2020-01-01 10:00:00", "purchase", txn="T1"),
    )
    assert dict(ut.qa_unkeyed(events).collect()) == {
        "unkeyed_events_user": 2, "unkeyed_events_date": 1, "unkeyed_events_session": 3, "unkeyed_events_purchase": 2,
    }


def test_dim_duplicates(loaded):
    model, _ = loaded
    twice = {name: table.union(table) for name, table in model.items()}
    assert set(dict(ut.qa_dim_duplicates(model).collect()).values()) == {0}
    assert dict(ut.qa_dim_duplicates(twice).collect())["extra_dupes_dim_date_date_day"] == 3


def test_empty_tables_give_zeros(spark, loaded):
    _, events = loaded
    empty = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    found = dict(ut.qa_summary(empty, events.limit(0)).collect())
    assert set(found) == set(EXPECTED_NAMES) and set(found.values()) == {0}
