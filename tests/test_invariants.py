"""Relations that must hold between tables and marts built from the given events."""

import pytest
from pyspark.sql import functions as F

import usertide as ut
from workload.fixture import enriched_events, raw_events


@pytest.fixture(scope="module")
def events(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ev"))
    return ut.store_events(enriched_events(spark, sf_dir), path)


@pytest.fixture(scope="module")
def model(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("dw")
    return ut.run_pipeline(spark, raw_events(spark, sf_dir), f"{base}/dw", f"{base}/work")


@pytest.fixture(scope="module")
def marts(model):
    return ut.build_marts(model)


def test_every_row_of_the_table_is_an_event(spark, sf_dir, events):
    assert events.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


# Events with a user and a time; the others are in no user day.
DATED = "user_id is not null and event_ts_utc is not null"


def test_facts_account_for_all_keyed_events(events, model):
    total = events.agg(
        F.count("session_key"),
        F.count_if(F.expr(DATED)),
        F.count_if((F.col("event_name") == "purchase") & F.expr(DATED)),
    ).first()
    sessions = model["fact_sessions"].agg(F.sum("event_count")).first()[0]
    days = model["fact_user_daily_activity"].agg(F.sum("event_count"), F.sum("purchase_count")).first()
    assert sessions == total[0]
    assert tuple(days) == (total[1], total[2])
    revenue = events.where(f"event_name = 'purchase' and {DATED}").agg(F.sum("purchase_revenue")).first()[0]
    assert model["fact_user_daily_activity"].agg(F.sum("revenue")).first()[0] == revenue


def test_purchase_rows_are_fewer_than_purchase_events_but_keep_all_keys(events, model):
    before = ut.purchase_rows(events)
    after = model["fact_purchases"]
    assert after.count() == before.select("purchase_key").distinct().count() < before.count()


def test_clean_load_has_no_faults(events, model):
    found = dict(ut.qa_summary(model, events).collect())
    assert len(found) == 31
    faults = {n: v for n, v in found.items() if not n.startswith(("count_", "recon_", "nulls_fact_purchases_revenue"))}
    assert set(faults.values()) == {0}
    assert found["count_fact_sessions"] == found["recon_sessions_distinct_from_events"]
    assert found["count_dim_user"] == found["recon_users_distinct_from_events"]


def test_funnel_never_grows_by_step(marts):
    growing = (
        "sessions_view_item > sessions or sessions_add_to_cart > sessions_view_item "
        "or sessions_begin_checkout > sessions_add_to_cart or sessions_purchase > sessions_begin_checkout"
    )
    assert marts["mrt_funnel_daily"].where(growing).count() == 0


def test_all_users_are_active_in_their_first_week(marts):
    first = marts["mrt_retention_cohorts"].where("week_index = 0")
    assert first.where("retention_rate <> 1").count() == 0
    assert first.agg(F.sum("cohort_size")).first()[0] == marts["mrt_churn_proxy"].count()


def test_longer_inactivity_implies_shorter(marts):
    assert marts["mrt_churn_proxy"].where("churn_60d > churn_30d or churn_30d > churn_14d").count() == 0


def test_new_and_returning_add_up(model):
    split = ut.new_vs_returning(model["fact_user_daily_activity"], model["dim_user"])
    assert split.where("new_users + returning_users <> active_users").count() == 0
    assert split.agg(F.sum("new_users")).first()[0] == model["dim_user"].count()


def test_gap_sessions_partition_the_events(events):
    found = ut.sessionize(events)
    assert found.count() == events.count()
    assert found.where(f"session_id is null and {DATED}").count() == 0
    assert found.where(f"session_id is not null and not ({DATED})").count() == 0
    # A longer gap never gives more sessions.
    counts = [
        ut.sessionize(events, gap).select("user_id", "session_id").distinct().count()
        for gap in ("10 minutes", "30 minutes", "1 day")
    ]
    assert counts == sorted(counts, reverse=True)
