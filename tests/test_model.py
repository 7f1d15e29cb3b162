import hashlib
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from helpers import enriched, raw, rows, staged
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import usertide as ut
from usertide.operators.facts import purchase_rows


def money(text):
    return Decimal(text).quantize(Decimal("1e-9"))


def both(spark, *events):
    """The same events as single events and as stored slices."""
    return [enriched(spark, *events), ut.enrich_events(ut.rollup_events(staged(spark, *events)))]


def test_dim_has_one_row_per_key(spark):
    for source in both(
        spark,
        raw("a", "2020-01-01 00:00:00", category=None),
        raw("a", "2020-01-01 00:00:01", category=""),
        raw("a", "2020-01-01 00:00:02", category="mobile"),
    ):
        attributes = ["device_category", "platform"]
        kept = ut.build_dim(source, "device_key", attributes)
        assert rows(kept, *attributes) == [("", "WEB"), ("mobile", "WEB")]
        every = ut.build_dim(source, "device_key", attributes, grain="reference")
        assert rows(every, *attributes) == [(None, "WEB"), ("", "WEB"), ("mobile", "WEB")]
        assert every.select("device_key").distinct().count() == 2


def test_dim_user(spark):
    for source in both(
        spark,
        raw("a", "2020-01-02 00:00:00", "purchase"),
        raw("a", "2020-01-01 10:00:00"),
        raw("a", "2020-01-03 10:00:00", "purchase"),
        raw("b", "2020-01-03 10:00:00", None),
        raw(None, "2020-01-03 10:00:00"),
    ):
        assert rows(ut.build_dim_user(source)) == [
            ("a", datetime(2020, 1, 1, 10), date(2020, 1, 1), datetime(2020, 1, 2), date(2020, 1, 2), True),
            ("b", datetime(2020, 1, 3, 10), date(2020, 1, 3), None, None, False),
        ]


def test_session_takes_all_keys_from_its_earliest_event(spark):
    events = [
        raw("a", "2020-01-01 23:59:00", category="mobile", country="SE", source="x"),
        raw("a", "2020-01-02 00:01:00", "purchase", category="desktop", country="NO", source="a", revenue=2.5),
        raw("a", "2020-01-02 00:02:00", "purchase"),
        raw("a", "2020-01-02 00:02:00", session=None),
    ]
    for source in both(spark, *events):
        (row,) = ut.build_fact_sessions(source).collect()
        assert (row.session_key, row.user_id, row.session_id, row.session_number) == ("a-1", "a", 1, 1)
        assert (row.session_start_ts, row.session_end_ts) == (datetime(2020, 1, 1, 23, 59), datetime(2020, 1, 2, 0, 2))
        assert row.session_date == date(2020, 1, 1)
        assert (row.event_count, row.purchase_count, row.revenue) == (3, 2, money("2.5"))
        first = source.orderBy("event_date_utc", *(["event_ts_utc"] if "event_ts_utc" in source.columns else [])).first()
        assert (row.device_key, row.geo_key, row.traffic_key) == (first.device_key, first.geo_key, first.traffic_key)


def test_revenue_is_null_only_without_any_amount(spark):
    for source in both(
        spark,
        raw("a", "2020-01-01 00:00:00", "purchase"),
        raw("b", "2020-01-01 00:00:00", "purchase"),
        raw("b", "2020-01-01 00:00:01", "view_item", revenue=5.0),
        raw("c", "2020-01-01 00:00:01", None),
        raw("d", "2020-01-01 00:00:00", "purchase", revenue=4.0),
        raw("d", "2020-01-01 00:00:01", "purchase"),
    ):
        wanted = [("a", None), ("b", money("0")), ("c", money("0")), ("d", money("4"))]
        assert rows(ut.build_fact_sessions(source), "user_id", "revenue") == wanted
        assert rows(ut.build_fact_user_daily_activity(source), "user_id", "revenue") == wanted
        assert rows(ut.build_fact_user_daily_activity(source, dim_keys=False), "user_id", "revenue") == wanted


def test_daily_activity_flags(spark):
    for source in both(
        spark,
        raw("a", "2020-01-01 00:00:00", "session_start"),
        raw("a", "2020-01-01 00:00:01", "begin_checkout"),
        raw("a", "2020-01-02 00:00:01", None),
        raw("a", "2020-01-03 00:00:01", "purchase", category="mobile"),
        raw("a", "2020-01-03 00:00:02", "add_to_cart"),
    ):
        found = rows(
            ut.build_fact_user_daily_activity(source),
            "activity_date", "had_session_start", "had_view_item", "had_add_to_cart", "had_begin_checkout",
            "had_purchase", "event_count", "purchase_count", "is_active",
        )
        assert found == [
            (date(2020, 1, 1), True, False, False, True, False, 2, 0, True),
            (date(2020, 1, 2), False, False, False, False, False, 1, 0, True),
            (date(2020, 1, 3), False, False, True, False, True, 2, 1, True),
        ]


def test_funnel_steps_grains(spark):
    for source in both(
        spark,
        raw("a", "2020-01-01 23:59:00", "view_item"),
        raw("a", "2020-01-02 00:01:00", "view_item"),
        raw("a", "2020-01-02 00:00:30", "view_item", category="mobile"),
        raw("a", "2020-01-02 00:05:00", "scroll"),
        raw("a", "2020-01-02 00:06:00", "purchase"),
        raw(None, "2020-01-02 00:06:00", "purchase"),
    ):
        columns = ["session_date", "funnel_step", "funnel_event_name", "step_ts"]
        assert rows(ut.build_fact_funnel_steps(source), *columns) == [
            (date(2020, 1, 1), 2, "view_item", datetime(2020, 1, 1, 23, 59)),
            (date(2020, 1, 2), 2, "view_item", datetime(2020, 1, 2, 0, 0, 30)),
            (date(2020, 1, 2), 2, "view_item", datetime(2020, 1, 2, 0, 1)),
            (date(2020, 1, 2), 5, "purchase", datetime(2020, 1, 2, 0, 6)),
        ]
        assert rows(ut.build_fact_funnel_steps(source, grain="session_step"), *columns) == [
            (date(2020, 1, 1), 2, "view_item", datetime(2020, 1, 1, 23, 59)),
            (date(2020, 1, 2), 5, "purchase", datetime(2020, 1, 2, 0, 6)),
        ]
    with pytest.raises(ValueError):
        ut.build_fact_funnel_steps(enriched(spark, raw("a", "2020-01-01 00:00:00")), grain="x")


def test_purchases_keep_the_earliest_per_key_over_users(spark):
    source = enriched(
        spark,
        raw("b", "2020-01-02 00:00:00", "purchase", txn="T1", revenue=1.0),
        raw("a", "2020-01-01 00:00:00", "purchase", txn="T1", revenue=2.0),
        raw("z", "2020-01-05 00:00:00", "purchase", txn="T2"),
        raw("y", "2020-01-05 00:00:00", "purchase", txn="T2", revenue=2.0),
        raw("y", "2020-01-05 00:00:00", "purchase", txn="T2", revenue=3.0),
        raw("y", "2020-01-05 00:00:00", "purchase", txn="T2"),
        raw("c", "2020-01-06 00:00:00", "purchase"),
        raw("c", "2020-01-06 00:00:00", "purchase"),
        raw(None, "2020-01-06 00:00:00", "purchase"),
        raw("c", "2020-01-06 00:00:00", "view_item", txn="T9"),
    )
    found = rows(ut.build_fact_purchases(source), "user_id", "transaction_id", "purchase_date", "revenue")
    assert found == [
        ("a", "T1", date(2020, 1, 1), money("2")),
        ("c", None, date(2020, 1, 6), None),
        ("y", "T2", date(2020, 1, 5), money("3")),
    ]
    assert purchase_rows(source).count() == 8


def test_insert_if_absent_null_rules(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    empty = spark.createDataFrame([], "k int")
    some = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(ut.insert_if_absent(new, empty, ["k"])) == [(1, "a"), (2, "b")]
    assert rows(ut.insert_if_absent(new, some, ["k"])) == [(2, "b")]


def test_insert_if_absent_compares_columns_not_text(spark):
    new = spark.createDataFrame([("a|b", "c")], "x string, y string")
    old = spark.createDataFrame([("a", "b|c")], "x string, y string")
    assert ut.insert_if_absent(new, old, ["x", "y"]).count() == 1


def store_rows(model):
    return {name: rows(table) for name, table in model.items()}


FIRST = [
    raw("a", "2020-01-01 10:00:00", "session_start"),
    raw("a", "2020-01-01 10:01:00", "view_item"),
    raw("b", "2020-01-02 10:00:00", "session_start", country="SE"),
]
LATE = [
    raw("a", "2020-01-01 11:00:00", "purchase", txn="T1", revenue=3.0),
    raw("c", "2020-01-03 10:00:00", "session_start", category="mobile"),
]


@pytest.mark.parametrize("partitioned", [True, False])
def test_pipeline_full_incremental_and_rerun(spark, tmp_path, partitioned):
    from helpers import raw_frame

    store = ut.TableStore(spark, root=f"{tmp_path}/dw", partitioned=partitioned)
    work = f"{tmp_path}/work"
    model = ut.run_pipeline(spark, raw_frame(spark, *FIRST), store, work)
    assert rows(model["dim_user"], "user_id", "is_purchaser") == [("a", False), ("b", False)]

    everything = raw_frame(spark, *FIRST, *LATE)
    model = ut.run_pipeline(spark, everything, store, work, mode="incremental")
    # Known users, sessions and days stay as loaded; new keys and the purchase arrive.
    assert rows(model["dim_user"], "user_id", "is_purchaser") == [("a", False), ("b", False), ("c", False)]
    assert rows(model["fact_sessions"], "user_id", "event_count") == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(model["fact_user_daily_activity"], "user_id", "purchase_count") == [("a", 0), ("b", 0), ("c", 0)]
    assert rows(model["fact_purchases"], "purchase_key") == [("T1",)]
    assert rows(model["fact_funnel_steps"], "user_id", "funnel_step") == [
        ("a", 1), ("a", 2), ("a", 5), ("b", 1), ("c", 1)
    ]
    before = store_rows(model)
    assert store_rows(ut.run_pipeline(spark, everything, store, work, mode="incremental")) == before

    full = ut.run_pipeline(spark, everything, store, work, mode="full", staged_events=f"{tmp_path}/ev")
    assert rows(full["dim_user"], "user_id", "is_purchaser") == [("a", True), ("b", False), ("c", False)]
    assert rows(full["fact_sessions"], "user_id", "event_count") == [("a", 3), ("b", 1), ("c", 1)]
    assert spark.read.parquet(f"{tmp_path}/ev").count() == 5
    # Tables from stored slices equal tables from single events.
    events = enriched(spark, *FIRST, *LATE)
    for name, table in ut.build_model(events, events).items():
        assert rows(full[name]) == rows(table.select(*full[name].columns)), name


def test_pipeline_reads_shards(spark, tmp_path):
    from helpers import raw_frame

    raw_frame(spark, *FIRST).write.parquet(f"{tmp_path}/src/events_20200101")
    raw_frame(spark, *LATE).write.parquet(f"{tmp_path}/src/events_20200103")
    model = ut.run_pipeline(
        spark, f"{tmp_path}/src", f"{tmp_path}/dw", f"{tmp_path}/w", start="2020-01-03", end="2020-01-04"
    )
    assert rows(model["dim_user"], "user_id") == [("a",), ("c",)]


def test_store_creates_missing_tables(spark, tmp_path):
    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    with pytest.raises(AnalysisException):  # a mistyped place is no clean table
        store.read("dim_user")
    assert store.read("dim_user", missing_ok=True).count() == 0 and not store.holds_rows()
    store.create_missing()
    store.create_missing()
    assert all((tmp_path / "dw" / name).is_dir() for name in store.model())
    assert all(table.count() == 0 for table in store.model().values())
    with pytest.raises(ValueError):
        ut.TableStore(spark)


def test_a_failed_full_load_leaves_the_old_tables(spark, tmp_path):
    from helpers import raw_frame

    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    ut.run_pipeline(spark, raw_frame(spark, *FIRST), store, f"{tmp_path}/w1")
    before = {name: rows(table) for name, table in store.model().items()}
    events = enriched(spark, *FIRST, *LATE)
    model = ut.build_model(events, events)
    model["fact_purchases"] = model["fact_purchases"].withColumn("user_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL in required column|user_id"):
        ut.load_model(store, model)
    assert {name: rows(table) for name, table in store.model().items()} == before


def test_a_full_load_of_some_days_is_refused_where_there_are_rows(spark, tmp_path):
    from helpers import raw_frame

    for event in (*FIRST, *LATE):
        day = datetime.fromtimestamp(event["event_timestamp"] / 1e6, timezone.utc).strftime("%Y%m%d")
        raw_frame(spark, event).write.mode("append").parquet(f"{tmp_path}/export/events_{day}")
    days = sorted(p.name[-8:] for p in (tmp_path / "export").iterdir())
    first = f"{days[0][:4]}-{days[0][4:6]}-{days[0][6:]}"
    args = (spark, f"{tmp_path}/export", f"{tmp_path}/dw")
    ut.run_pipeline(*args, f"{tmp_path}/w1", start=first, end=first)
    with pytest.raises(ValueError, match="would drop the other days"):
        ut.run_pipeline(*args, f"{tmp_path}/w2", start=first, end=first)
    ut.run_pipeline(*args, f"{tmp_path}/w3", mode="incremental")


def test_purchases_without_a_user_do_not_end_a_load(spark, tmp_path):
    from helpers import raw_frame

    events = [*FIRST, raw(None, "2020-01-01 10:00:00", "purchase", txn="T9"), raw("x", None, "purchase", txn="T8")]
    model = ut.run_pipeline(spark, raw_frame(spark, *events), f"{tmp_path}/dw", f"{tmp_path}/w")
    keys = [r.purchase_key for r in model["fact_purchases"].collect()]
    assert "T9" not in keys and "T8" in keys


def test_dates_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        events = staged(spark, raw("a", "2020-01-01 02:00:00.5", "purchase"), raw("a", "1969-12-31 23:59:59", "purchase"))
        assert rows(events, "event_date_utc") == [(date(1969, 12, 31),), (date(2020, 1, 1),)]
        local = events.select(ut.to_reporting_date(F.col("event_ts_utc"), "Asia/Kolkata"))
        assert rows(local) == [(date(1970, 1, 1),), (date(2020, 1, 1),)]
        keys = rows(ut.enrich_events(events).select(ut.functions.columns.purchase_key()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    texts = ["a|2020-01-01 02:00:00.500+00", "a|1969-12-31 23:59:59+00"]
    assert keys == sorted((hashlib.md5(t.encode()).hexdigest(),) for t in texts)


def test_an_increment_reads_the_stored_rows_of_its_dates_only(spark, tmp_path):
    events = enriched(spark, *FIRST, *LATE)
    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    days = ut.build_fact_user_daily_activity(events)
    store.write(days, "fact_user_daily_activity", "overwrite")
    some = date(2020, 1, 1)
    plans = []
    write, store.write = store.write, lambda df, *_: plans.append(df._jdf.queryExecution().executedPlan().toString())
    store.insert(days, "fact_user_daily_activity", ["user_id", "activity_date"], (some, some))
    assert "activity_date" in plans[0] and ">= 2020-01-01" in plans[0].split("PartitionFilters: [", 1)[1].split("]")[0]


def test_marts_at_rest(spark, tmp_path):
    events = enriched(spark, *FIRST, *LATE)
    marts = ut.build_marts(ut.build_model(events, events))
    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    store.publish(marts)
    store.publish(marts)  # replaces
    for name, mart in marts.items():
        assert rows(ut.TableStore(spark, root=f"{tmp_path}/dw").read_mart(name)) == rows(mart)
    spark.sql(f"CREATE DATABASE marts LOCATION '{tmp_path}/marts'")
    ut.TableStore(spark, database="marts").publish(marts)
    assert spark.table("marts.mrt_funnel_daily").count() == marts["mrt_funnel_daily"].count()
    spark.sql("DROP DATABASE marts CASCADE")


def test_rebuild_purchases_in_place(spark, tmp_path):
    from usertide.plans.pipeline import rebuild_purchases

    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    events = enriched(
        spark,
        raw("a", "2020-01-02 00:00:00", "purchase", txn="T1"),
        raw("a", "2020-01-01 00:00:00", "purchase", txn="T1"),
    )
    store.write(purchase_rows(events), "fact_purchases", "overwrite")
    assert store.read("fact_purchases").count() == 2
    assert rows(rebuild_purchases(store, f"{tmp_path}/work"), "purchase_date") == [(date(2020, 1, 1),)]


def test_views_are_reachable_by_name(spark):
    events = enriched(spark, raw("a", "2020-01-01 10:00:00"))
    ut.publish_views({"dim_user": ut.build_dim_user(events)})
    assert spark.sql("select count(*) from dim_user").first()[0] == 1


@pytest.mark.parametrize("buckets", [None, 4])
def test_catalog_tables(spark, tmp_path, buckets):
    from helpers import raw_frame

    database = f"dw_{buckets}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}'")
    store = ut.TableStore(spark, database=database, buckets=buckets)
    store.create_missing()
    assert store.read("fact_sessions").count() == 0
    ut.run_pipeline(spark, raw_frame(spark, *FIRST), store, f"{tmp_path}/w", mode="incremental")
    model = ut.run_pipeline(spark, raw_frame(spark, *FIRST, *LATE), store, f"{tmp_path}/w", mode="incremental")
    assert rows(model["fact_sessions"], "user_id", "event_count") == [("a", 2), ("b", 1), ("c", 1)]
    assert spark.table(f"{database}.dim_user").count() == 3
    if buckets:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = ut.churn_proxy(model["dim_user"], model["fact_user_daily_activity"])._jdf.queryExecution()
            # Users and their days meet in their buckets; only the last date is gathered.
            assert "Exchange hashpartitioning" not in plan.executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    full = ut.run_pipeline(spark, raw_frame(spark, *FIRST, *LATE), store, f"{tmp_path}/w", mode="full")
    assert rows(full["fact_sessions"], "user_id", "event_count") == [("a", 3), ("b", 1), ("c", 1)]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_marts_as_views(spark):
    events = enriched(spark, *FIRST, *LATE)
    ut.publish_views(ut.build_marts(ut.build_model(events, events)))
    assert spark.sql("select sum(sessions) from mrt_funnel_daily").first()[0] == 3
    assert spark.sql("select count(*) from mrt_churn_proxy").first()[0] == 3
    assert spark.sql("select wau from mrt_wow_kpis").first()[0] == 3


def test_pipeline_with_gap_sessions_and_dedup(spark, tmp_path):
    from helpers import raw_frame

    events = raw_frame(
        spark,
        raw("a", "2020-01-01 10:00:00", session=5),
        raw("a", "2020-01-01 10:00:00", session=5, platform="APP"),
        raw("a", "2020-01-01 12:00:00", session=None),
        raw("a", "2020-01-01 12:20:00", session=None),
    )
    model = ut.run_pipeline(
        spark, events, f"{tmp_path}/dw", f"{tmp_path}/w", session_gap="30 minutes", dedup=True
    )
    assert rows(model["fact_sessions"], "session_key", "event_count") == [("a-1577880000000000", 2), ("a-5", 1)]
    assert rows(model["dim_device"], "platform") == [("APP",), ("WEB",)]


def test_a_table_that_cannot_take_its_place_leaves_the_old_one(spark, tmp_path):
    store = ut.TableStore(spark, root=f"{tmp_path}/dw")
    events = enriched(spark, *FIRST)
    store.replace({"dim_user": ut.build_dim_user(events)})
    before = rows(store.read("dim_user"))
    with pytest.raises(Exception, match="could not move"):
        store._adopt("dim_user")  # nothing lies beside it
    assert rows(store.read("dim_user")) == before and len(before) == 2
