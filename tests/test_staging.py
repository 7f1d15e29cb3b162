from datetime import date, datetime
from decimal import Decimal
from hashlib import md5

import pytest
from helpers import enriched, raw, raw_frame, rows, staged
from pyspark.sql import functions as F

import usertide as ut
from usertide.functions.columns import purchase_key, sunday_week, timestamp_text
from usertide.schemas import TABLES


def test_staging_flattens_and_uses_utc(spark):
    frame = staged(spark, raw("u", "2020-12-31 23:59:59.123456", session=7, number=2, revenue=6.55, txn="T1"))
    (row,) = frame.collect()
    assert frame.columns == [
        "user_id", "event_ts_utc", "event_date_utc", "event_name", "platform", "device_category", "country",
        "region", "traffic_source", "traffic_medium", "traffic_campaign", "ga_session_id", "ga_session_number",
        "transaction_id", "purchase_revenue",
    ]
    assert row.event_ts_utc.microsecond == 123456
    assert row.event_date_utc == date(2020, 12, 31)
    assert (row.ga_session_id, row.ga_session_number, row.transaction_id, row.purchase_revenue) == (7, 2, "T1", 6.55)


@pytest.mark.parametrize(
    "params, wanted",
    [
        (None, None),
        ([], None),
        ([("other", 5)], None),
        ([("other", 5), ("ga_session_id", 6)], 6),
        ([("ga_session_id", 6), ("ga_session_id", 7)], 6),
        ([("ga_session_id", None)], None),
        ([(None, 5), ("ga_session_id", 6)], 6),
    ],
)
def test_parameter_lookup(spark, params, wanted):
    (row,) = staged(spark, raw("u", "2020-01-01 00:00:00", params=params)).collect()
    assert row.ga_session_id == wanted


def test_keys_hash_null_as_empty(spark):
    found = enriched(
        spark,
        raw("u", "2020-01-01 00:00:00", category=None, region=None, campaign=None, session=3),
        raw("u", "2020-01-01 00:00:01", category="", region="", campaign="", session=3),
        raw(None, "2020-01-01 00:00:02", session=3),
        raw("u", "2020-01-01 00:00:03", session=None),
    ).orderBy("event_ts_utc").collect()
    assert found[0].device_key == found[1].device_key == md5(b"|WEB").hexdigest()
    assert found[0].geo_key == md5(b"NO|").hexdigest()
    assert found[0].traffic_key == md5(b"google|organic|").hexdigest()
    assert [r.session_key for r in found] == ["u-3", "u-3", None, None]


def test_revenue_becomes_decimal(spark):
    (row,) = enriched(spark, raw("u", "2020-01-01 00:00:00", "purchase", revenue=0.1)).collect()
    assert row.purchase_revenue == Decimal("0.100000000")


@pytest.mark.parametrize(
    "ts, text",
    [
        ("2020-11-01 00:00:20", "2020-11-01 00:00:20+00"),
        ("2020-11-01 00:00:20.123", "2020-11-01 00:00:20.123+00"),
        ("2020-11-01 00:00:20.123400", "2020-11-01 00:00:20.123400+00"),
    ],
)
def test_timestamp_text_and_fallback_key(spark, ts, text):
    frame = staged(spark, raw("u", ts))
    (row,) = frame.select(F.expr(timestamp_text("event_ts_utc")).alias("t"), purchase_key().alias("k")).collect()
    assert row.t == text
    assert row.k == md5(f"u|{text}".encode()).hexdigest()


def test_sunday_week_over_years(spark):
    days = spark.sql("select explode(sequence(date'2015-01-01', date'2030-12-31')) as d")
    found = days.select("d", sunday_week(F.col("d")).alias("w")).collect()
    assert all(r.w == int(r.d.strftime("%U")) for r in found)


def test_dim_date_attributes(spark):
    (row,) = ut.build_dim_date(enriched(spark, raw("u", "2021-01-02 12:00:00"))).collect()
    assert tuple(row) == (date(2021, 1, 2), 2021, 1, 1, "January", 0, 7, "Saturday", True)


def test_reporting_date(spark):
    frame = staged(spark, raw("u", "2020-07-01 02:30:00"))
    (row,) = frame.select(
        ut.to_reporting_date(F.col("event_ts_utc")).alias("utc"),
        ut.to_reporting_date(F.col("event_ts_utc"), "America/New_York").alias("ny"),
    ).collect()
    assert (row.utc, row.ny) == (date(2020, 7, 1), date(2020, 6, 30))
    (row,) = ut.stage_events(raw_frame(spark, raw("u", "2020-07-01 02:30:00")), "America/New_York").collect()
    assert row.event_date_utc == date(2020, 6, 30)


def test_read_events_prunes_shards_and_columns(spark, tmp_path):
    for day in ("2020-11-01", "2020-11-02", "2020-11-04"):
        frame = raw_frame(spark, raw(day, f"{day} 10:00:00"))
        frame.write.parquet(f"{tmp_path}/events_{day.replace('-', '')}")
    everything = ut.read_events(spark, str(tmp_path))
    assert rows(everything, "user_pseudo_id") == [("2020-11-01",), ("2020-11-02",), ("2020-11-04",)]
    some = ut.read_events(spark, str(tmp_path), "2020-11-02", "2020-11-04")
    assert rows(some, "user_pseudo_id") == [("2020-11-02",), ("2020-11-04",)]
    with pytest.raises(ValueError):
        ut.read_events(spark, str(tmp_path), start="2020-11-02")
    plan = ut.stage_events(everything).select("user_id", "ga_session_id")._jdf.queryExecution().toString()
    read = plan[plan.rindex("ReadSchema") :]
    assert "struct<key:string,value:struct<int_value:bigint>>" in read
    assert "device" not in read and "string_value" not in read


def test_write_events_by_date(spark, tmp_path):
    events = enriched(spark, raw("a", "2020-11-01 10:00:00"), raw("b", "2020-11-02 10:00:00"))
    ut.write_events(events, f"{tmp_path}/e")
    back = spark.read.parquet(f"{tmp_path}/e")
    assert back.where("event_date_utc = date'2020-11-02'").count() == 1
    assert sorted(p.name for p in (tmp_path / "e").glob("event_date*")) == [
        "event_date_utc=2020-11-01",
        "event_date_utc=2020-11-02",
    ]


def test_conform_orders_casts_and_rejects_null(spark):
    schema = TABLES["dim_device"]
    frame = spark.createDataFrame([("WEB", "k", "desktop")], "platform string, device_key string, device_category string")
    assert ut.conform(frame, schema).collect()[0] == ("k", "desktop", "WEB")
    bad = spark.createDataFrame([("WEB", None, "desktop")], "platform string, device_key string, device_category string")
    with pytest.raises(Exception, match="NULL in required column device_key"):
        ut.conform(bad, schema).collect()


def test_rollup_keeps_counts_bounds_and_revenue(spark):
    slices = ut.rollup_events(
        staged(
            spark,
            raw("u", "2020-01-01 00:00:00", "purchase", revenue=1.5),
            raw("u", "2020-01-01 00:00:09", "purchase", revenue=2.0),
            raw("u", "2020-01-01 00:00:05", "view_item", revenue=9.0),
        )
    )
    assert rows(slices, "event_name", "event_count", "first_ts", "last_ts", "purchase_revenue") == [
        ("purchase", 2, datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 0, 9), Decimal("3.500000000")),
        ("view_item", 1, datetime(2020, 1, 1, 0, 0, 5), datetime(2020, 1, 1, 0, 0, 5), None),
    ]
