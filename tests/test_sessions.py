import random

import pytest
from helpers import enriched, micros, raw, rows, staged

import usertide as ut


def test_gap_of_thirty_minutes_stays_one_microsecond_more_splits(spark):
    events = staged(
        spark,
        raw("a", "2020-01-01 10:10:00"),
        raw("a", "2020-01-01 10:40:00"),
        raw("a", "2020-01-01 11:10:00.000001"),
        raw("b", "2020-01-01 10:11:00"),
        raw(None, "2020-01-01 10:11:00"),
    )
    assert rows(ut.sessionize(events), "user_id", "event_ts_utc", "session_id") == sorted(
        [
            (None, *rows(events.where("user_id is null"), "event_ts_utc")[0], None),
            *[
                (u, t, micros(s))
                for (u, t), s in zip(
                    rows(events.where("user_id is not null"), "user_id", "event_ts_utc"),
                    ["2020-01-01 10:10:00", "2020-01-01 10:10:00", "2020-01-01 11:10:00.000001", "2020-01-01 10:11:00"],
                )
            ],
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_native_id_wins_and_fills_the_rest(spark):
    events = staged(
        spark,
        raw("a", "2020-01-01 10:00:00", session=7),
        raw("a", "2020-01-01 10:10:00", session=None),
        raw("a", "2020-01-01 12:00:00", session=None),
    )
    found = rows(ut.sessionize(events, native_col="ga_session_id"), "event_ts_utc", "session_id")
    assert [s for _, s in found] == [7, micros("2020-01-01 10:00:00"), micros("2020-01-01 12:00:00")]


@pytest.mark.parametrize("gap, seconds", [("30 minutes", 1800), ("45 seconds", 45), ("1 day", 86400)])
def test_sessions_equal_a_walk_over_each_user(spark, gap, seconds):
    rng = random.Random(seconds)
    start = micros("1969-12-31 00:00:00") if seconds == 1800 else micros("2020-01-01 00:00:00")
    times = {f"u{i}": [start + rng.randrange(40 * seconds) * 1_000_000 for _ in range(60)] for i in range(5)}
    times["u0"] += [start + n * seconds * 1_000_000 for n in range(5)]
    frame = spark.createDataFrame([(u, t) for u, found in times.items() for t in found], "user_id string, t bigint")
    events = frame.selectExpr("user_id", "t", "timestamp_micros(t) as event_ts_utc")
    wanted = []
    for user, found in times.items():
        current = last = None
        for t in sorted(found):
            if last is None or t - last > seconds * 1_000_000:
                current = t
            wanted.append((user, t, current))
            last = t
    assert sorted(map(tuple, ut.sessionize(events, gap).select("user_id", "t", "session_id").collect())) == sorted(wanted)


def test_session_start_prefers_the_start_event(spark):
    events = enriched(
        spark,
        raw("a", "2020-01-01 10:00:00"),
        raw("a", "2020-01-01 10:05:00", "session_start"),
        raw("b", "2020-01-01 10:07:00"),
        raw("c", "2020-01-01 10:07:00", session=None),
    )
    assert [(k, t.minute, f) for k, t, f in rows(ut.session_starts(events))] == [("a-1", 5, True), ("b-1", 7, False)]


def test_dedup_keeps_one_row_per_identity(spark):
    events = enriched(
        spark,
        raw("a", "2020-01-01 10:00:00", "purchase", txn="T1", revenue=2.0),
        raw("a", "2020-01-01 10:00:00", "purchase", txn="T1", revenue=1.0),
        raw("a", "2020-01-01 10:00:00", "purchase", txn="T2", revenue=1.0),
        raw("a", "2020-01-01 10:00:00", "purchase", session=None),
        raw("a", "2020-01-01 10:00:00", "purchase", session=None),
    )
    kept = ut.dedup_events(events)
    assert kept.columns == events.columns
    assert [(t, r and float(r)) for t, r in rows(kept, "transaction_id", "purchase_revenue")] == [
        (None, None), ("T1", 1.0), ("T2", 1.0),
    ]
