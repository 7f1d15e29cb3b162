"""Gap sessions, session starts and event de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _micros(gap: str) -> int:
    """Length of an interval text such as '30 minutes' in microseconds."""
    words = gap.split()
    unit = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[words[1].rstrip("s")]
    return int(words[0]) * unit * 1_000_000


def sessionize(events: DataFrame, gap: str = "30 minutes", native_col: str | None = None) -> DataFrame:
    """Add ``session_id``: the native id where present, else the start of the user's gap session.

    A session ends when the user is idle for more than ``gap``; its derived id is its
    first event's time in microseconds. Events are first put in time buckets as wide as
    the gap. Two events of a bucket are never further apart than the gap, so a session
    can only split between buckets, and only the bounds per user and bucket, found by a
    plain aggregate, need ordering. No window ever runs over a user's events: its rows
    per user are bounded by the calendar, however many events a user has.
    """
    width = _micros(gap)
    at = F.unix_micros("event_ts_utc")
    # Integer arithmetic; a double would lose microseconds. pmod also floors times before 1970.
    located = events.withColumn("_bucket", at - F.pmod(at, F.lit(width)))

    bounds = (
        located.where(F.col("user_id").isNotNull() & at.isNotNull())
        .groupBy("user_id", "_bucket")
        .agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    )
    by_time = Window.partitionBy("user_id").orderBy("_bucket")
    idle = F.col("_lo") - F.lag("_hi").over(by_time)
    opened = bounds.withColumn("_opens", F.when(idle.isNull() | (idle > width), F.col("_lo")))
    starts = opened.select(
        F.col("user_id").alias("_user"),
        F.col("_bucket").alias("_at"),
        F.last("_opens", ignorenulls=True)
        .over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_derived"),
    )

    # Only rows that need a derived id, and can get one, take part in the join. The
    # rest would add nothing but a shuffle, and NULL users would all meet in one task.
    native = F.col(native_col).cast("bigint") if native_col else F.lit(None).cast("bigint")
    needs = native.isNull() & F.col("user_id").isNotNull() & at.isNotNull()
    match = (F.col("user_id") == F.col("_user")) & (F.col("_bucket") == F.col("_at"))
    derived = located.where(needs).join(starts, match, "left")
    return (
        events.where(~needs)
        .withColumn("session_id", native)
        .unionByName(derived.select(*events.columns, F.col("_derived").alias("session_id")))
    )


def fill_sessions(staged: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Staged events with ``ga_session_id`` filled from gap sessions where it is missing."""
    filled = F.col("session_id").alias("ga_session_id")
    return sessionize(staged, gap, "ga_session_id").select(
        *[filled if c == "ga_session_id" else F.col(c) for c in staged.columns]
    )


def session_starts(events: DataFrame) -> DataFrame:
    """Start of each session: its first ``session_start`` event, else its first event."""
    marked = F.min(F.when(F.col("event_name") == "session_start", F.col("event_ts_utc")))
    return (
        events.where(F.col("session_key").isNotNull())
        .groupBy("session_key")
        .agg(
            F.coalesce(marked, F.min("event_ts_utc")).alias("session_start_ts"),
            F.bool_or(F.coalesce(F.col("event_name") == "session_start", F.lit(False))).alias("has_start_event"),
        )
    )


def dedup_events(
    events: DataFrame,
    keys: tuple[str, ...] = ("user_id", "event_ts_utc", "event_name", "ga_session_id", "transaction_id"),
    required: tuple[str, ...] = ("user_id", "event_ts_utc", "event_name"),
) -> DataFrame:
    """One row per event identity; of differing copies the smallest row is kept.

    Events that lack a ``required`` part of the identity cannot be told to be copies and all stay.
    Copies are reduced before the shuffle, so a group of many copies is no hot spot.
    """
    rest = [c for c in events.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    kept = events.where(known).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    kept = kept.select(*[F.col(f"_kept.{c}").alias(c) if c in rest else F.col(c) for c in events.columns])
    return kept.unionByName(events.where(~known))
