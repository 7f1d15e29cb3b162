"""From nested raw events to flat, keyed events, and their rollup into slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.functions.columns import PURCHASE, attribute_key, micros_date, param_int, session_home, session_key
from usertide.schemas import DIM_ATTRIBUTES, MONEY


def stage_events(raw: DataFrame, tz: str = "UTC", keep: Sequence[str] = ()) -> DataFrame:
    """Flatten raw events to fifteen columns; a row-local select, no shuffle.

    ``tz`` is the reporting time zone of ``event_date_utc``; UTC unless chosen otherwise. ``keep`` names further columns to take along.
    """
    ts = "timestamp_micros(event_timestamp)"
    # From the microseconds, so that the zone of the session has no part in it.
    local = "event_timestamp" if tz == "UTC" else f"unix_micros(from_utc_timestamp({ts}, '{tz}'))"
    return raw.select(
        *[
            F.expr(source).alias(name)
            for name, source in {
                "user_id": "user_pseudo_id",
                "event_ts_utc": ts,
                "event_date_utc": micros_date(local),
                "event_name": "event_name",
                "platform": "platform",
                "device_category": "device.category",
                "country": "geo.country",
                "region": "geo.region",
                "traffic_source": "traffic_source.source",
                "traffic_medium": "traffic_source.medium",
                "traffic_campaign": "traffic_source.name",
            }.items()
        ],
        param_int("ga_session_id").alias("ga_session_id"),
        param_int("ga_session_number").alias("ga_session_number"),
        F.expr("ecommerce.transaction_id").alias("transaction_id"),
        F.expr("ecommerce.purchase_revenue").alias("purchase_revenue"),
        *keep,
    )


ALL_ATTRIBUTES = [attribute for _, attributes in DIM_ATTRIBUTES.values() for attribute in attributes]


def dimension_keys() -> dict[str, Column]:
    """The key of each hashed dimension, from its attributes."""
    return {key: attribute_key(*attributes) for key, attributes in DIM_ATTRIBUTES.values()}


def enrich_events(events: DataFrame) -> DataFrame:
    """Add dimension keys and the session key, and make revenue decimal.

    Works on staged events and on their slices alike: keys depend on the row only.
    """
    return events.withColumns(
        {
            "purchase_revenue": F.col("purchase_revenue").cast(MONEY),
            **dimension_keys(),
            "session_key": session_key(),
        }
    )


# What a slice holds fixed. Every dimension and every fact but the purchases can be
# derived from counts, time bounds and revenue at this grain.
SLICE_COLUMNS = [
    "user_id",
    "ga_session_id",
    "ga_session_number",
    "event_date_utc",
    "event_name",
    *ALL_ATTRIBUTES,
]


def with_measures(events: DataFrame) -> DataFrame:
    """Give single events the measures of a slice; slices, which have all four, pass unchanged.

    Revenue is that of purchases only, so other events add nothing to a sum.
    """
    if {"event_count", "first_ts", "last_ts", "purchase_revenue"} <= set(events.columns):
        return events
    return events.withColumns(
        {
            "event_count": F.lit(1).cast("bigint"),
            "first_ts": F.col("event_ts_utc"),
            "last_ts": F.col("event_ts_utc"),
            "purchase_revenue": F.when(
                F.col("event_name") == PURCHASE, F.col("purchase_revenue").cast(MONEY)
            ),
        }
    )


def gather_sessions(staged: DataFrame, column: str, partitions: int) -> DataFrame:
    """What a rollup needs of the events, those of a session in one partition, with the ``column`` that says in which.

    Events without a session are dealt to all partitions. Sessions are not cut: one that holds a large share of all events crowds one task.
    """
    revenue = F.when(F.col("event_name") == PURCHASE, F.col("purchase_revenue")).alias("purchase_revenue")
    homed = staged.select(*SLICE_COLUMNS, "event_ts_utc", revenue, session_home(*SLICE_COLUMNS).alias(column))
    return homed.repartition(partitions, column)


def rollup_events(staged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Staged events counted per user, session, date, event and attributes.

    One pass over the events feeds all tables. Rows are combined before the shuffle,
    and the fine grain spreads a crowded user or session over many reducers. All
    buffers are fixed width, so Spark aggregates by hash, without sorting. ``within`` names
    a column of gathered events; they are counted where they lie, and it stays among the columns.
    """
    return (
        with_measures(staged)
        .groupBy(*within, *SLICE_COLUMNS)
        .agg(
            F.sum("event_count").alias("event_count"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("purchase_revenue").alias("purchase_revenue"),
        )
    )
