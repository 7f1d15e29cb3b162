"""Dimension builders. Each takes enriched events, or enriched slices of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.functions.columns import PURCHASE, attribute_key, is_event, sunday_week
from usertide.operators.staging import with_measures


def build_dim_date(events: DataFrame, contiguous: bool = False) -> DataFrame:
    """One row per date that has events, with its calendar attributes.

    ``contiguous=True`` also fills the dates between the first and the last.
    """
    day = F.col("date_day")
    days = events.select(F.col("event_date_utc").alias("date_day")).where(day.isNotNull()).distinct()
    if contiguous:
        bounds = days.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    return days.select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).alias("week"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def build_dim(events: DataFrame, key: str, attributes: list[str], grain: str = "key") -> DataFrame:
    """Distinct attributes under their hashed key.

    A NULL and an empty attribute share one key. ``grain='key'`` keeps one row per key,
    so joins cannot fan out; ``'reference'`` keeps each distinct set of attributes.
    """
    # Hashing after the distinct hashes a few rows instead of every event.
    rows = events.select(*attributes).distinct().select(attribute_key(*attributes).alias(key), *attributes)
    if grain == "reference":
        return rows
    if grain != "key":
        raise ValueError(f"grain must be 'key' or 'reference', not {grain!r}")
    # The row with values rather than NULLs wins. A window, because Spark would drop the
    # distinct below an aggregate that ignores duplicates, and sort all events by key.
    best = Window.partitionBy(key).orderBy(*[F.col(a).desc_nulls_last() for a in attributes])
    return rows.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def build_dim_user(events: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """First sight, first purchase and purchaser flag of every known user. ``within`` names columns that a user determines."""
    bought = is_event(PURCHASE)
    return (
        with_measures(events)
        .where(F.col("user_id").isNotNull())
        .groupBy(*within, "user_id")
        .agg(
            F.min("first_ts").alias("first_seen_ts"),
            F.min("event_date_utc").alias("first_seen_date"),
            F.min(F.when(bought, F.col("first_ts"))).alias("first_purchase_ts"),
            F.min(F.when(bought, F.col("event_date_utc"))).alias("first_purchase_date"),
            F.bool_or(bought).alias("is_purchaser"),
        )
        .drop(*within)
    )
