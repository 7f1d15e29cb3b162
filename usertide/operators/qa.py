"""Data-quality checks over the star schema and the events it came from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.functions.columns import PURCHASE, is_event, purchase_key


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def qa_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, cnt) of each table."""
    return _union(
        [
            table.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
            for name, table in tables.items()
        ]
    )


def qa_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often; empty when clean."""
    return df.groupBy(*keys).agg(F.count("*").alias("dup_cnt")).where(F.col("dup_cnt") > 1)


def qa_nulls(df: DataFrame, columns: Sequence[str], total: str = "total_rows") -> DataFrame:
    """One row with the row count and the NULL count of each column."""
    return df.agg(
        F.count("*").alias(total), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def qa_orphans(
    fact: DataFrame,
    fk: str,
    dim: DataFrame,
    pk: str | None = None,
    null_fk_is_orphan: bool = False,
    name: str = "orphans",
    weight: str | None = None,
) -> DataFrame:
    """How many fact rows have no row in the dimension; ``weight`` names a column that counts them.

    Facts are counted per foreign key before the anti join, so a key most facts share
    is one row by then, whatever join Spark picks.
    """
    pk = pk or fk
    per_key = fact.groupBy(F.col(fk).alias("_key")).agg((F.sum(weight) if weight else F.count("*")).alias("_rows"))
    missing = per_key.join(dim.select(F.col(pk).alias("_key")), "_key", "left_anti")
    # Left out here rather than by a filter, which would make the scans of several checks differ.
    rows = F.col("_rows") if null_fk_is_orphan else F.when(F.col("_key").isNotNull(), F.col("_rows"))
    return missing.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias(name))


def qa_steps_outside_session(steps: DataFrame, sessions: DataFrame) -> DataFrame:
    """How many funnel steps lie before the start or after the end of their session.

    Equal rows are counted up on both sides first, so copies of one session's rows
    multiply as numbers, not as joined rows.
    """
    # Dealt by session first, the groupings and the join need no further shuffle.
    steps, sessions = steps.repartition("session_key"), sessions.repartition("session_key")
    times = steps.groupBy("session_key", "step_ts").agg(F.count("*").alias("_steps"))
    windows = sessions.groupBy("session_key", "session_start_ts", "session_end_ts").agg(
        F.count("*").alias("_sessions")
    )
    outside = (F.col("step_ts") < F.col("session_start_ts")) | (F.col("step_ts") > F.col("session_end_ts"))
    pairs = times.join(windows, "session_key").where(outside)
    return pairs.agg(
        F.coalesce(F.sum(F.col("_steps") * F.col("_sessions")), F.lit(0))
        .cast("bigint")
        .alias("funnel_steps_outside_session_window")
    )


def _event_totals(events: DataFrame) -> DataFrame:
    """Events, purchases, distinct sessions and distinct users, one row in one pass.

    Two distinct counts over the events would double every row; over the distinct
    pairs of user and session they double only those.
    """
    one = "event_count" if "event_count" in events.columns else "1L"
    pairs = events.groupBy("user_id", "session_key").agg(
        F.expr(f"sum({one})").alias("events"),
        F.expr(f"sum(if(event_name = '{PURCHASE}', {one}, 0L))").alias("purchases"),
    )
    return pairs.agg(
        F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("events"),
        F.coalesce(F.sum("purchases"), F.lit(0)).cast("bigint").alias("purchases"),
        F.countDistinct("session_key").alias("sessions"),
        F.countDistinct("user_id").alias("users"),
    )


def qa_reconcile(
    events: DataFrame, sessions: DataFrame, users: DataFrame, purchases: DataFrame | None = None
) -> DataFrame:
    """(metric, from_events, from_model, diff, ok) for events, sessions and users.

    With ``purchases`` there is a fourth row: purchase events against purchase rows.
    They differ by the copies and unkeyed purchases that the purchase grain leaves out.
    """

    def totals(side: str, row: DataFrame) -> DataFrame:
        return row.unpivot([], row.columns, "metric", side)

    modeled = [
        sessions.agg(
            F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("events"),
            F.count("*").alias("sessions"),
        ),
        users.agg(F.count("*").alias("users")),
    ]
    if purchases is not None:
        modeled.append(purchases.agg(F.count("*").alias("purchases")))
    left = totals("from_events", _event_totals(events))
    right = _union([totals("from_model", row) for row in modeled])
    return left.join(right, "metric").withColumns(
        {"diff": F.col("from_model") - F.col("from_events"), "ok": F.col("from_model") == F.col("from_events")}
    )


def qa_purchase_grain(purchases: DataFrame) -> DataFrame:
    """One row: how many purchase keys are duplicated, how many purchases lack revenue."""
    per_key = purchases.groupBy("purchase_key").agg(
        F.count("*").alias("rows"), F.count_if(F.col("revenue").isNull()).alias("no_revenue")
    )
    return per_key.agg(
        F.count_if(F.col("rows") > 1).alias("dup_purchase_keys"),
        F.coalesce(F.sum("no_revenue"), F.lit(0)).cast("bigint").alias("purchase_null_revenue_cnt"),
    )


def qa_unkeyed(events: DataFrame) -> DataFrame:
    """(metric, value): events the loads leave out because a key part is NULL."""
    bought = is_event(PURCHASE)
    row = events.agg(
        F.count_if(F.col("user_id").isNull()).alias("unkeyed_events_user"),
        F.count_if(F.col("event_date_utc").isNull()).alias("unkeyed_events_date"),
        F.count_if(F.col("session_key").isNull()).alias("unkeyed_events_session"),
        F.count_if(bought & (F.col("user_id").isNull() | purchase_key().isNull())).alias("unkeyed_events_purchase"),
    )
    return row.unpivot([], row.columns, "metric", "value")


# Which keys and columns the summary watches.
_UNIQUE = {
    "dim_user": ["user_id"],
    "fact_sessions": ["session_key"],
    "fact_user_daily_activity": ["user_id", "activity_date"],
    "fact_purchases": ["purchase_key"],
}
_UNIQUE_LABEL = {
    "dim_user": "user_id",
    "fact_sessions": "session_key",
    "fact_user_daily_activity": "user_day",
    "fact_purchases": "purchase_key",
}
_WATCHED = {
    "fact_sessions": ["user_id", "session_id", "session_start_ts", "session_date"],
    "fact_user_daily_activity": ["user_id", "activity_date"],
    "fact_purchases": ["user_id", "purchase_ts", "purchase_date", "revenue"],
}
_SESSION_DIMS = {
    "dim_user": "user_id",
    "dim_device": "device_key",
    "dim_geo": "geo_key",
    "dim_traffic_source": "traffic_key",
}
_DIM_UNIQUE = {
    "dim_date": "date_day",
    "dim_device": "device_key",
    "dim_geo": "geo_key",
    "dim_traffic_source": "traffic_key",
}


def _long(row: DataFrame) -> DataFrame:
    return row.unpivot([], row.columns, "metric", "value")


def _table_metrics(name: str, table: DataFrame) -> DataFrame:
    """Row count, duplicated keys and NULL counts of one table in one pass."""
    count = f"count_{name}"
    if name not in _UNIQUE:
        return table.agg(F.count("*").alias(count))
    nulls = {f"nulls_{name}_{c}": F.count_if(F.col(c).isNull()) for c in _WATCHED.get(name, [])}
    per_key = table.groupBy(*_UNIQUE[name]).agg(
        F.count("*").alias("_rows"), *[test.alias(metric) for metric, test in nulls.items()]
    )

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return per_key.agg(
        total("_rows").alias(count),
        F.count_if(F.col("_rows") > 1).alias(f"dupes_{name}_{_UNIQUE_LABEL[name]}"),
        *[total(metric).alias(metric) for metric in nulls],
    )


def qa_summary(model: dict[str, DataFrame], events: DataFrame) -> DataFrame:
    """The 31 metrics of a load as (metric, value), ordered by name."""
    sessions = model["fact_sessions"]
    frames = [_table_metrics(name, table) for name, table in model.items()]
    # One count per set of foreign keys serves all four: Spark reuses its shuffle.
    per_keys = sessions.groupBy(*_SESSION_DIMS.values()).agg(F.count("*").alias("_rows"))
    frames += [
        qa_orphans(
            per_keys,
            fk,
            model[dim],
            null_fk_is_orphan=dim == "dim_user",
            name=f"orphans_fact_sessions_{dim}",
            weight="_rows",
        )
        for dim, fk in _SESSION_DIMS.items()
    ]
    frames.append(
        _event_totals(events).select(
            F.col("events").alias("recon_events_cnt"),
            F.col("sessions").alias("recon_sessions_distinct_from_events"),
            F.col("users").alias("recon_users_distinct_from_events"),
        )
    )
    frames.append(qa_steps_outside_session(model["fact_funnel_steps"], sessions))
    return _union([_long(frame) for frame in frames]).orderBy("metric")


def qa_dim_duplicates(model: dict[str, DataFrame]) -> DataFrame:
    """(metric, value): duplicated keys of the other dimensions, which the summary does not watch."""
    return _union(
        [
            _long(qa_duplicates(model[name], [key]).agg(F.count("*").alias(f"extra_dupes_{name}_{key}")))
            for name, key in _DIM_UNIQUE.items()
        ]
    )
