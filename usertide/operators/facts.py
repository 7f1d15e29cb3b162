"""Fact builders over enriched events; all but the purchases also take enriched slices.

Where one dimension key must be chosen per group, it is that of the earliest event,
ties going to the smaller keys. The choice is made in two steps: first a hash
aggregation with the candidate attributes in the grouping, then, over the few
candidates left, hashing them to keys and taking a minimum over structs. A minimum
over structs alone would sort every event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.functions.columns import FUNNEL_STEPS, PURCHASE, is_event, purchase_key
from usertide.operators.staging import ALL_ATTRIBUTES, dimension_keys, with_measures
from usertide.schemas import DIM_KEYS, MONEY


def _purchases() -> Column:
    return F.expr(f"sum(if(event_name = '{PURCHASE}', event_count, 0L))")


def _revenue() -> Column:
    """Revenue of a group: NULL if it holds nothing but purchases without revenue."""
    zero = "if(event_count > purchase_count, 0, null)"
    return F.expr(f"coalesce(revenue, {zero})").cast(MONEY).alias("revenue")


def _earliest(*columns: str) -> Column:
    """Of the earliest event; those without a time come last."""
    return F.min(F.struct(F.col("first_ts").isNull().alias("untimed"), "first_ts", *columns)).alias("earliest")


def first_events(events: DataFrame, by: Sequence[str] = (), time: str = "event_ts_utc") -> DataFrame:
    """The first event of each session without a ``session_start``, as one.

    (session_key, user_id, event_name, event_date_utc, the time, and the columns ``by``).
    """
    columns = list(dict.fromkeys(["event_date_utc", "user_id", *by]))
    known = events.where(F.col("session_key").isNotNull())
    # Fixed-width buffers first; the minimum over structs sees the few candidates left.
    few = known.groupBy("session_key", *columns).agg(
        F.min(time).alias(time), F.bool_or(is_event("session_start")).alias("_started")
    )
    first = F.min(F.struct(F.col(time).isNull().alias("_untimed"), time, *columns)).alias("_first")
    opened = few.groupBy("session_key").agg(first, F.bool_or("_started").alias("_started")).where(~F.col("_started"))
    return opened.select(
        "session_key",
        F.lit("session_start").alias("event_name"),
        F.col(f"_first.{time}").alias(time),
        *[F.col(f"_first.{c}").alias(c) for c in columns],
    )


def build_fact_sessions(events: DataFrame, dim_keys: bool = True, within: Sequence[str] = ()) -> DataFrame:
    """One row per session key. ``dim_keys=False`` leaves out the three dimension keys.

    ``within`` names columns that a session key determines, such as the one the events are stored by: grouping by them as
    well spares the shuffle.
    """
    keys = dimension_keys() if dim_keys else {}
    identity = ["user_id", "ga_session_id", "ga_session_number"]
    candidates = (
        with_measures(events)
        .where(F.col("session_key").isNotNull())
        .groupBy(*within, "session_key", *identity, *(ALL_ATTRIBUTES if keys else []))
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.min("event_date_utc").alias("session_date"),
            F.sum("event_count").alias("event_count"),
            _purchases().alias("purchase_count"),
            F.sum("purchase_revenue").alias("revenue"),
        )
        .select("*", *[key.alias(name) for name, key in keys.items()])
    )
    sessions = candidates.groupBy(*within, "session_key").agg(
        _earliest(*identity, *keys),
        F.min("first_ts").alias("session_start_ts"),
        F.max("last_ts").alias("session_end_ts"),
        F.min("session_date").alias("session_date"),
        F.sum("event_count").alias("event_count"),
        F.sum("purchase_count").alias("purchase_count"),
        F.sum("revenue").alias("revenue"),
    )
    return sessions.select(
        "session_key",
        F.col("earliest.user_id").alias("user_id"),
        F.col("earliest.ga_session_id").alias("session_id"),
        F.col("earliest.ga_session_number").alias("session_number"),
        "session_start_ts",
        "session_end_ts",
        "session_date",
        *[F.col(f"earliest.{k}").alias(k) for k in keys],
        "event_count",
        "purchase_count",
        _revenue(),
    )


def build_fact_funnel_steps(
    events: DataFrame,
    steps: dict[str, int] = FUNNEL_STEPS,
    grain: str = "reference",
    first_event_starts: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """First time of each funnel step.

    With ``first_event_starts`` the first event of a session that has no ``session_start`` counts as one.

    ``grain='reference'`` has a row per session, date, dimension keys and step, so a
    session over midnight or with changing keys has several rows per step.
    ``grain='session_step'`` has exactly one, with date and keys of its earliest event. ``within`` is that of ``build_fact_sessions``;
    first events that count as starts are shuffled all the same.
    """
    names = list(steps)
    group = ["session_key", "user_id", "event_date_utc", *DIM_KEYS, "event_name"]
    step = F.create_map(*[F.lit(part) for item in steps.items() for part in item])[F.col("event_name")]
    measured = with_measures(events)
    named = measured.where(F.col("event_name").isin(names) & F.col("session_key").isNotNull())
    if first_event_starts:
        within = ()
        named = named.select(*group, "first_ts").unionByName(
            first_events(measured, DIM_KEYS, "first_ts").select(*group, "first_ts")
        )
    rows = named.groupBy(*within, *group).agg(F.min("first_ts").alias("first_ts"))
    if grain == "session_step":
        carried = ["event_date_utc", "user_id", *DIM_KEYS]
        rows = (
            rows.groupBy(*within, "session_key", "event_name")
            .agg(_earliest(*carried))
            .select("session_key", "event_name", "earliest.first_ts", *[f"earliest.{c}" for c in carried])
        )
    elif grain != "reference":
        raise ValueError(f"grain must be 'reference' or 'session_step', not {grain!r}")
    return rows.select(
        "session_key",
        "user_id",
        F.col("event_date_utc").alias("session_date"),
        step.cast("bigint").alias("funnel_step"),
        F.col("event_name").alias("funnel_event_name"),
        F.col("first_ts").alias("step_ts"),
        *DIM_KEYS,
    )


def build_fact_user_daily_activity(
    events: DataFrame, dim_keys: bool = True, within: Sequence[str] = (), parted: Sequence[str] = ()
) -> DataFrame:
    """One row per user and active date. ``dim_keys=False`` leaves out the dimension keys; ``within`` names columns that a user determines.

    ``parted`` names columns that the events are stored by, whatever a user has of them: candidates are then chosen where the events lie, without a shuffle.
    """
    # The funnel events of a group as one bit each: one small buffer instead of five.
    bits = {name: 1 << i for i, name in enumerate(FUNNEL_STEPS)}
    cases = " ".join(f"when '{name}' then {mask}" for name, mask in bits.items())
    bit = F.expr(f"case event_name {cases} else 0 end")
    rows = with_measures(events).where(F.col("user_id").isNotNull() & F.col("event_date_utc").isNotNull())
    group = [*within, "user_id", F.col("event_date_utc").alias("activity_date")]
    measures = [
        F.sum("event_count").alias("event_count"),
        F.bit_or(bit).alias("seen"),
        _purchases().alias("purchase_count"),
        F.sum("purchase_revenue").alias("revenue"),
    ]
    if dim_keys:
        candidates = rows.groupBy(*group, *parted, *ALL_ATTRIBUTES).agg(F.min("first_ts").alias("first_ts"), *measures)
        days = (
            candidates.withColumns(dimension_keys())
            .groupBy(*within, "user_id", "activity_date")
            .agg(
                _earliest(*DIM_KEYS),
                F.sum("event_count").alias("event_count"),
                F.bit_or("seen").alias("seen"),
                F.sum("purchase_count").alias("purchase_count"),
                F.sum("revenue").alias("revenue"),
            )
        )
    else:
        days = rows.groupBy(*group).agg(*measures)
    return days.select(
        "user_id",
        "activity_date",
        *([F.col(f"earliest.{k}").alias(k) for k in DIM_KEYS] if dim_keys else []),
        F.lit(True).alias("is_active"),
        "event_count",
        *[(F.col("seen").bitwiseAND(mask) > 0).alias(f"had_{name}") for name, mask in bits.items()],
        "purchase_count",
        _revenue(),
    )


def purchase_rows(events: DataFrame) -> DataFrame:
    """Every keyed purchase event as a purchase row, copies included."""
    # A row needs a user, and its key a transaction or a time. Tested on the inputs, so that the
    # scan can skip on it and no key is hashed twice.
    keyed = F.expr("user_id is not null and (transaction_id is not null or event_ts_utc is not null)")
    return events.where((F.col("event_name") == PURCHASE) & keyed).select(
        purchase_key().alias("purchase_key"),
        "user_id",
        F.col("event_ts_utc").alias("purchase_ts"),
        F.col("event_date_utc").alias("purchase_date"),
        "transaction_id",
        F.col("purchase_revenue").cast(MONEY).alias("revenue"),
        *DIM_KEYS,
        "session_key",
    )


def earliest_purchases(purchases: DataFrame) -> DataFrame:
    """One row per purchase key, the earliest.

    Ties go by user, session, higher revenue, then the keys. As an aggregate rather
    than a row number, copies of one key are reduced before the shuffle, so a key
    that holds a large share of the purchases does not crowd one task.
    """
    rest = [c for c in purchases.columns if c != "purchase_key"]
    order = F.struct(
        F.col("purchase_ts").isNull().alias("untimed"),
        "purchase_ts",
        "user_id",
        "session_key",
        F.col("revenue").isNull().alias("no_revenue"),
        (-F.col("revenue")).alias("less_revenue"),
        *DIM_KEYS,
        "transaction_id",
    )
    return (
        purchases.groupBy("purchase_key")
        .agg(F.min_by(F.struct(*rest), order).alias("kept"))
        .select("purchase_key", *[F.col(f"kept.{c}").alias(c) for c in rest])
    )


def build_fact_purchases(events: DataFrame) -> DataFrame:
    """One row per purchase key over all users, from enriched events."""
    return earliest_purchases(purchase_rows(events))
