"""Loading the star schema: in full, or only what is absent."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.operators.dims import build_dim, build_dim_date, build_dim_user
from usertide.operators.facts import (
    build_fact_funnel_steps,
    build_fact_purchases,
    build_fact_sessions,
    build_fact_user_daily_activity,
    earliest_purchases,
)
from usertide.operators.marts import churn_proxy, funnel_daily, retention_cohorts, retention_curve, wow_kpis
from usertide.operators.sessionize import dedup_events, fill_sessions
from usertide.operators.staging import enrich_events, gather_sessions, rollup_events, stage_events
from usertide.schemas import DIM_ATTRIBUTES, LOAD_KEYS
from usertide.plans.snapshot_loads import load_snapshot
from usertide.session import prepare, shared_dir
from usertide.sources.events import home_partitions, read_back, read_events, store_events, stored_by, write_events
from usertide.sources.snapshots import SnapshotStore
from usertide.sources.tables import HOME, TableStore


#: The column that the slices of a load are stored by.
SESSION_HOME = "session_home"

# Fixed value: the last week of a cohort in its mart.
MART_WEEKS = 12


def build_model(
    slices: DataFrame,
    events: DataFrame,
    dim_grain: str = "key",
    funnel_grain: str = "reference",
    within: Sequence[str] = (),
    session_home: str | None = None,
) -> dict[str, DataFrame]:
    """The nine tables, dimensions first, from enriched slices and enriched events.

    ``within`` names the column that stored slices are bucketed by, if they are, and users lie whole in the buckets; ``session_home`` one where
    only sessions do. Only the purchases need single events. To derive everything without a stored
    rollup, pass the enriched events twice.
    """
    model = {"dim_date": build_dim_date(slices)}
    for name, (key, attributes) in DIM_ATTRIBUTES.items():
        model[name] = build_dim(slices, key, attributes, dim_grain)
    model["dim_user"] = build_dim_user(slices, within)
    in_sessions = slices
    if session_home:  # the same text as the key; by this name Spark knows that the rows lie by it
        in_sessions = slices.where(F.col("session_key").isNotNull()).withColumn("session_key", F.col(session_home))
    model["fact_sessions"] = build_fact_sessions(in_sessions, within=within)
    model["fact_funnel_steps"] = build_fact_funnel_steps(in_sessions, grain=funnel_grain, within=within)
    model["fact_user_daily_activity"] = build_fact_user_daily_activity(slices, within=within, parted=[session_home] if session_home else [])
    model["fact_purchases"] = build_fact_purchases(events)
    return model


def load_model(
    store: TableStore, model: dict[str, DataFrame], mode: str = "full", dates: tuple[date, date] | None = None
) -> None:
    """Write the tables: ``full`` replaces them, ``incremental`` adds absent keys only.

    A full load replaces the tables once all nine are written, so a failure while writing leaves the old ones.
    An incremental load never changes a loaded row, so a late event of a known user,
    session or day has no effect; one that broke off can simply be run again. ``dates`` are the first and
    last date of its events, if they are known.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")

    # The tables do not depend on each other: their jobs share the cluster, so small ones
    # fill the gaps large ones leave. Dimensions are there before the facts that name them.
    if mode == "full":
        store.replace(model, tasks=5)
        return

    def load(name: str) -> None:
        store.insert(model[name], name, LOAD_KEYS[name], dates)

    for prefix in ("dim_", "fact_"):
        group = [name for name in model if name.startswith(prefix)]
        with ThreadPoolExecutor(len(group)) as pool:
            list(pool.map(load, group))


def run_pipeline(
    spark: SparkSession,
    src: str | DataFrame,
    out: str | TableStore | SnapshotStore,
    work: str | None = None,
    mode: str = "full",
    start: str | None = None,
    end: str | None = None,
    dim_grain: str = "key",
    funnel_grain: str = "reference",
    staged_events: str | None = None,
    session_gap: str | None = None,
    dedup: bool = False,
    progress: tuple[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Load all tables from raw events and return them.

    ``src`` is a folder of day shards, which ``start`` and ``end`` narrow, or a raw
    frame. A full load of some days alone would lose all others, so it is refused where there are rows. ``out`` is a folder or a store; a
    ``SnapshotStore`` gets a new version of all tables at once, and takes ``mode="merge"`` too, for events that it does not hold yet. ``work`` is a folder on shared storage, of this
    load alone; unless given, a new one under ``spark.checkpoint.dir``. The rollup of the
    events is written there once and all tables but the purchases read it, so the raw
    events are scanned twice rather than once per table. ``staged_events`` names a folder
    that also keeps the enriched events, by date. ``session_gap``, such as '30 minutes',
    derives a session id for events without one; ``dedup`` first drops repeated events. ``progress``, a stream's name and
    the number of its batch, is noted in the version of a snapshot store that the load makes.
    """
    prepare(spark)
    store = TableStore(spark, root=out) if isinstance(out, str) else out
    if mode == "merge" and (not isinstance(store, SnapshotStore) or session_gap or dedup):
        raise ValueError("mode='merge' needs a SnapshotStore, and events whose sessions and copies do not depend on other events")
    if mode == "full" and start is not None and store.holds_rows():
        raise ValueError("a full load of given days would drop the other days of these tables; use mode='incremental'")
    work = (work or shared_dir(spark)).rstrip("/")
    raw = read_events(spark, src, start, end) if isinstance(src, str) else src
    staged = stage_events(raw)
    # What takes a shuffle of the events is written, since it is read more than once below.
    if dedup:
        staged = store_events(dedup_events(staged), f"{work}/unique_events")
    if session_gap:
        # Read three times from here: once flat, rather than the nested events each time.
        staged = staged if dedup else store_events(staged, f"{work}/flat_events")
        staged = fill_sessions(staged, session_gap)
    events = enrich_events(staged)
    if staged_events:
        in_date_order = isinstance(src, str) and not (dedup or session_gap)
        write_events(events, staged_events, rebalance=not in_date_order)
        events = read_back(spark, events, staged_events)
    elif session_gap:
        events = store_events(events, f"{work}/enriched_events")
    if isinstance(store, TableStore) and store.buckets:
        _load(store, store.keep_slices(rollup_events(events)), events, work, mode, dim_grain, funnel_grain, within=[HOME])
        return store.model()
    # One shuffle of the events for all of slices, sessions and steps.
    gathered = gather_sessions(events, SESSION_HOME, home_partitions(spark))
    with stored_by(rollup_events(gathered, [SESSION_HOME]), f"{work}/event_slices", SESSION_HOME) as rolled:
        _load(store, rolled, events, work, mode, dim_grain, funnel_grain, session_home=SESSION_HOME, progress=progress)
    return store.model()


def _load(
    store: TableStore | SnapshotStore,
    rolled: DataFrame,
    events: DataFrame,
    work: str,
    mode: str,
    dim_grain: str,
    funnel_grain: str,
    within: Sequence[str] = (),
    session_home: str | None = None,
    progress: tuple[str, int] | None = None,
) -> None:
    """Load all tables from a stored rollup and the events."""
    slices = enrich_events(rolled)
    model = build_model(slices, events, dim_grain, funnel_grain, within, session_home)
    if isinstance(store, SnapshotStore):
        load_snapshot(store, model, rolled.drop(SESSION_HOME), work, mode, dim_grain, funnel_grain, progress)
        return
    dates = None
    if mode == "incremental":
        bounds = slices.agg(F.min("event_date_utc"), F.max("event_date_utc")).first()
        dates = tuple(bounds) if bounds[0] else None
    load_model(store, model, mode, dates)


def build_marts(model: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five reporting marts over the tables, by name, ready for ``publish_views`` or ``TableStore.publish``.

    The cohort mart holds weeks 0 to 12.
    """
    users, days = model["dim_user"], model["fact_user_daily_activity"]
    cohorts = retention_cohorts(users, days, max_index=MART_WEEKS)
    return {
        "mrt_funnel_daily": funnel_daily(model["fact_funnel_steps"]),
        "mrt_retention_cohorts": cohorts,
        "mrt_retention_curve": retention_curve(cohorts),
        "mrt_churn_proxy": churn_proxy(users, days),
        "mrt_wow_kpis": wow_kpis(days, model["fact_sessions"]),
    }


def rebuild_purchases(store: TableStore, work: str) -> DataFrame:
    """Reduce the stored purchases to the earliest row per key, in place.

    Loads keep that grain by themselves; this mends a table filled in another way.
    """
    store.rebuild(earliest_purchases(store.read("fact_purchases")), "fact_purchases", f"{work.rstrip('/')}/purchases")
    return store.read("fact_purchases")
