"""Loads of a snapshot store: in full, only what is absent, or merged with what is there.

All three write new folders and commit one manifest. An insert asks the key filters first: only new rows that may be stored already
are joined, and only with the parts that may hold them. A merge brings late events in: what the delta alone would give is combined with the
stored rows of its users, sessions, steps and purchases, and its user days are recomputed from the stored rollup. Parts in which a stored
row changes are written anew; others keep their folders, and get one more for new rows.

Joins by keys ask for a merge of shuffled sides. Keys grow with the events and lie compressed in files, so Spark would broadcast many times
the bytes that its threshold means, and all of them would pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.operators.facts import _earliest, build_fact_user_daily_activity, earliest_purchases
from usertide.operators.staging import enrich_events
from usertide.schemas import DIM_ATTRIBUTES, DIM_KEYS, LOAD_KEYS
from usertide.sources.events import store_events, stored_by
from usertide.sources.snapshots import FILTER_KEYS, ROLLUP, Change, SnapshotStore
from usertide.sources.tables import insert_if_absent


# Combining what is stored with what a delta alone gives ------------------------


def merge_dim_users(rows: DataFrame) -> DataFrame:
    """One row per user: first of the firsts."""
    firsts = ["first_seen_ts", "first_seen_date", "first_purchase_ts", "first_purchase_date"]
    return rows.groupBy("user_id").agg(*[F.min(c).alias(c) for c in firsts], F.bool_or("is_purchaser").alias("is_purchaser"))


def merge_dims(rows: DataFrame, key: str, attributes: list[str], grain: str) -> DataFrame:
    """One row per key, that with values rather than NULLs; or each distinct one."""
    rows = rows.select(key, *attributes).distinct()
    if grain == "reference":
        return rows
    best = Window.partitionBy(key).orderBy(*[F.col(a).desc_nulls_last() for a in attributes])
    return rows.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def merge_sessions(rows: DataFrame) -> DataFrame:
    """One row per session: bounds and sums of its parts, identity and keys of the earliest one.

    A part's revenue is NULL only if it holds nothing but purchases without revenue, so a sum that skips NULLs is that of the whole.
    """
    named = ["user_id", "session_id", "session_number", *DIM_KEYS]
    timed = rows.withColumn("first_ts", F.col("session_start_ts"))
    whole = timed.groupBy("session_key").agg(
        _earliest(*named),
        F.min("session_start_ts").alias("session_start_ts"),
        F.max("session_end_ts").alias("session_end_ts"),
        F.min("session_date").alias("session_date"),
        *[F.sum(c).alias(c) for c in ("event_count", "purchase_count", "revenue")],
    )
    return whole.select("*", *[F.col(f"earliest.{c}").alias(c) for c in named]).select(*rows.columns)


def merge_steps(rows: DataFrame, grain: str) -> DataFrame:
    """The first time of each step, by the grain that ``build_fact_funnel_steps`` has."""
    if grain == "reference":
        fixed = [c for c in rows.columns if c != "step_ts"]
        return rows.groupBy(*fixed).agg(F.min("step_ts").alias("step_ts")).select(*rows.columns)
    carried = ["session_date", "user_id", *DIM_KEYS]
    timed = rows.withColumn("first_ts", F.col("step_ts"))
    whole = timed.groupBy("session_key", "funnel_step", "funnel_event_name").agg(_earliest(*carried))
    named = [F.col(f"earliest.{c}").alias(c) for c in carried]
    return whole.select("*", F.col("earliest.first_ts").alias("step_ts"), *named).select(*rows.columns)


# Loads -------------------------------------------------------------------------


def _named_parts(store: SnapshotStore, table: str, rows: DataFrame) -> list[str]:
    """The names of the parts that rows lie in; as many as there are dates or buckets."""
    return [r[0] for r in rows.select(store.part_of(table)).distinct().collect()]


def _keys(table: str, rows: DataFrame) -> DataFrame:
    """The filtered keys of rows that a load gives; only steps repeat theirs."""
    keys = rows.select(*FILTER_KEYS[table])
    return keys if LOAD_KEYS[table] == FILTER_KEYS[table] else keys.distinct()


def _hits(store: SnapshotStore, table: str, rows: DataFrame, work: str) -> list[str]:
    """The names of the stored parts that may hold keys among ``rows``.

    Which keys these are is not asked, so none is shuffled for it: only their hashes are.
    """
    found = store.may_hold(table, _keys(table, rows)).select("part").distinct()
    return [r[0] for r in store_events(found, f"{work}/{table}_hits").collect()]


def insert_absent(change: Change, table: str, rows: DataFrame, work: str) -> None:
    """Add the rows whose key the table does not hold.

    Where the key says in which part a row lies, only the parts of the new rows are read; else those that the filters name. What a
    filter names wrongly is told apart by the join.
    """
    store, keys, place = change.store, LOAD_KEYS[table], f"{work}/{table}_new"
    if table not in FILTER_KEYS:
        rows = store_events(rows, place)
        stored = store.read(table, missing_ok=True, parts=_named_parts(store, table, rows))
        change.put(table, insert_if_absent(rows, stored if table.startswith("dim_") else stored.hint("merge"), keys), drop=[])
        return
    # Sessions and steps come by session, and stay so: neither their keys nor they are shuffled again for the filters and the join.
    by = "session_key" if FILTER_KEYS[table] == ["session_key"] else None
    with stored_by(rows, place, by) if by else nullcontext(store_events(rows, place)) as rows:
        # One join: to part the doubtful rows from the others first would shuffle all of them twice more.
        stored = store.read(table, missing_ok=True, parts=_hits(store, table, rows, work)).hint("merge")
        change.put(table, insert_if_absent(rows, stored, keys, by if len(keys) > 1 else None), drop=[])


def merge_rows(
    change: Change, table: str, delta: DataFrame, combine: Callable[[DataFrame], DataFrame] | None, keys: list[str], work: str
) -> None:
    """Combine a delta's rows with the stored ones of the same ``keys``; without ``combine`` they take their place.

    Only parts with a stored row of these keys are written anew, whatever else they hold being copied.
    """
    store = change.store
    delta = store_events(delta, f"{work}/{table}_delta")
    parts = _hits(store, table, delta, work) if table in FILTER_KEYS else _named_parts(store, table, delta)
    wanted = (_keys(table, delta) if table in FILTER_KEYS else delta.select(*keys)).hint("merge")
    same = store.read(table, missing_ok=True, parts=parts).join(wanted, keys, "left_semi").select(*delta.columns)
    same = store_events(same, f"{work}/{table}_same")
    changed = _named_parts(store, table, same)
    # What these parts hold of the delta's keys is known by now, often far less than the delta.
    found = same.select(*keys).distinct().hint("merge")
    copied = store.read(table, missing_ok=True, parts=changed).join(found, keys, "left_anti").select(*delta.columns)
    merged = combine(same.unionByName(delta)) if combine else delta
    change.put(table, copied.unionByName(merged.select(*delta.columns)), drop=changed)


def merge_small(change: Change, table: str, delta: DataFrame, combine: Callable[[DataFrame], DataFrame], work: str) -> None:
    """Combine a table of one part with a delta; written anew only if a row is new or changes."""
    stored = change.store.read(table, missing_ok=True)
    whole = store_events(combine(stored.unionByName(delta.select(*stored.columns))), f"{work}/{table}_whole")
    if not whole.exceptAll(stored.select(*whole.columns)).isEmpty() or not change.store.parts(table):
        change.put(table, whole)


def merge_model(
    change: Change, model: dict[str, DataFrame], rolled: DataFrame, dim_grain: str, funnel_grain: str, work: str
) -> None:
    """Merge what a delta of events alone gives, ``model`` and its rollup ``rolled``, into the stored tables."""
    store = change.store
    if change.before["version"] and ROLLUP not in change.before["tables"]:
        raise ValueError("there is no rollup to merge into: an incremental load came between; load in full once")

    def days(_: str) -> None:
        # The rollup adds up, so a delta's slices are one more folder of their dates. On dates it does not hold yet, the delta's days are whole.
        alone, day = model["fact_user_daily_activity"], F.col("event_date_utc")
        keyed = rolled.where(F.col("user_id").isNotNull() & day.isNotNull())
        held = store.parts(ROLLUP)
        old = [r[0] for r in keyed.select(day).distinct().collect() if r[0].isoformat() in held]
        again = keyed.where(day.isin(old))
        slices = store.read(ROLLUP, missing_ok=True, parts=[d.isoformat() for d in old]).unionByName(again)
        slices = slices.join(again.select("user_id", day).distinct().hint("merge"), ["user_id", "event_date_utc"], "left_semi")
        whole = build_fact_user_daily_activity(enrich_events(slices))
        whole = alone.where(~F.col("activity_date").isin(old)).unionByName(whole) if old else alone
        merge_rows(change, "fact_user_daily_activity", whole, None, ["user_id", "activity_date"], work)

    def rows(combine: Callable[[DataFrame], DataFrame]) -> Callable[[str], None]:
        return lambda table: merge_rows(change, table, model[table], combine, FILTER_KEYS[table], work)

    def dim(table: str) -> None:
        key, attributes = DIM_ATTRIBUTES[table]
        merge_small(change, table, model[table], lambda both: merge_dims(both, key, attributes, dim_grain), work)

    steps: dict[str, Callable[[str], None]] = {
        "dim_date": lambda table: merge_small(change, table, model[table], DataFrame.distinct, work),
        **dict.fromkeys(DIM_ATTRIBUTES, dim),
        "dim_user": rows(merge_dim_users),
        "fact_sessions": rows(merge_sessions),
        "fact_funnel_steps": rows(lambda both: merge_steps(both, funnel_grain)),
        "fact_user_daily_activity": days,
        "fact_purchases": rows(earliest_purchases),
        ROLLUP: lambda table: change.put(table, rolled, drop=[]),
    }
    with ThreadPoolExecutor(len(steps)) as pool:
        list(pool.map(lambda table: steps[table](table), steps))


def load_snapshot(
    store: SnapshotStore,
    model: dict[str, DataFrame],
    rolled: DataFrame,
    work: str,
    mode: str = "full",
    dim_grain: str = "key",
    funnel_grain: str = "reference",
    progress: tuple[str, int] | None = None,
) -> int:
    """Load the tables that events give, and their rollup, and return the new version.

    ``full`` replaces all; ``incremental`` adds absent keys and never changes a row, and leaves the rollup out of the new version;
    ``merge`` takes events that were not loaded before, of any date, and gives what a full load of all of them would. A merge that ran twice counts twice; ``progress``, a stream's name
    and batch, is committed with the version, so that a stream can tell.
    """
    if mode not in ("full", "incremental", "merge"):
        raise ValueError(f"mode must be 'full', 'incremental' or 'merge', not {mode!r}")
    change = store.change(mode)
    if mode == "merge":
        merge_model(change, model, rolled, dim_grain, funnel_grain, work)
    else:

        def load(table: str) -> None:
            if mode == "full":
                change.put(table, rolled if table == ROLLUP else model[table])
            else:
                insert_absent(change, table, model[table], work)

        tables = [*model, ROLLUP] if mode == "full" else [*model]
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(load, tables))
        if mode == "incremental":
            change.leave_out(ROLLUP)
    if progress:
        change.manifest["streams"] = change.manifest.get("streams", {}) | {progress[0]: progress[1]}
    return change.commit()
