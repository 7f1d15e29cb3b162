"""Every operator as a query over the given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import usertide as ut
from usertide.operators.sketches import overlap_bound, rank_bound, users_bound
from usertide.plans.pipeline import MART_WEEKS
from usertide.schemas import DIM_ATTRIBUTES, DIM_KEYS, LOAD_KEYS
from usertide.session import shared_dir, prepare
from usertide.sources.events import store_events
from usertide.sources.snapshots import FILTER_KEYS
from workload.fixture import enriched_events, raw_events, staged_events

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the last date of the first of two loads.
FIRST_LOAD_UNTIL = "2020-12-30"

# First and last day of the shards to read.
SHARD_DAYS = ("2020-11-20", "2020-12-10")

REPORTING_TZ = "Asia/Kolkata"


def comparable(df: DataFrame) -> DataFrame:
    """Types that compare across engines: bigint, rounded double, timestamp without zone; amounts as text, whole."""
    columns = []
    for field in df.schema.fields:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, T.DecimalType):
            name = f"cast(cast({name} as decimal(38, 9)) as string) as {name}"
        elif isinstance(kind, T.DoubleType):
            name = f"round({name}, 9) as {name}"
        elif isinstance(kind, T.IntegerType):
            name = f"cast({name} as bigint) as {name}"
        elif isinstance(kind, T.TimestampType):
            name = f"cast({name} as timestamp_ntz) as {name}"
        columns.append(name)
    return df.selectExpr(*columns)


def on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies an operator to the enriched events."""
    return lambda spark, sf_dir: comparable(operator(enriched_events(spark, sf_dir)))


def users_of(events: DataFrame) -> DataFrame:
    return ut.build_dim_user(events)


def days_of(events: DataFrame) -> DataFrame:
    """User days without dimension keys, which the marts do not use."""
    return ut.build_fact_user_daily_activity(events, dim_keys=False)


def sessions_of(events: DataFrame) -> DataFrame:
    return ut.build_fact_sessions(events, dim_keys=False)


def dim_of(name: str, grain: str = "key") -> Callable[[DataFrame], DataFrame]:
    key, attributes = DIM_ATTRIBUTES[name]
    return lambda events: ut.build_dim(events, key, attributes, grain)


# Loads -----------------------------------------------------------------------


def second_load(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A table after a load up to a date and a second, insert-only load of everything."""

    def run(events: DataFrame) -> DataFrame:
        loaded = build(events.where(F.col("event_date_utc") <= F.lit(FIRST_LOAD_UNTIL).cast("date")))
        return loaded.unionByName(ut.insert_if_absent(build(events), loaded, LOAD_KEYS[name]))

    return on_events(run)


def load(*modes: str) -> Query:
    """Row counts of the stored tables after loads in these modes.

    A full load that an incremental one follows takes only the first part of the events.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_events(spark, sf_dir)
        early = early_events(raw)
        base = shared_dir(spark)
        store = ut.TableStore(spark, root=f"{base}/dw", partitioned=False)
        for i, mode in enumerate(modes):
            source = early if mode == "full" and len(modes) > 1 else raw
            model = ut.run_pipeline(spark, source, store, f"{base}/work{i}", mode)
        return ut.qa_row_counts(model)

    return run


_stored: dict[tuple[str, ...], dict[str, DataFrame]] = {}


def early_events(raw: DataFrame) -> DataFrame:
    return raw.where(ut.to_reporting_date(F.timestamp_micros("event_timestamp")) <= F.lit(FIRST_LOAD_UNTIL).cast("date"))


def stored_model(spark: SparkSession, sf_dir: str, mode: str = "full") -> dict[str, DataFrame]:
    """All nine tables, loaded once per session, for the queries that read most of them.

    The incremental kind is a full load of the first part of the events, and an incremental one of all.
    """
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir, mode)
    if key not in _stored:
        base, raw = shared_dir(spark), raw_events(spark, sf_dir)
        store = ut.TableStore(spark, root=f"{base}/dw", partitioned=mode == "incremental")
        if mode == "incremental":
            ut.run_pipeline(spark, early_events(raw), store, f"{base}/first")
        _stored[key] = ut.run_pipeline(spark, raw, store, f"{base}/work", mode)
    return _stored[key]


def loaded(name: str, mode: str) -> Query:
    """The contents of a stored table."""
    return lambda spark, sf_dir: comparable(stored_model(spark, sf_dir, mode)[name])


def _arrivals(raw: DataFrame) -> list[DataFrame]:
    """The events in three loads: most of the first part; the second part, with events of no date; and what was late for the first."""
    held = F.coalesce(F.col("event_timestamp") % 5 != 0, F.lit(False))
    early = F.coalesce(
        ut.to_reporting_date(F.timestamp_micros("event_timestamp")) <= F.lit(FIRST_LOAD_UNTIL).cast("date"), F.lit(False)
    )
    return [raw.where(early & held), raw.where(~early), raw.where(early & ~held)]


_snapshots: dict[tuple[str, ...], ut.SnapshotStore] = {}


def snapshots(spark: SparkSession, sf_dir: str, mode: str) -> ut.SnapshotStore:
    """A store of snapshots, loaded once per session: a load of the first events, and merges or an insert-only load after it."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir, mode)
    if key not in _snapshots:
        base, raw = shared_dir(spark), raw_events(spark, sf_dir)
        store = ut.SnapshotStore(spark, f"{base}/dw")
        loads = _arrivals(raw) if mode == "merge" else [early_events(raw), raw]
        for i, events in enumerate(loads):
            ut.run_pipeline(spark, events, store, f"{base}/work{i}", mode if i else "full")
        _snapshots[key] = store
    return _snapshots[key]


def snapshot(name: str, mode: str, version: int | None = None) -> Query:
    """The contents of a table in the latest version of a snapshot store, or in an older one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = snapshots(spark, sf_dir, mode)
        return comparable((store.at(version) if version else store).read(name))

    return run


def load_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and NULLs that were observed while the first load was written, without a scan."""
    found = snapshots(spark, sf_dir, "merge").measures()
    wanted = F.col("metric").startswith("count_fact") | F.col("metric").startswith("count_dim") | F.col("metric").startswith("nulls_")
    return comparable(found.where((F.col("version") == 1) & wanted).select("metric", "value"))


# Shards that come late or change after the ledger has read the others.
LATE_SHARD, CHANGED_SHARD = "20201125", "20201201"


def changed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events by a ledger that saw a new shard, a late one, a changed one, and left the others unread."""
    base, day = shared_dir(spark), ut.to_reporting_date(F.timestamp_micros("event_timestamp"))
    raw = raw_events(spark, sf_dir).where("event_timestamp is not null").withColumn("day", F.date_format(day, "yyyyMMdd"))
    shards = store_events(raw.where(F.col("day").between("20201120", "20201210")), f"{base}/all")
    ledger = ut.ShardLedger(spark, f"{base}/ledger", shard="day={day}")

    def write(rows: DataFrame, mode: str) -> None:
        rows.hint("rebalance", F.col("day")).write.mode(mode).partitionBy("day").parquet(f"{base}/export")

    write(shards.where(f"day < '20201210' and day <> '{LATE_SHARD}' and (day <> '{CHANGED_SHARD}' or event_timestamp % 2 = 0)"), "append")
    ledger.refresh(f"{base}/export")
    write(shards.where(f"day in ('20201210', '{LATE_SHARD}') or (day = '{CHANGED_SHARD}' and event_timestamp % 2 <> 0)"), "append")
    ledger.refresh(f"{base}/export")
    # the version in which each shard was last read
    return comparable(ledger.seen().select(F.regexp_extract("shard", r"(\d+)$", 1).alias("day"), "rows", "version"))


# Fixed value: the rows of one file of a stream, about.
FILE_ROWS = 200_000


def _in_turn(spark: SparkSession, rows: DataFrame, turn: Column, path: str) -> DataFrame:
    """A stream of the rows, in as many batches as there are turns, four at most.

    All turns have the same number of files, so that a batch is a turn; it grows with the rows, so that no task writes or reads a whole batch.
    """
    turned = store_events(rows.withColumn("turn", turn), f"{path}/turned")
    held, arrived = dict(turned.groupBy("turn").count().collect()), f"{path}/arrived"
    files = max(1, min(-(-max(held.values(), default=0) // FILE_ROWS), turned.rdd.getNumPartitions()))
    for i, n in enumerate(sorted(held), 1):
        turned.where(F.col("turn") == n).drop("turn").coalesce(files).write.mode("append").parquet(arrived)
        # a task without rows of this turn writes no file: an empty one takes its place
        for _ in range(i * files - len(spark.read.schema(rows.schema).parquet(arrived).inputFiles())):
            turned.limit(0).drop("turn").write.mode("append").parquet(arrived)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(arrived)


STREAM_GAP, STREAM_DELAY = "8 hours", "40 days"


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap sessions of events that arrive in four batches, up to ten days out of order; those that are closed."""
    base, staged = shared_dir(spark), staged_events(spark, sf_dir)
    since = F.datediff("event_date_utc", F.lit("2020-11-01").cast("date")) + F.pmod(F.xxhash64("event_ts_utc", "user_id"), F.lit(10))
    turn = F.coalesce(F.least(F.greatest(F.floor(since / 40), F.lit(0)), F.lit(3)), F.lit(0))
    arrived = _in_turn(spark, staged, turn, base)
    query = ut.write_sessions(ut.stream_gap_sessions(arrived, STREAM_GAP, STREAM_DELAY), f"{base}/sessions", f"{base}/checkpoint")
    query.awaitTermination()
    return comparable(spark.read.parquet(f"{base}/sessions"))


def streamed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a store that a stream was merged into, in two batches without any order; loaded once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "stream")
    if key not in _snapshots:
        base, raw = shared_dir(spark), raw_events(spark, sf_dir)
        arrived = _in_turn(spark, raw, F.pmod(F.xxhash64("event_timestamp", "user_pseudo_id"), F.lit(2)), base)
        store = ut.SnapshotStore(spark, f"{base}/dw")
        ut.stream_load(arrived, store, f"{base}/work", f"{base}/checkpoint").awaitTermination()
        _snapshots[key] = store
    return comparable(_snapshots[key].read("fact_sessions"))


def day_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events staged from day shards, those of given days alone."""
    path, day = f"{shared_dir(spark)}/export", ut.to_reporting_date(F.timestamp_micros("event_timestamp"))
    dated = raw_events(spark, sf_dir).withColumn("day", F.date_format(day, "yyyyMMdd"))
    dated.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(path)
    return comparable(ut.stage_events(ut.read_events(spark, path, *SHARD_DAYS, shard="day={day}")))


def views_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart read by its name in SQL."""
    model = stored_model(spark, sf_dir)
    ut.publish_views({**model, **ut.build_marts(model)})
    return comparable(spark.sql("select * from mrt_wow_kpis"))


def mart_at_rest(name: str) -> Query:
    """A mart that was stored, read back by its name through a new store."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_dir(spark)
        ut.TableStore(spark, root=base).publish(ut.build_marts(stored_model(spark, sf_dir)))
        return comparable(ut.TableStore(spark, root=base).read_mart(name))

    return run


def purchases_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases stored with copies, and reduced in place."""
    base = shared_dir(spark)
    store = ut.TableStore(spark, root=f"{base}/dw", partitioned=False)
    store.write(ut.purchase_rows(enriched_events(spark, sf_dir)), "fact_purchases", "overwrite")
    return comparable(ut.rebuild_purchases(store, f"{base}/work"))


# Faults ----------------------------------------------------------------------

Fault = Callable[[DataFrame], DataFrame]


def _again(test: str) -> Fault:
    """Append the rows that meet the test a second time."""
    return lambda df: df.unionByName(df.where(test))


def _without(test: str) -> Fault:
    return lambda df: df.where(f"not coalesce({test}, false)")


def _null(column: str, test: str) -> Fault:
    return lambda df: df.withColumn(column, F.when(~F.expr(test), F.col(column)))


def _faults(*faults: Fault) -> Fault:
    def apply(df: DataFrame) -> DataFrame:
        for fault in faults:
            df = fault(df)
        return df

    return apply


FAULTS: dict[str, Fault] = {
    "dim_user": _faults(_without("not is_purchaser"), _again("first_seen_date < date'2020-11-08'")),
    "dim_device": _without("platform = 'APP'"),
    "dim_geo": _without("region is null"),
    "dim_traffic_source": _without("traffic_campaign is null"),
    "fact_sessions": _faults(
        _again("purchase_count > 2"), _null("session_id", "event_count = 1"), _null("geo_key", "event_count = 2")
    ),
    "fact_funnel_steps": lambda df: df.withColumn(
        "step_ts", F.expr("if(funnel_step = 5, step_ts + interval 2 days, step_ts)")
    ),
    "fact_user_daily_activity": _faults(_again("had_purchase"), _null("activity_date", "event_count = 1")),
    "fact_purchases": _faults(_again("revenue > 50"), _null("purchase_ts", "revenue is null")),
}


def faulty(model: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: FAULTS[name](table) if name in FAULTS else table for name, table in model.items()}


# Checks: which tables each needs, and the check itself.
BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dim_date": ut.build_dim_date,
    "dim_user": ut.build_dim_user,
    "dim_device": dim_of("dim_device"),
    "dim_geo": dim_of("dim_geo"),
    "dim_traffic_source": dim_of("dim_traffic_source"),
    "fact_sessions": ut.build_fact_sessions,
    "fact_funnel_steps": ut.build_fact_funnel_steps,
    "fact_user_daily_activity": ut.build_fact_user_daily_activity,
    "fact_purchases": ut.build_fact_purchases,
}

Model = dict[str, DataFrame]

CHECKS: dict[str, tuple[list[str], Callable[[Model, DataFrame], DataFrame]]] = {
    "qa_duplicates_dim_user": (["dim_user"], lambda m, ev: ut.qa_duplicates(m["dim_user"], ["user_id"])),
    "qa_duplicates_fact_sessions": (
        ["fact_sessions"],
        lambda m, ev: ut.qa_duplicates(m["fact_sessions"], ["session_key"]),
    ),
    "qa_duplicates_fact_user_daily_activity": (
        ["fact_user_daily_activity"],
        lambda m, ev: ut.qa_duplicates(m["fact_user_daily_activity"], ["user_id", "activity_date"]),
    ),
    "qa_duplicates_fact_purchases": (
        ["fact_purchases"],
        lambda m, ev: ut.qa_duplicates(m["fact_purchases"], ["purchase_key"]),
    ),
    "qa_nulls_fact_sessions": (
        ["fact_sessions"],
        lambda m, ev: ut.qa_nulls(
            m["fact_sessions"], ["user_id", "session_id", "session_start_ts", "session_date"], "total_sessions"
        ),
    ),
    "qa_nulls_fact_user_daily_activity": (
        ["fact_user_daily_activity"],
        lambda m, ev: ut.qa_nulls(m["fact_user_daily_activity"], ["user_id", "activity_date"], "total_user_days"),
    ),
    "qa_nulls_fact_purchases": (
        ["fact_purchases"],
        lambda m, ev: ut.qa_nulls(
            m["fact_purchases"], ["user_id", "purchase_ts", "purchase_date", "revenue"], "total_purchases"
        ),
    ),
    "qa_orphans_users": (
        ["fact_sessions", "dim_user"],
        lambda m, ev: ut.qa_orphans(
            m["fact_sessions"], "user_id", m["dim_user"], null_fk_is_orphan=True, name="orphan_sessions_users"
        ),
    ),
    "qa_orphans_device": (
        ["fact_sessions", "dim_device"],
        lambda m, ev: ut.qa_orphans(m["fact_sessions"], "device_key", m["dim_device"], name="orphan_sessions_device"),
    ),
    "qa_orphans_geo": (
        ["fact_sessions", "dim_geo"],
        lambda m, ev: ut.qa_orphans(m["fact_sessions"], "geo_key", m["dim_geo"], name="orphan_sessions_geo"),
    ),
    "qa_orphans_traffic": (
        ["fact_sessions", "dim_traffic_source"],
        lambda m, ev: ut.qa_orphans(
            m["fact_sessions"], "traffic_key", m["dim_traffic_source"], name="orphan_sessions_traffic"
        ),
    ),
    "qa_step_ordering": (
        ["fact_funnel_steps", "fact_sessions"],
        lambda m, ev: ut.qa_steps_outside_session(m["fact_funnel_steps"], m["fact_sessions"]),
    ),
    "qa_reconcile": (
        ["fact_sessions", "dim_user", "fact_purchases"],
        lambda m, ev: ut.qa_reconcile(ev, m["fact_sessions"], m["dim_user"], m["fact_purchases"]),
    ),
    "qa_purchase_grain": (["fact_purchases"], lambda m, ev: ut.qa_purchase_grain(m["fact_purchases"])),
    "qa_dim_duplicates": (
        ["dim_date", "dim_device", "dim_geo", "dim_traffic_source"],
        lambda m, ev: ut.qa_dim_duplicates(m),
    ),
}

# These read nearly all tables, so they run on the stored ones.
WHOLE_CHECKS: dict[str, Callable[[Model, DataFrame], DataFrame]] = {
    "qa_row_counts": lambda m, ev: ut.qa_row_counts(m),
    "qa_summary": ut.qa_summary,
}


def check_query(tables: list[str], check, fault: bool) -> Query:
    def run(events: DataFrame) -> DataFrame:
        model = {name: BUILDERS[name](events) for name in tables}
        return check(faulty(model) if fault else model, events)

    return on_events(run)


def whole_check_query(check, fault: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = stored_model(spark, sf_dir)
        return comparable(check(faulty(model) if fault else model, enriched_events(spark, sf_dir)))

    return run


# Registry --------------------------------------------------------------------


def _staging() -> dict[str, Query]:
    return {
        "stg_events_base": lambda spark, sf_dir: comparable(staged_events(spark, sf_dir)),
        "stg_events_enriched": on_events(lambda ev: ev),
        "event_slices": lambda spark, sf_dir: comparable(ut.rollup_events(staged_events(spark, sf_dir))),
    }


def _tables() -> dict[str, Query]:
    found = {name: on_events(build) for name, build in BUILDERS.items()}
    for name in DIM_ATTRIBUTES:
        found[f"{name}_reference_grain"] = on_events(dim_of(name, "reference"))
    found["dim_date_contiguous"] = on_events(lambda ev: ut.build_dim_date(ev, contiguous=True))
    found["fact_funnel_steps_session_step"] = on_events(
        lambda ev: ut.build_fact_funnel_steps(ev, grain="session_step")
    )
    return found


def _marts() -> dict[str, Query]:
    return {
        "mrt_funnel_daily": on_events(lambda ev: ut.funnel_daily(ut.build_fact_funnel_steps(ev))),
        "mrt_retention_cohorts": on_events(
            lambda ev: ut.retention_cohorts(users_of(ev), days_of(ev), max_index=MART_WEEKS)
        ),
        "mrt_retention_curve": on_events(
            lambda ev: ut.retention_curve(ut.retention_cohorts(users_of(ev), days_of(ev), max_index=MART_WEEKS))
        ),
        "mrt_churn_proxy": on_events(lambda ev: ut.churn_proxy(users_of(ev), days_of(ev))),
        "mrt_wow_kpis": on_events(lambda ev: ut.wow_kpis(days_of(ev), sessions_of(ev))),
        "wow_kpis_with_events": on_events(lambda ev: ut.wow_kpis(days_of(ev), sessions_of(ev), with_events=True)),
        "retention_cohorts_zero_cells": on_events(
            lambda ev: ut.retention_cohorts(users_of(ev), days_of(ev), zero_cells=True)
        ),
        "wow_kpis_weeks_filled": on_events(lambda ev: ut.wow_kpis(days_of(ev), sessions_of(ev), fill_weeks=True)),
        # Activity of purchases alone leaves weeks without any, which then have zeros.
        "wow_kpis_purchase_weeks_filled": on_events(
            lambda ev: ut.wow_kpis(
                days_of(ev.where("event_name = 'purchase'")),
                sessions_of(ev.where("event_name = 'purchase'")),
                fill_weeks=True,
            )
        ),
        **{f"{name}_at_rest": mart_at_rest(name) for name in ("mrt_funnel_daily", "mrt_retention_cohorts")},
        "mart_view_by_name": views_by_name,
    }


def _checks() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, (tables, check) in CHECKS.items():
        found[name] = check_query(tables, check, fault=False)
        if name != "qa_dim_duplicates":
            found[f"{name}_dirty"] = check_query(tables, check, fault=True)
    for name, check in WHOLE_CHECKS.items():
        found[name] = whole_check_query(check, fault=False)
        found[f"{name}_dirty"] = whole_check_query(check, fault=True)
    # Purchases before the reduction to one row per key.
    found["qa_purchase_grain_before"] = on_events(lambda ev: ut.qa_purchase_grain(ut.purchase_rows(ev)))
    found["qa_unkeyed"] = on_events(ut.qa_unkeyed)
    return found


def _loads() -> dict[str, Query]:
    found = {f"incremental_{name}": second_load(name, build) for name, build in BUILDERS.items()}
    for name in BUILDERS:
        found[f"load_full_{name}"] = loaded(name, "full")
        found[f"load_incremental_{name}"] = loaded(name, "incremental")
        found[f"load_merge_{name}"] = snapshot(name, "merge")
    for name in FILTER_KEYS:
        found[f"load_filtered_{name}"] = snapshot(name, "incremental")
    found["load_snapshot_previous"] = snapshot("fact_sessions", "merge", version=1)
    found["load_measures"] = load_measures
    found["load_changed_shards"] = changed_shards
    found["stream_gap_sessions"] = streamed_sessions
    found["stream_load_fact_sessions"] = streamed_load
    found["source_day_shards"] = day_shards
    found["fact_purchases_rebuilt"] = purchases_rebuilt
    found["load_full"] = load("full")
    found["load_incremental"] = load("full", "incremental")
    found["load_rerun"] = load("full", "incremental", "incremental")
    return found


def calendar_of(events: DataFrame) -> DataFrame:
    """Calendars of two overlapping stretches of user days, merged."""
    days = ut.build_fact_user_daily_activity(events, dim_keys=False)
    cut = F.lit(FIRST_LOAD_UNTIL).cast("date")
    early, late = days.where(F.col("activity_date") <= cut), days.where(F.col("activity_date") >= F.date_sub(cut, 20))
    return ut.merge_calendars(ut.activity_calendar(early), ut.activity_calendar(late))


def on_sketches(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query over stored sketches of each day and the user days themselves."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = stored_model(spark, sf_dir)["fact_user_daily_activity"]
        store = ut.TableStore(spark, root=shared_dir(spark))
        store.publish({"daily_sketches": ut.daily_sketches(days)})
        return comparable(operator(store.read_mart("daily_sketches"), days))

    return run


def sketched_months(sketches: DataFrame, days: DataFrame) -> DataFrame:
    """Exact users of each month, and whether the sketches come within three standard errors."""
    exact = days.groupBy(F.trunc("activity_date", "month").alias("period_start")).agg(F.countDistinct("user_id").alias("exact_users"))
    both = exact.join(ut.sketched_users(sketches), "period_start")
    error = F.abs(F.col("active_users") - F.col("exact_users"))
    return both.select("period_start", "exact_users", (error <= users_bound() * F.col("exact_users") + 0.5).alias("in_bound"))


def sketched_returners(sketches: DataFrame, days: DataFrame) -> DataFrame:
    """Users active both by and after a date, exactly, and whether the sketches' intersection is in its bound."""
    sides = days.groupBy("user_id").agg(*[F.bool_or(F.expr(f"activity_date {op} date'{FIRST_LOAD_UNTIL}'")).alias(n) for op, n in (("<=", "a"), (">", "b"))])
    exact = sides.agg(F.count_if(F.expr("a and b")).alias("exact_both"), F.count("*").alias("exact_either"))
    found = ut.sketched_overlap(sketches, (None, FIRST_LOAD_UNTIL), ("2020-12-31", None))
    error = F.abs(found.select("both_users").scalar() - F.col("exact_both"))
    bound = overlap_bound(F.col("exact_both"), F.col("exact_either"))
    return exact.select("exact_both", "exact_either", (error <= bound).alias("in_bound"))


def sketched_deciles(sketches: DataFrame, days: DataFrame) -> DataFrame:
    """User days of each month, and whether the rank of each sketched decile of their events is in its bound."""
    points = [i / 10 for i in range(1, 10)]
    found = ut.sketched_quantiles(sketches, points).withColumnRenamed("event_count", "value")
    rows = days.select(F.trunc("activity_date", "month").alias("period_start"), "event_count")
    counts = rows.groupBy("period_start", "event_count").agg(F.count("*").alias("n"))
    ranks = counts.join(found, "period_start").groupBy("period_start", "point").agg(
        F.sum("n").alias("user_days"),
        F.sum(F.when(F.col("event_count") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("event_count") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"),
    )
    # two bounds: each is passed by one sketch in a hundred
    slack = 2 * rank_bound() * F.col("user_days") + 1
    rank = F.col("point") * F.col("user_days")
    inside = (F.col("below") - slack <= rank) & (F.col("upto") + slack >= rank)
    return ranks.select("period_start", "point", "user_days", inside.alias("in_bound"))


def _calendars() -> dict[str, Query]:
    return {
        "rolling_active_users_7d": on_events(lambda ev: ut.rolling_active_users(calendar_of(ev), 7)),
        "rolling_active_users_28d": on_events(lambda ev: ut.rolling_active_users(calendar_of(ev), 28)),
        "calendar_retention_nday": on_events(lambda ev: ut.calendar_retention(calendar_of(ev))),
        "calendar_churn_rate_30d": on_events(lambda ev: ut.calendar_churn_rate(calendar_of(ev), 30)),
        "calendar_churn_rate_14d_week": on_events(lambda ev: ut.calendar_churn_rate(calendar_of(ev), 14, "week")),
        "sketched_users_month": on_sketches(sketched_months),
        "sketched_users_overlap": on_sketches(sketched_returners),
        "sketched_event_deciles": on_sketches(sketched_deciles),
    }


def _metrics() -> dict[str, Query]:
    noise = ["error", "scroll"]
    steps = ut.build_fact_funnel_steps

    def segment(name: str, *attributes: str) -> Query:
        key = DIM_ATTRIBUTES[name][0]
        return on_events(lambda ev: ut.funnel_by_segment(steps(ev), dim_of(name)(ev), key, attributes))

    def copies(ev: DataFrame) -> DataFrame:
        """Every event emitted twice, the copy from another platform."""
        return ev.unionByName(ev.withColumn("platform", F.concat("platform", F.lit("_RETRY"))))

    def churn(ev: DataFrame) -> DataFrame:
        return ut.churn_proxy(users_of(ev), days_of(ev))

    def touched(ev: DataFrame) -> DataFrame:
        """Users with the device, place and traffic of their first day."""
        return ut.with_first_touch(users_of(ev), ut.build_fact_user_daily_activity(ev))

    def unidentified(ev: DataFrame) -> DataFrame:
        """Events of unknown users or without a time, each twice, and of all others none."""
        return ut.dedup_events(copies(ev.drop(*DIM_KEYS, "session_key")).where("user_id is null or event_ts_utc is null"))

    return {
        "activated_users": on_events(ut.activated_users),
        "activated_users_by_country": on_events(
            lambda ev: ut.activated_users(ev, start="2020-11-15", end="2020-12-31", by=["country"])
        ),
        "step_users": on_events(ut.step_users),
        "step_users_by_device": on_events(lambda ev: ut.step_users(ev, by=["device_category"])),
        "step_conversion": on_events(lambda ev: ut.step_conversion(ut.step_users(ev))),
        "step_conversion_by_traffic": on_events(
            lambda ev: ut.step_conversion(ut.step_users(ev, by=["traffic_source", "traffic_medium"]))
        ),
        "overall_conversion": on_events(lambda ev: ut.overall_conversion(ut.step_users(ev))),
        "overall_conversion_by_country": on_events(
            lambda ev: ut.overall_conversion(ut.step_users(ev, by=["country"]))
        ),
        "dropoff": on_events(lambda ev: ut.dropoff(ut.step_conversion(ut.step_users(ev)))),
        "active_users_day": on_events(lambda ev: ut.active_users(ev, "day")),
        "active_users_week": on_events(lambda ev: ut.active_users(ev, "week")),
        "active_users_month": on_events(lambda ev: ut.active_users(ev, "month")),
        "active_users_without_noise": on_events(lambda ev: ut.active_users(ev, "day", exclude=noise)),
        "retention_activation_cohort": on_events(
            lambda ev: ut.retention_cohorts(users_of(ev), days_of(ev), anchor="first_purchase")
        ),
        "retention_session_start_cohort": on_events(
            lambda ev: ut.retention_cohorts(users_of(ev), days_of(ev), anchor="session_start")
        ),
        "retention_nday": on_events(lambda ev: ut.nday_retention(users_of(ev), days_of(ev))),
        "retention_nday_30": on_events(lambda ev: ut.nday_retention(users_of(ev), days_of(ev), max_day=30)),
        "retention_by_device": on_events(
            lambda ev: ut.retention_cohorts(touched(ev), days_of(ev), by=["device_key"])
        ),
        "retention_by_traffic_curve": on_events(
            lambda ev: ut.retention_curve(ut.retention_cohorts(touched(ev), days_of(ev), by=["traffic_key"]))
        ),
        "churn_rate_30d_by_geo": on_events(
            lambda ev: ut.churn_rate(days_of(ev), 30, by=["geo_key"], users=touched(ev))
        ),
        "activated_users_by_status": on_events(
            lambda ev: ut.activated_users(ut.with_user_status(ev, users_of(ev)), by=["user_status"])
        ),
        "step_users_by_status": on_events(
            lambda ev: ut.step_users(ut.with_user_status(ev, users_of(ev)), by=["user_status"])
        ),
        "funnel_by_status": on_events(
            lambda ev: ut.funnel_daily(ut.with_user_status(steps(ev), users_of(ev), "session_date"), by=["user_status"])
        ),
        "step_users_first_event": on_events(lambda ev: ut.step_users(ev, first_event_starts=True)),
        "step_users_first_event_by_device": on_events(
            lambda ev: ut.step_users(ev, by=["device_category"], first_event_starts=True)
        ),
        "overall_conversion_first_event": on_events(
            lambda ev: ut.overall_conversion(ut.step_users(ev, first_event_starts=True))
        ),
        "fact_funnel_steps_first_event": on_events(
            lambda ev: ut.build_fact_funnel_steps(ev, first_event_starts=True)
        ),
        "daily_activity_without_noise": on_events(
            lambda ev: ut.build_fact_user_daily_activity(ut.without_noise(ev, noise))
        ),
        "retention_nday_curve": on_events(
            lambda ev: ut.retention_curve(ut.nday_retention(users_of(ev), days_of(ev)))
        ),
        "churn_rate_14d": on_events(lambda ev: ut.churn_rate(days_of(ev), 14)),
        "churn_rate_30d": on_events(lambda ev: ut.churn_rate(days_of(ev), 30)),
        "churn_rate_60d": on_events(lambda ev: ut.churn_rate(days_of(ev), 60)),
        "churn_rate_14d_week": on_events(lambda ev: ut.churn_rate(days_of(ev), 14, "week")),
        "churn_by_purchaser": on_events(lambda ev: ut.churn_by_segment(churn(ev))),
        "churn_sensitivity": on_events(lambda ev: ut.churn_sensitivity(churn(ev))),
        "event_volume": on_events(ut.event_volume),
        "purchases_per_purchaser": on_events(ut.purchases_per_purchaser),
        "profile_events": on_events(ut.profile_events),
        "funnel_by_device": segment("dim_device", "device_category"),
        "funnel_by_geo": segment("dim_geo", "country", "region"),
        "funnel_by_traffic": segment("dim_traffic_source", "traffic_source", "traffic_medium"),
        "new_vs_returning": on_events(lambda ev: ut.new_vs_returning(days_of(ev), users_of(ev))),
        "new_vs_returning_unknown_users": on_events(
            lambda ev: ut.new_vs_returning(days_of(ev), users_of(ev).where("is_purchaser"))
        ),
        "dedup_events_unidentified": on_events(unidentified),
        "dedup_events": on_events(lambda ev: ut.dedup_events(copies(ev.drop(*DIM_KEYS, "session_key")))),
        "sessionize_gap": on_events(
            lambda ev: ut.sessionize(ev.select("user_id", "event_ts_utc", "event_name"))
        ),
        "sessionize_fallback": on_events(
            lambda ev: ut.sessionize(
                ev.select("user_id", "event_ts_utc", "event_name", "ga_session_id"), "8 hours", "ga_session_id"
            )
        ),
        "fact_sessions_with_gap_sessions": lambda spark, sf_dir: comparable(
            ut.build_fact_sessions(ut.enrich_events(ut.fill_sessions(staged_events(spark, sf_dir), "8 hours")))
        ),
        "session_start_resolved": on_events(ut.session_starts),
        "daily_activity_reporting_tz": lambda spark, sf_dir: comparable(
            ut.build_fact_user_daily_activity(
                ut.enrich_events(ut.stage_events(raw_events(spark, sf_dir), REPORTING_TZ))
            )
        ),
    }


def queries() -> dict[str, Query]:
    return {**_staging(), **_tables(), **_marts(), **_checks(), **_loads(), **_metrics(), **_calendars()}
