"""Product-lifecycle analytics on PySpark DataFrames."""

from usertide.operators.calendar import (
    activity_calendar,
    calendar_churn_rate,
    calendar_retention,
    merge_calendars,
    rolling_active_users,
)
from usertide.operators.dims import build_dim, build_dim_date, build_dim_user
from usertide.operators.facts import (
    build_fact_funnel_steps,
    build_fact_purchases,
    build_fact_sessions,
    build_fact_user_daily_activity,
    earliest_purchases,
    first_events,
    purchase_rows,
)
from usertide.operators.in_flight import alarms, observed
from usertide.operators.marts import (
    churn_proxy,
    funnel_by_segment,
    funnel_daily,
    retention_cohorts,
    retention_curve,
    with_first_touch,
    wow_kpis,
)
from usertide.operators.metrics import (
    activated_users,
    active_users,
    churn_by_segment,
    churn_rate,
    churn_sensitivity,
    dropoff,
    event_volume,
    nday_retention,
    new_vs_returning,
    overall_conversion,
    profile_events,
    purchases_per_purchaser,
    step_conversion,
    step_users,
    with_user_status,
    without_noise,
)
from usertide.operators.qa import (
    qa_dim_duplicates,
    qa_duplicates,
    qa_nulls,
    qa_orphans,
    qa_purchase_grain,
    qa_reconcile,
    qa_row_counts,
    qa_steps_outside_session,
    qa_summary,
    qa_unkeyed,
)
from usertide.operators.sessionize import dedup_events, fill_sessions, session_starts, sessionize
from usertide.operators.sketches import daily_sketches, sketched_overlap, sketched_quantiles, sketched_users
from usertide.operators.staging import enrich_events, rollup_events, stage_events
from usertide.functions.columns import to_reporting_date
from usertide.plans.pipeline import build_marts, build_model, load_model, rebuild_purchases, run_pipeline
from usertide.plans.snapshot_loads import load_snapshot
from usertide.schemas import conform
from usertide.sources.events import read_events, store_events, write_events
from usertide.sources.ledger import ShardLedger
from usertide.sources.snapshots import ConcurrentLoad, SnapshotStore
from usertide.sources.tables import TableStore, insert_if_absent, publish_views
from usertide.streaming.loads import stream_load, without_copies
from usertide.streaming.sessions import late_rows, stream_gap_sessions, write_sessions

__all__ = [name for name in dir() if not name.startswith("_")]
