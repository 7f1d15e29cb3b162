"""DuckDB SQL for the queries, written apart from the Spark operators.

Tables are common table expressions over the given ``events``; a query names the ones
it needs. Where Spark aggregates, the SQL here often ranks or brute-forces instead.
"""

from __future__ import annotations

from workload.fixture import DAY, SESSION, SOURCE_EPOCH, TARGET_EPOCH

# The steps of the funnel, stated here once more so that the check borrows nothing.
FUNNEL_STEPS = {"session_start": 1, "view_item": 2, "add_to_cart": 3, "begin_checkout": 4, "purchase": 5}

STAGED = f"""
moved AS (
  SELECT event_id, user_id, event_type, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, epoch_us(ts) - {SOURCE_EPOCH} AS x
  FROM events),
timed AS (
  SELECT *, {TARGET_EPOCH} + 7 * (user_id % 7) * {DAY} AS arrival,
    {TARGET_EPOCH} + 7 * (user_id % 7) * {DAY} + (x * (3 + 11 * (user_id % 5))) // 30
      + CASE WHEN x >= 15 * {DAY} THEN 16 * (user_id % 3) * {DAY} ELSE 0 END AS u
  FROM moved),
named AS (
  SELECT *, u // {SESSION} AS sid, arrival // {SESSION} AS first_sid,
    CASE event_type
      WHEN 'signup' THEN CASE WHEN user_id % 7 = 6 THEN 'scroll' ELSE 'session_start' END
      WHEN 'view' THEN 'view_item'
      WHEN 'click' THEN CASE WHEN k < 60 THEN 'add_to_cart' ELSE 'begin_checkout' END
      WHEN 'purchase' THEN CASE WHEN user_id % 6 = 5 THEN 'view_item' ELSE 'purchase' END
      ELSE event_type END AS event_name
  FROM timed),
stg AS (
  SELECT CASE WHEN event_id % 61 <> 7 THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 67 <> 5 THEN make_timestamp(u) END AS event_ts_utc,
    CASE WHEN event_id % 67 <> 5 THEN CAST(make_timestamp(u) AS DATE) END AS event_date_utc,
    event_name,
    CASE WHEN (user_id + sid + event_id % 9 // 8) % 4 = 3 THEN 'APP' ELSE 'WEB' END AS platform,
    CASE k % 20 WHEN 0 THEN NULL WHEN 1 THEN ''
      ELSE CASE (user_id + sid) % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END END AS device_category,
    'NATION_' || ((user_id + event_id % 8 // 7) % 25) AS country,
    CASE WHEN user_id % 25 % 6 <> 0 THEN 'REGION_' || (user_id % 25 % 5) WHEN event_id % 2 = 1 THEN '' END AS region,
    CASE (user_id + event_id % 7 // 6) % 5 WHEN 0 THEN 'google' WHEN 1 THEN '(direct)' WHEN 2 THEN 'newsletter'
      WHEN 3 THEN 'partner' END AS traffic_source,
    CASE user_id % 5 WHEN 0 THEN 'organic' WHEN 1 THEN '(none)' WHEN 2 THEN 'email'
      WHEN 3 THEN 'referral' END AS traffic_medium,
    CASE WHEN sid % 2 = 0 THEN 'brand' END AS traffic_campaign,
    CASE WHEN k <> 99 THEN sid END AS ga_session_id,
    sid - first_sid + 1 AS ga_session_number,
    CASE WHEN k % 4 <> 0 THEN 'T' || (event_id // 12) END AS transaction_id,
    CASE WHEN k % 10 <> 0 THEN value END AS purchase_revenue
  FROM named),
ev AS (
  SELECT * REPLACE (CAST(purchase_revenue AS DECIMAL(38, 9)) AS purchase_revenue),
    md5(coalesce(device_category, '') || '|' || coalesce(platform, '')) AS device_key,
    md5(coalesce(country, '') || '|' || coalesce(region, '')) AS geo_key,
    md5(coalesce(traffic_source, '') || '|' || coalesce(traffic_medium, '') || '|'
      || coalesce(traffic_campaign, '')) AS traffic_key,
    user_id || '-' || CAST(ga_session_id AS VARCHAR) AS session_key
  FROM stg)"""

FIRST = "ORDER BY event_ts_utc, user_id, ga_session_id, ga_session_number, device_key, geo_key, traffic_key"
FIRST_KEYS = "ORDER BY event_ts_utc, device_key, geo_key, traffic_key"
STEP = "CASE event_name " + " ".join(f"WHEN '{name}' THEN {n}" for name, n in FUNNEL_STEPS.items()) + " END"
STEP_NAMES = ", ".join(f"'{name}'" for name in FUNNEL_STEPS)
REVENUE = "sum(CASE WHEN event_name = 'purchase' THEN purchase_revenue ELSE 0 END)"
STEPS = "VALUES " + ", ".join(f"({n}, '{name}')" for name, n in FUNNEL_STEPS.items())
TS_TEXT = """strftime(event_ts_utc, '%Y-%m-%d %H:%M:%S') || CASE
    WHEN epoch_us(event_ts_utc) % 1000000 = 0 THEN ''
    WHEN epoch_us(event_ts_utc) % 1000 = 0 THEN '.' || strftime(event_ts_utc, '%g')
    ELSE '.' || strftime(event_ts_utc, '%f') END || '+00'"""
PURCHASE_KEY = f"coalesce(transaction_id, md5(user_id || '|' || {TS_TEXT}))"


def dim_body(key: str, attributes: list[str], source: str, grain: str = "key") -> str:
    names = ", ".join(attributes)
    distinct = f"SELECT DISTINCT {key}, {names} FROM {source} WHERE {key} IS NOT NULL"
    if grain == "reference":
        return distinct
    order = ", ".join(f"{a} DESC NULLS LAST" for a in attributes)
    return f"""SELECT {key}, {names} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM ({distinct})) WHERE rn = 1"""


DIMS = {
    "dim_device": ("device_key", ["device_category", "platform"]),
    "dim_geo": ("geo_key", ["country", "region"]),
    "dim_traffic_source": ("traffic_key", ["traffic_source", "traffic_medium", "traffic_campaign"]),
}


def bodies(source: str = "ev") -> dict[str, str]:
    """Definition of each table over a source of enriched events."""
    return {
        "dim_date": f"""
  SELECT d AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
    monthname(d) AS month_name, CAST(strftime(d, '%U') AS BIGINT) AS week,
    dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT event_date_utc AS d FROM {source} WHERE event_date_utc IS NOT NULL)""",
        **{name: dim_body(key, attributes, source) for name, (key, attributes) in DIMS.items()},
        "dim_user": f"""
  SELECT user_id, min(event_ts_utc) AS first_seen_ts, min(event_date_utc) AS first_seen_date,
    min(event_ts_utc) FILTER (event_name = 'purchase') AS first_purchase_ts,
    min(event_date_utc) FILTER (event_name = 'purchase') AS first_purchase_date,
    count(*) FILTER (event_name = 'purchase') > 0 AS is_purchaser
  FROM {source} WHERE user_id IS NOT NULL GROUP BY 1""",
        "fact_sessions": f"""
  SELECT session_key, first(user_id {FIRST}) AS user_id, first(ga_session_id {FIRST}) AS session_id,
    first(ga_session_number {FIRST}) AS session_number,
    min(event_ts_utc) AS session_start_ts, max(event_ts_utc) AS session_end_ts,
    min(event_date_utc) AS session_date, first(device_key {FIRST}) AS device_key,
    first(geo_key {FIRST}) AS geo_key, first(traffic_key {FIRST}) AS traffic_key,
    count(*) AS event_count, count(*) FILTER (event_name = 'purchase') AS purchase_count, {REVENUE} AS revenue
  FROM {source} WHERE session_key IS NOT NULL GROUP BY session_key""",
        "fact_funnel_steps": f"""
  SELECT session_key, user_id, event_date_utc AS session_date, {STEP} AS funnel_step,
    event_name AS funnel_event_name, min(event_ts_utc) AS step_ts, device_key, geo_key, traffic_key
  FROM {source}
  WHERE event_name IN ({STEP_NAMES})
    AND session_key IS NOT NULL
  GROUP BY session_key, user_id, event_date_utc, event_name, device_key, geo_key, traffic_key""",
        "fact_user_daily_activity": f"""
  SELECT user_id, event_date_utc AS activity_date, first(device_key {FIRST_KEYS}) AS device_key,
    first(geo_key {FIRST_KEYS}) AS geo_key, first(traffic_key {FIRST_KEYS}) AS traffic_key,
    TRUE AS is_active, count(*) AS event_count,
    count(*) FILTER (event_name = 'session_start') > 0 AS had_session_start,
    count(*) FILTER (event_name = 'view_item') > 0 AS had_view_item,
    count(*) FILTER (event_name = 'add_to_cart') > 0 AS had_add_to_cart,
    count(*) FILTER (event_name = 'begin_checkout') > 0 AS had_begin_checkout,
    count(*) FILTER (event_name = 'purchase') > 0 AS had_purchase,
    count(*) FILTER (event_name = 'purchase') AS purchase_count, {REVENUE} AS revenue
  FROM {source} WHERE user_id IS NOT NULL AND event_date_utc IS NOT NULL GROUP BY user_id, event_date_utc""",
        "fact_purchases": f"""
  SELECT purchase_key, user_id, event_ts_utc AS purchase_ts, event_date_utc AS purchase_date, transaction_id,
    purchase_revenue AS revenue, device_key, geo_key, traffic_key, session_key
  FROM (
    SELECT *, row_number() OVER (PARTITION BY purchase_key ORDER BY event_ts_utc, user_id,
      session_key NULLS FIRST, purchase_revenue DESC NULLS LAST, device_key, geo_key, traffic_key) AS rn
    FROM (SELECT *, {PURCHASE_KEY} AS purchase_key FROM {source} WHERE event_name = 'purchase')
    WHERE user_id IS NOT NULL AND purchase_key IS NOT NULL)
  WHERE rn = 1""",
    }


TABLES = list(bodies())
KEYS = {
    "dim_date": ["date_day"],
    "dim_device": ["device_key"],
    "dim_geo": ["geo_key"],
    "dim_traffic_source": ["traffic_key"],
    "dim_user": ["user_id"],
    "fact_sessions": ["session_key"],
    "fact_funnel_steps": ["session_key", "funnel_step"],
    "fact_user_daily_activity": ["user_id", "activity_date"],
    "fact_purchases": ["purchase_key"],
}
MONEY = {"fact_sessions", "fact_user_daily_activity", "fact_purchases"}

# Output columns cast to the types the Spark side returns.
_DATE_OUT = """SELECT * REPLACE (CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  CAST(month AS BIGINT) AS month, CAST(day_of_week AS BIGINT) AS day_of_week) FROM {0}"""


def shown(table: str, source: str | None = None) -> str:
    source = source or table
    if table in MONEY:
        return f"SELECT * REPLACE ({money('revenue')} AS revenue) FROM {source}"
    if table == "dim_date":
        return _DATE_OUT.format(source)
    if table == "fact_funnel_steps":
        return f"SELECT * REPLACE (CAST(funnel_step AS BIGINT) AS funnel_step) FROM {source}"
    return f"SELECT * FROM {source}"


def with_tables(tables: list[str], final: str, *more: str) -> str:
    """A query over the events, the named tables and further expressions."""
    found = bodies()
    parts = [STAGED, *[f"{name} AS ({found[name]})" for name in tables], *more]
    return "WITH " + ",\n".join(parts) + "\n" + final


def money(amount: str) -> str:
    """An amount as text with all nine places."""
    return f"CAST(CAST({amount} AS DECIMAL(38, 9)) AS VARCHAR)"


# Nine places, as an amount divided by a count has.
PER_SESSION = money("round(CAST(revenue AS DOUBLE) / nullif(sessions, 0), 9)")

RATES = """round(sessions_view_item / nullif(sessions, 0), 9) AS rate_view_item,
  round(sessions_add_to_cart / nullif(sessions_view_item, 0), 9) AS rate_add_to_cart_given_view,
  round(sessions_begin_checkout / nullif(sessions_add_to_cart, 0), 9) AS rate_begin_checkout_given_cart,
  round(sessions_purchase / nullif(sessions_begin_checkout, 0), 9) AS rate_purchase_given_checkout,
  round(sessions_purchase / nullif(sessions, 0), 9) AS rate_purchase_overall"""

REACHED = """count(*) AS sessions, count(*) FILTER (top >= 2) AS sessions_view_item,
  count(*) FILTER (top >= 3) AS sessions_add_to_cart, count(*) FILTER (top >= 4) AS sessions_begin_checkout,
  count(*) FILTER (top >= 5) AS sessions_purchase"""


def cohorts(anchor: str, unit: str, top: int | None, cohort: str, index: str, by: str = "") -> str:
    """Cells of a retention table as the expressions ``sizes`` and ``cells``; ``by`` is a key of the user's first day."""
    bound = "" if top is None else f" AND (period - cohort) // {days_of(unit)} <= {top}"
    of = f", {by}" if by else ""
    touch = f"""LEFT JOIN (
    SELECT user_id, {by} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY activity_date) AS rn
      FROM fact_user_daily_activity) WHERE rn = 1) USING (user_id)""" if by else ""
    days = days_of(unit)
    dates = (
        "SELECT user_id, min(activity_date) AS a FROM fact_user_daily_activity WHERE had_session_start GROUP BY 1"
        if anchor == "session_start"
        else f"SELECT user_id, {anchor}_date AS a FROM dim_user WHERE {anchor}_date IS NOT NULL"
    )
    return f"""members AS (SELECT user_id, CAST(date_trunc('{unit}', a) AS DATE) AS cohort{of} FROM ({dates}) {touch}),
sizes AS (SELECT cohort{of}, count(*) AS cohort_size FROM members GROUP BY ALL),
cells AS (
  SELECT cohort AS {cohort}{of}, (period - cohort) // {days} AS {index}, cohort_size,
    count(DISTINCT user_id) AS active_users,
    round(count(DISTINCT user_id) / cohort_size, 9) AS retention_rate
  FROM members JOIN sizes USING (cohort{of})
  JOIN (SELECT user_id, CAST(date_trunc('{unit}', activity_date) AS DATE) AS period
        FROM fact_user_daily_activity) USING (user_id)
  WHERE period >= cohort{bound}
  GROUP BY cohort, period, cohort_size{of})"""


def days_of(unit: str) -> int:
    return 7 if unit == "week" else 1


def curve(index: str, by: str = "") -> str:
    of = f"{by}, " if by else ""
    return f"""SELECT {of}{index}, CAST(sum(active_users) AS BIGINT) AS active_users,
  CAST(sum(cohort_size) AS BIGINT) AS cohort_users,
  round(sum(active_users) / sum(cohort_size), 9) AS retention_rate_weighted
FROM cells GROUP BY {of}{index} ORDER BY {of}{index}"""


ALL_WEEKS = cohorts("first_seen", "week", None, "cohort_week", "week_index")
WEEKLY_COHORTS = cohorts("first_seen", "week", 12, "cohort_week", "week_index")
USERS_DAYS = ["dim_user", "fact_user_daily_activity"]

CHURN = """churn AS (
  SELECT user_id, first_seen_date, first_purchase_date, is_purchaser, last_active_date, as_of_date,
    as_of_date - last_active_date AS days_since_last_active,
    CAST(as_of_date - last_active_date >= 14 AS BIGINT) AS churn_14d,
    CAST(as_of_date - last_active_date >= 30 AS BIGINT) AS churn_30d,
    CAST(as_of_date - last_active_date >= 60 AS BIGINT) AS churn_60d
  FROM dim_user
  LEFT JOIN (SELECT user_id, max(activity_date) AS last_active_date FROM fact_user_daily_activity GROUP BY 1)
    USING (user_id)
  CROSS JOIN (SELECT max(activity_date) AS as_of_date FROM fact_user_daily_activity))"""


def weekly_kpis(days: str, weeks: str = "SELECT week_start FROM w", fill: bool = False) -> str:
    """Week-over-week figures over a table of user days."""
    zero = "coalesce({0}, 0)" if fill else "{0}"
    return f"""w AS (
  SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week_start, count(DISTINCT user_id) AS wau,
    CAST(sum(purchase_count) AS BIGINT) AS purchases, sum(coalesce(revenue, 0)) AS revenue
  FROM {days} GROUP BY 1),
ws AS (SELECT CAST(date_trunc('week', session_date) AS DATE) AS week_start, count(*) AS sessions
  FROM fact_sessions GROUP BY 1),
j AS (
  SELECT week_start, {zero.format('wau')} AS wau, {zero.format('sessions')} AS sessions,
    {zero.format('purchases')} AS purchases, {zero.format('revenue')} AS revenue
  FROM ({weeks}) LEFT JOIN w USING (week_start) LEFT JOIN ws USING (week_start)),
p AS (
  SELECT *, lag(wau) OVER o AS wau_p, lag(sessions) OVER o AS sessions_p, lag(purchases) OVER o AS purchases_p,
    lag(revenue) OVER o AS revenue_p FROM j WINDOW o AS (ORDER BY week_start))
SELECT week_start, wau, sessions, purchases, {money('revenue')} AS revenue,
  round(purchases / nullif(sessions, 0), 9) AS purchase_per_session,
  {PER_SESSION} AS revenue_per_session,
  wau - wau_p AS wau_wow_delta, round((wau - wau_p) / nullif(wau_p, 0), 9) AS wau_wow_pct,
  sessions - sessions_p AS sessions_wow_delta,
  round((sessions - sessions_p) / nullif(sessions_p, 0), 9) AS sessions_wow_pct,
  purchases - purchases_p AS purchases_wow_delta,
  round((purchases - purchases_p) / nullif(purchases_p, 0), 9) AS purchases_wow_pct,
  {money('revenue - revenue_p')} AS revenue_wow_delta,
  round(CAST(revenue - revenue_p AS DOUBLE) / nullif(CAST(revenue_p AS DOUBLE), 0), 9) AS revenue_wow_pct
FROM p ORDER BY week_start"""


# Checks ----------------------------------------------------------------------

# The faults of the Spark side, as expressions that wrap a table.
FAULTS = {
    "dim_user": """SELECT * FROM dim_user WHERE is_purchaser
    UNION ALL SELECT * FROM dim_user WHERE is_purchaser AND first_seen_date < DATE '2020-11-08'""",
    "dim_device": "SELECT * FROM dim_device WHERE platform IS DISTINCT FROM 'APP'",
    "dim_geo": "SELECT * FROM dim_geo WHERE region IS NOT NULL",
    "dim_traffic_source": "SELECT * FROM dim_traffic_source WHERE traffic_campaign IS NOT NULL",
    "fact_sessions": """SELECT * REPLACE (CASE WHEN event_count <> 1 THEN session_id END AS session_id,
      CASE WHEN event_count <> 2 THEN geo_key END AS geo_key)
    FROM (SELECT * FROM fact_sessions UNION ALL SELECT * FROM fact_sessions WHERE purchase_count > 2)""",
    "fact_funnel_steps": """SELECT * REPLACE (CASE WHEN funnel_step = 5 THEN step_ts + INTERVAL 2 DAY
      ELSE step_ts END AS step_ts) FROM fact_funnel_steps""",
    "fact_user_daily_activity": """SELECT * REPLACE (CASE WHEN event_count <> 1 THEN activity_date END AS activity_date)
    FROM (SELECT * FROM fact_user_daily_activity
      UNION ALL SELECT * FROM fact_user_daily_activity WHERE had_purchase)""",
    "fact_purchases": """SELECT * REPLACE (CASE WHEN revenue IS NOT NULL THEN purchase_ts END AS purchase_ts)
    FROM (SELECT * FROM fact_purchases UNION ALL SELECT * FROM fact_purchases WHERE revenue > 50)""",
}


def duplicates(table: str) -> str:
    keys = ", ".join(KEYS[table])
    return f"SELECT {keys}, count(*) AS dup_cnt FROM {{{table}}} GROUP BY {keys} HAVING count(*) > 1"


def null_counts(table: str, total: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in columns)
    return f"SELECT count(*) AS {total}, {counts} FROM {{{table}}}"


def orphans(dim: str, key: str, name: str) -> str:
    known = "" if dim == "dim_user" else f" AND s.{key} IS NOT NULL"
    return f"""SELECT count(*) AS {name} FROM {{fact_sessions}} s
WHERE NOT EXISTS (SELECT 1 FROM {{{dim}}} d WHERE d.{key} = s.{key}){known}"""


ORDERING = """SELECT count(*) AS funnel_steps_outside_session_window
FROM {fact_funnel_steps} JOIN {fact_sessions} USING (session_key)
WHERE step_ts NOT BETWEEN session_start_ts AND session_end_ts"""

RECONCILE = """SELECT metric, from_events, from_model, from_model - from_events AS diff, from_model = from_events AS ok
FROM (
  SELECT 'events' AS metric, (SELECT count(*) FROM ev) AS from_events,
    (SELECT CAST(sum(event_count) AS BIGINT) FROM {fact_sessions}) AS from_model
  UNION ALL SELECT 'sessions', (SELECT count(DISTINCT session_key) FROM ev), (SELECT count(*) FROM {fact_sessions})
  UNION ALL SELECT 'users', (SELECT count(DISTINCT user_id) FROM ev), (SELECT count(*) FROM {dim_user})
  UNION ALL SELECT 'purchases', (SELECT count(*) FROM ev WHERE event_name = 'purchase'),
    (SELECT count(*) FROM {fact_purchases}))"""

PURCHASE_GRAIN = """SELECT
  (SELECT count(*) FROM (SELECT purchase_key FROM {fact_purchases} GROUP BY 1 HAVING count(*) > 1)) AS dup_purchase_keys,
  (SELECT count(*) FROM {fact_purchases} WHERE revenue IS NULL) AS purchase_null_revenue_cnt"""

WATCHED = {
    "fact_sessions": ["user_id", "session_id", "session_start_ts", "session_date"],
    "fact_user_daily_activity": ["user_id", "activity_date"],
    "fact_purchases": ["user_id", "purchase_ts", "purchase_date", "revenue"],
}
SESSION_DIMS = {
    "dim_user": ("user_id", "users"),
    "dim_device": ("device_key", "device"),
    "dim_geo": ("geo_key", "geo"),
    "dim_traffic_source": ("traffic_key", "traffic"),
}
ROW_COUNTS = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {{{t}}}" for t in TABLES)


def _summary() -> str:
    label = {
        "dim_user": "user_id",
        "fact_sessions": "session_key",
        "fact_user_daily_activity": "user_day",
        "fact_purchases": "purchase_key",
    }
    parts = [f"SELECT 'count_{t}' AS metric, count(*) AS value FROM {{{t}}}" for t in TABLES]
    parts += [f"SELECT 'dupes_{t}_{n}', count(*) FROM ({duplicates(t)})" for t, n in label.items()]
    parts += [
        f"SELECT 'nulls_{t}_{c}', count(*) FILTER ({c} IS NULL) FROM {{{t}}}" for t, cs in WATCHED.items() for c in cs
    ]
    parts += [
        f"SELECT 'orphans_fact_sessions_{d}', n FROM ({orphans(d, k, 'n')})" for d, (k, _) in SESSION_DIMS.items()
    ]
    parts += [
        "SELECT 'recon_events_cnt', count(*) FROM ev",
        "SELECT 'recon_sessions_distinct_from_events', count(DISTINCT session_key) FROM ev",
        "SELECT 'recon_users_distinct_from_events', count(DISTINCT user_id) FROM ev",
        f"SELECT 'funnel_steps_outside_session_window', n FROM ({ORDERING}) AS t(n)",
    ]
    return "\nUNION ALL ".join(parts) + "\nORDER BY metric"


CHECKS = {
    **{f"qa_duplicates_{t}": duplicates(t) for t in ["dim_user", *WATCHED]},
    "qa_nulls_fact_sessions": null_counts("fact_sessions", "total_sessions", WATCHED["fact_sessions"]),
    "qa_nulls_fact_user_daily_activity": null_counts(
        "fact_user_daily_activity", "total_user_days", WATCHED["fact_user_daily_activity"]
    ),
    "qa_nulls_fact_purchases": null_counts("fact_purchases", "total_purchases", WATCHED["fact_purchases"]),
    **{f"qa_orphans_{n}": orphans(d, k, f"orphan_sessions_{n}") for d, (k, n) in SESSION_DIMS.items()},
    "qa_step_ordering": ORDERING,
    "qa_reconcile": RECONCILE,
    "qa_purchase_grain": PURCHASE_GRAIN,
    "qa_row_counts": ROW_COUNTS,
    "qa_summary": _summary(),
}


def check(sql: str, fault: bool) -> str:
    """A check over the tables as built, or over their faulty copies."""
    names = {t: f"bad_{t}" if fault and t in FAULTS else t for t in TABLES}
    more = [f"bad_{t} AS ({body})" for t, body in FAULTS.items()] if fault else []
    return with_tables(TABLES, sql.format(**names), *more)


# Loads -----------------------------------------------------------------------

EARLY = "early AS (SELECT * FROM ev WHERE event_date_utc <= DATE '2020-12-30')"


def twice(table: str) -> list[str]:
    """``t2``: the table after a load of the early events and an insert-only load of all."""
    match = " AND ".join(f"o.{k} = n.{k}" for k in KEYS[table])
    return [
        f"{table}_old AS ({bodies('early')[table]})",
        f"{table}_new AS ({bodies('ev')[table]})",
        f"""{table}_2 AS (SELECT * FROM {table}_old UNION ALL SELECT * FROM {table}_new n
    WHERE NOT EXISTS (SELECT 1 FROM {table}_old o WHERE {match}))""",
    ]


LOADED_COUNTS = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {t}_2" for t in TABLES)


# Metrics ---------------------------------------------------------------------


def step_counts(by: list[str], source: str = "ev") -> str:
    """``su``: users per step and segment, steps without users included."""
    names = "".join(f"{c}, " for c in by)
    on = " AND ".join(["e.event_name = s.name", *[f"e.{c} IS NOT DISTINCT FROM g.{c}" for c in by]])
    groups = f"""(SELECT DISTINCT {', '.join(by)} FROM {source}
      WHERE event_name IN ({STEP_NAMES}) AND user_id IS NOT NULL) g
    CROSS JOIN """ if by else ""
    group = "".join(f"g.{c}, " for c in by)
    return f"""su AS (
  SELECT {group}CAST(s.n AS BIGINT) AS funnel_step, s.name AS funnel_event_name, count(DISTINCT e.user_id) AS users
  FROM {groups}({STEPS}) AS s(n, name) LEFT JOIN {source} e ON {on}
  GROUP BY {group}s.n, s.name)"""


def conversion(by: list[str]) -> str:
    names = "".join(f"{c}, " for c in by)
    partition = f"PARTITION BY {', '.join(by)} " if by else ""
    return f"""SELECT {names}funnel_step, funnel_event_name, users, prev_users,
  round(users / nullif(prev_users, 0), 9) AS step_conversion
FROM (SELECT *, lag(users) OVER ({partition}ORDER BY funnel_step) AS prev_users FROM su)"""


def overall(by: list[str]) -> str:
    names = "".join(f"{c}, " for c in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {names}CAST(sum(users) FILTER (funnel_step = 1) AS BIGINT) AS top_users,
  CAST(sum(users) FILTER (funnel_step = 5) AS BIGINT) AS converted_users,
  round(sum(users) FILTER (funnel_step = 5) / nullif(sum(users) FILTER (funnel_step = 1), 0), 9)
    AS overall_conversion
FROM su {group}"""


def active(grain: str, where: str = "TRUE") -> str:
    return f"""SELECT CAST(date_trunc('{grain}', event_date_utc) AS DATE) AS period_start,
  count(DISTINCT user_id) AS active_users FROM ev WHERE {where} GROUP BY 1"""


def churn_by_day(x: int, by: str = "") -> str:
    """``daily``: churned and at risk per date, by the state of every user on every date.

    ``by`` is a key of the user's first day, taken from the user days.
    """
    of = f", {by}" if by else ""
    touched = f", first_day.{by}" if by else ""
    touch = f"""JOIN (SELECT user_id, first({by} ORDER BY activity_date) AS {by} FROM fact_user_daily_activity
  GROUP BY 1) AS first_day USING (user_id)""" if by else ""
    every = f"CROSS JOIN (SELECT DISTINCT {by} FROM days)" if by else ""
    return f"""days AS (SELECT DISTINCT user_id, event_date_utc AS d{touched} FROM ev {touch}
  WHERE user_id IS NOT NULL AND event_date_utc IS NOT NULL),
span AS (SELECT min(d) AS lo, max(d) AS hi FROM days),
calendar AS (SELECT CAST(unnest(generate_series(lo + {x}, hi, INTERVAL 1 DAY)) AS DATE) AS t FROM span),
state AS (
  SELECT t, user_id{of},
    max(d) = t - {x} AS churned,
    min(d) <= t - {x} AND t - 1 - max(d) FILTER (d < t) < {x} AS at_risk
  FROM calendar JOIN days ON d <= t GROUP BY t, user_id{of}),
flagged AS (
  SELECT *, at_risk AND NOT coalesce(lag(at_risk) OVER (PARTITION BY user_id ORDER BY t), FALSE) AS entered
  FROM state),
daily AS (
  SELECT t{of}, count(*) FILTER (churned) AS churned, count(*) FILTER (at_risk) AS at_risk,
    count(*) FILTER (entered) AS entered
  FROM calendar {every} LEFT JOIN flagged USING (t{of}) GROUP BY t{of})"""


CHURN_RATE = """SELECT t AS period_start, churned AS churned_users, at_risk AS at_risk_users,
  round(churned / nullif(at_risk, 0), 9) AS churn_rate FROM daily"""

CHURN_RATE_WEEK = """SELECT week AS period_start, CAST(sum(churned) AS BIGINT) AS churned_users,
  CAST(sum(risk) AS BIGINT) AS at_risk_users, round(sum(churned) / nullif(sum(risk), 0), 9) AS churn_rate
FROM (
  SELECT week, churned, CASE WHEN t = min(t) OVER (PARTITION BY week) THEN at_risk ELSE entered END AS risk
  FROM (SELECT *, CAST(date_trunc('week', t) AS DATE) AS week FROM daily)) GROUP BY week"""


def by_segment(dim: str, attributes: list[str]) -> str:
    key = DIMS[dim][0]
    names = ", ".join(f"d.{a}" for a in attributes)
    return with_tables(
        ["fact_funnel_steps", dim],
        f"""SELECT {', '.join(attributes)}, {", ".join(FUNNEL_COLUMNS)}, {RATES} FROM counted""",
        f"""per_session AS (
  SELECT session_key, max(funnel_step) AS top, first({key} ORDER BY step_ts, {key}) AS {key}
  FROM fact_funnel_steps GROUP BY 1)""",
        f"counted AS (SELECT {names}, {REACHED} FROM per_session LEFT JOIN {dim} d USING ({key}) GROUP BY {names})",
    )


FUNNEL_COLUMNS = [
    "sessions",
    "sessions_view_item",
    "sessions_add_to_cart",
    "sessions_begin_checkout",
    "sessions_purchase",
]


def gap_sessions(gap: str) -> str:
    return f"""flagged AS (
  SELECT *, CASE WHEN event_ts_utc - lag(event_ts_utc) OVER w <= INTERVAL {gap} THEN 0 ELSE 1 END AS opens
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_ts_utc)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_ts_utc) AS nr FROM flagged),
derived AS (
  SELECT *, CASE WHEN user_id IS NOT NULL AND event_ts_utc IS NOT NULL
    THEN epoch_us(min(event_ts_utc) OVER (PARTITION BY user_id, nr)) END AS derived_id FROM numbered)"""


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {
        "stg_events_base": with_tables([], "SELECT * REPLACE (round(purchase_revenue, 9) AS purchase_revenue) FROM stg"),
        "stg_events_enriched": with_tables(
            [], f"SELECT * REPLACE ({money('purchase_revenue')} AS purchase_revenue) FROM ev"
        ),
        "event_slices": with_tables(
            [],
            f"""SELECT user_id, ga_session_id, ga_session_number, event_date_utc, event_name, device_category, platform,
  country, region, traffic_source, traffic_medium, traffic_campaign, count(*) AS event_count,
  min(event_ts_utc) AS first_ts, max(event_ts_utc) AS last_ts,
  {money("sum(purchase_revenue) FILTER (event_name = 'purchase')")} AS purchase_revenue
FROM ev GROUP BY ALL""",
        ),
    }

    found |= {t: with_tables([t], shown(t)) for t in TABLES}
    for name, (key, attributes) in DIMS.items():
        found[f"{name}_reference_grain"] = with_tables([], dim_body(key, attributes, "ev", "reference"))
    found["dim_date_contiguous"] = with_tables(
        [],
        shown("dim_date", "calendar"),
        """all_days AS (SELECT CAST(unnest(generate_series(min(event_date_utc), max(event_date_utc), INTERVAL 1 DAY))
    AS DATE) AS event_date_utc FROM ev)""",
        f"calendar AS ({bodies('all_days')['dim_date']})",
    )
    order = "ORDER BY event_ts_utc, event_date_utc, user_id, device_key, geo_key, traffic_key"
    found["fact_funnel_steps_session_step"] = with_tables(
        [],
        f"""SELECT session_key, user_id, event_date_utc AS session_date, CAST({STEP} AS BIGINT) AS funnel_step,
  event_name AS funnel_event_name, event_ts_utc AS step_ts, device_key, geo_key, traffic_key
FROM (SELECT *, row_number() OVER (PARTITION BY session_key, event_name {order}) AS rn
  FROM ev WHERE session_key IS NOT NULL AND {STEP} IS NOT NULL) WHERE rn = 1""",
    )

    found["mrt_funnel_daily"] = with_tables(
        ["fact_funnel_steps"],
        f"SELECT session_date, {', '.join(FUNNEL_COLUMNS)}, {RATES} FROM counted",
        """per_session AS (SELECT session_key, min(session_date) AS session_date, max(funnel_step) AS top
  FROM fact_funnel_steps GROUP BY 1)""",
        f"counted AS (SELECT session_date, {REACHED} FROM per_session GROUP BY 1)",
    )
    found["mrt_retention_cohorts"] = with_tables(USERS_DAYS, "SELECT * FROM cells", WEEKLY_COHORTS)
    found["mrt_retention_curve"] = with_tables(USERS_DAYS, curve("week_index"), WEEKLY_COHORTS)
    found["mrt_churn_proxy"] = with_tables(USERS_DAYS, "SELECT * FROM churn", CHURN)
    found["mrt_wow_kpis"] = with_tables(
        ["fact_user_daily_activity", "fact_sessions"], ", " + weekly_kpis("fact_user_daily_activity")
    )
    found["wow_kpis_with_events"] = with_tables(
        ["fact_user_daily_activity", "fact_sessions"],
        "SELECT * FROM kpis JOIN events_weekly USING (week_start) ORDER BY week_start",
        "kpis AS (WITH " + weekly_kpis("fact_user_daily_activity") + ")",
        """events_weekly AS (SELECT CAST(date_trunc('week', event_date_utc) AS DATE) AS week_start, count(*) AS events
  FROM ev WHERE user_id IS NOT NULL GROUP BY 1)""",
    )
    found["retention_cohorts_zero_cells"] = with_tables(
        USERS_DAYS,
        """SELECT g.cohort AS cohort_week, g.i AS week_index, g.cohort_size,
  coalesce(active_users, 0) AS active_users, round(coalesce(active_users, 0) / g.cohort_size, 9) AS retention_rate
FROM grid g LEFT JOIN cells c ON c.cohort_week = g.cohort AND c.week_index = g.i""",
        ALL_WEEKS,
        """grid AS (
  SELECT cohort, cohort_size, i FROM sizes, range(0, 1000) AS r(i),
    (SELECT max(activity_date) AS hi FROM fact_user_daily_activity) WHERE cohort + 7 * CAST(i AS INTEGER) <= hi)""",
    )
    bought = bodies("bought")
    some_days = ["bought AS (SELECT * FROM ev WHERE event_name = 'purchase')"]
    some_days += [f"{t} AS ({bought[t]})" for t in ("fact_user_daily_activity", "fact_sessions")]
    all_weeks = """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week_start
    FROM (SELECT min(week_start) AS lo, max(week_start) AS hi FROM w)"""
    filled = ", " + weekly_kpis("fact_user_daily_activity", all_weeks, fill=True)
    found["wow_kpis_weeks_filled"] = with_tables(["fact_user_daily_activity", "fact_sessions"], filled)
    found["wow_kpis_purchase_weeks_filled"] = with_tables([], filled, *some_days)
    for name in ("mrt_funnel_daily", "mrt_retention_cohorts"):
        found[f"{name}_at_rest"] = found[name]
    found["mart_view_by_name"] = found["mrt_wow_kpis"]

    for name, sql in CHECKS.items():
        found[name] = check(sql, fault=False)
        found[f"{name}_dirty"] = check(sql, fault=True)
    found["qa_dim_duplicates"] = check(
        "\nUNION ALL ".join(
            f"SELECT 'extra_dupes_{t}_{KEYS[t][0]}' AS metric, count(*) AS value FROM ({duplicates(t)})"
            for t in ["dim_date", *DIMS]
        ),
        fault=False,
    )
    found["qa_purchase_grain_before"] = with_tables(
        [],
        """SELECT count(*) FILTER (n > 1) AS dup_purchase_keys, CAST(sum(missing) AS BIGINT) AS purchase_null_revenue_cnt
FROM (SELECT purchase_key, count(*) AS n, count(*) FILTER (purchase_revenue IS NULL) AS missing FROM bought GROUP BY 1)""",
        f"""bought AS (SELECT * FROM (SELECT *, {PURCHASE_KEY} AS purchase_key FROM ev WHERE event_name = 'purchase')
  WHERE user_id IS NOT NULL AND purchase_key IS NOT NULL)""",
    )
    found["qa_unkeyed"] = with_tables(
        [],
        f"""SELECT 'unkeyed_events_user' AS metric, count(*) FILTER (user_id IS NULL) AS value FROM ev
UNION ALL SELECT 'unkeyed_events_date', count(*) FILTER (event_date_utc IS NULL) FROM ev
UNION ALL SELECT 'unkeyed_events_session', count(*) FILTER (session_key IS NULL) FROM ev
UNION ALL SELECT 'unkeyed_events_purchase', count(*) FILTER (event_name = 'purchase'
  AND (user_id IS NULL OR {PURCHASE_KEY} IS NULL)) FROM ev""",
    )

    for t in TABLES:
        found[f"incremental_{t}"] = with_tables([], shown(t, f"{t}_2"), EARLY, *twice(t))
        found[f"load_incremental_{t}"] = found[f"incremental_{t}"]
        found[f"load_full_{t}"] = found[t]
        found[f"load_merge_{t}"] = found[t]
    first_load = "first_load AS (SELECT * FROM early WHERE epoch_us(event_ts_utc) % 5 <> 0)"
    measured = [f"SELECT 'count_{t}' AS metric, count(*) AS value FROM {t}_1" for t in TABLES]
    measured += [f"SELECT 'nulls_{t}_{c}', count(*) FILTER ({c} IS NULL) FROM {t}_1" for t, cs in WATCHED.items() for c in cs]
    found["load_measures"] = with_tables(
        [], "\nUNION ALL ".join(measured), EARLY, first_load, *[f"{t}_1 AS ({bodies('first_load')[t]})" for t in TABLES]
    )
    found["load_changed_shards"] = with_tables(
        [],
        """SELECT strftime(event_date_utc, '%Y%m%d') AS day, count(*) AS rows,
  CAST(CASE WHEN strftime(event_date_utc, '%Y%m%d') IN ('20201210', '20201125') THEN 2
    WHEN strftime(event_date_utc, '%Y%m%d') = '20201201' AND bool_or(epoch_us(event_ts_utc) % 2 <> 0) THEN 2 ELSE 1 END AS BIGINT) AS version
FROM ev WHERE event_date_utc BETWEEN DATE '2020-11-20' AND DATE '2020-12-10' GROUP BY event_date_utc""",
    )
    found["stream_gap_sessions"] = with_tables(
        [],
        """SELECT user_id, derived_id AS session_id, min(event_ts_utc) AS session_start_ts, max(event_ts_utc) AS session_end_ts,
  count(*) AS event_count, count(*) FILTER (ga_session_id IS NULL) AS derived_count
FROM derived WHERE derived_id IS NOT NULL GROUP BY user_id, derived_id
HAVING max(event_ts_utc) + INTERVAL 8 HOUR <= (SELECT max(event_ts_utc) - INTERVAL 40 DAY FROM ev WHERE user_id IS NOT NULL)""",
        gap_sessions("8 HOUR"),
    )
    found["stream_load_fact_sessions"] = found["fact_sessions"]
    for t in ("dim_user", "fact_sessions", "fact_funnel_steps", "fact_purchases"):
        found[f"load_filtered_{t}"] = found[f"incremental_{t}"]
    found["load_snapshot_previous"] = with_tables(
        [],
        shown("fact_sessions", "first_sessions"),
        EARLY,
        first_load,
        f"first_sessions AS ({bodies('first_load')['fact_sessions']})",
    )
    found["fact_purchases_rebuilt"] = found["fact_purchases"]
    found["source_day_shards"] = found["stg_events_base"] + " WHERE event_date_utc BETWEEN DATE '2020-11-20' AND DATE '2020-12-10'"
    found["load_full"] = with_tables(TABLES, ROW_COUNTS.format(**{t: t for t in TABLES}))
    both = [part for t in TABLES for part in twice(t)]
    found["load_incremental"] = with_tables([], LOADED_COUNTS, EARLY, *both)
    found["load_rerun"] = found["load_incremental"]

    found["activated_users"] = with_tables(
        [], "SELECT count(DISTINCT user_id) AS activated_users FROM ev WHERE event_name = 'purchase'"
    )
    found["activated_users_by_country"] = with_tables(
        [],
        """SELECT country, count(DISTINCT user_id) AS activated_users FROM ev
WHERE event_name = 'purchase' AND event_date_utc BETWEEN DATE '2020-11-15' AND DATE '2020-12-31' GROUP BY 1""",
    )
    found["step_users"] = with_tables([], "SELECT * FROM su", step_counts([]))
    found["step_users_by_device"] = with_tables([], "SELECT * FROM su", step_counts(["device_category"]))
    found["step_conversion"] = with_tables([], conversion([]), step_counts([]))
    traffic = ["traffic_source", "traffic_medium"]
    found["step_conversion_by_traffic"] = with_tables([], conversion(traffic), step_counts(traffic))
    found["overall_conversion"] = with_tables([], overall([]), step_counts([]))
    found["overall_conversion_by_country"] = with_tables([], overall(["country"]), step_counts(["country"]))
    found["dropoff"] = with_tables(
        [],
        f"SELECT *, round(1 - users / nullif(prev_users, 0), 9) AS dropoff_rate FROM ({conversion([])})",
        step_counts([]),
    )
    for grain in ("day", "week", "month"):
        found[f"active_users_{grain}"] = with_tables([], active(grain))
    found["active_users_without_noise"] = with_tables([], active("day", "event_name NOT IN ('error', 'scroll')"))

    found["retention_activation_cohort"] = with_tables(
        USERS_DAYS, "SELECT * FROM cells", cohorts("first_purchase", "week", None, "cohort_week", "week_index")
    )
    found["retention_session_start_cohort"] = with_tables(
        USERS_DAYS, "SELECT * FROM cells", cohorts("session_start", "week", None, "cohort_week", "week_index")
    )
    found["retention_nday_30"] = with_tables(
        USERS_DAYS, "SELECT * FROM cells", cohorts("session_start", "day", 30, "cohort_date", "day_index")
    )
    found["retention_by_device"] = with_tables(
        USERS_DAYS,
        "SELECT * FROM cells",
        cohorts("first_seen", "week", None, "cohort_week", "week_index", "device_key"),
    )
    found["retention_by_traffic_curve"] = with_tables(
        USERS_DAYS,
        curve("week_index", "traffic_key"),
        cohorts("first_seen", "week", None, "cohort_week", "week_index", "traffic_key"),
    )
    nday = cohorts("session_start", "day", None, "cohort_date", "day_index")
    found["retention_nday"] = with_tables(USERS_DAYS, "SELECT * FROM cells", nday)
    found["retention_nday_curve"] = with_tables(USERS_DAYS, curve("day_index"), nday)

    for x in (14, 30, 60):
        found[f"churn_rate_{x}d"] = with_tables([], CHURN_RATE, churn_by_day(x))
    found["churn_rate_30d_by_geo"] = with_tables(
        ["fact_user_daily_activity"], CHURN_RATE.replace("SELECT t", "SELECT geo_key, t"), churn_by_day(30, "geo_key")
    )
    found["churn_rate_14d_week"] = with_tables([], CHURN_RATE_WEEK, churn_by_day(14))
    for n in (7, 28):
        found[f"rolling_active_users_{n}d"] = with_tables(
            [],
            f"""SELECT CAST(t AS DATE) AS activity_date, (SELECT count(DISTINCT user_id) FROM days
  WHERE d BETWEEN t - INTERVAL {n - 1} DAY AND t) AS active_users
FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS t FROM days)""",
            "days AS (SELECT DISTINCT user_id, event_date_utc AS d FROM ev WHERE user_id IS NOT NULL AND event_date_utc IS NOT NULL)",
        )
    found["calendar_retention_nday"] = found["retention_nday"]
    found["calendar_churn_rate_30d"] = found["churn_rate_30d"]
    found["calendar_churn_rate_14d_week"] = found["churn_rate_14d_week"]
    active_days = "FROM ev WHERE user_id IS NOT NULL AND event_date_utc IS NOT NULL"
    month = "CAST(date_trunc('month', event_date_utc) AS DATE)"
    found["sketched_users_month"] = with_tables(
        [], f"SELECT {month} AS period_start, count(DISTINCT user_id) AS exact_users, TRUE AS in_bound {active_days} GROUP BY 1"
    )
    found["sketched_users_overlap"] = with_tables(
        [],
        f"""SELECT count(*) FILTER (a AND b) AS exact_both, count(*) AS exact_either, TRUE AS in_bound
FROM (SELECT user_id, bool_or(event_date_utc <= DATE '2020-12-30') AS a, bool_or(event_date_utc > DATE '2020-12-30') AS b {active_days} GROUP BY 1)""",
    )
    found["sketched_event_deciles"] = with_tables(
        [],
        f"""SELECT period_start, round(p / 10, 9) AS point, count(*) AS user_days, TRUE AS in_bound
FROM (SELECT DISTINCT user_id, event_date_utc, {month} AS period_start {active_days}), range(1, 10) AS r(p) GROUP BY 1, 2""",
    )
    found["churn_by_purchaser"] = with_tables(
        USERS_DAYS,
        """SELECT is_purchaser, count(*) AS users, round(avg(churn_14d), 9) AS churn_14d_rate,
  round(avg(churn_30d), 9) AS churn_30d_rate, round(avg(churn_60d), 9) AS churn_60d_rate FROM churn GROUP BY 1""",
        CHURN,
    )
    found["churn_sensitivity"] = with_tables(
        USERS_DAYS,
        """SELECT CAST(x AS BIGINT) AS window_days, count(*) AS users,
  count(*) FILTER (days_since_last_active >= x) AS churned_users,
  round(count(*) FILTER (days_since_last_active >= x) / count(*), 9) AS churned_share
FROM churn, (VALUES (14), (30), (60)) AS v(x) GROUP BY x""",
        CHURN,
    )
    found["event_volume"] = with_tables([], "SELECT event_date_utc AS period_start, count(*) AS events FROM ev GROUP BY 1")
    found["purchases_per_purchaser"] = with_tables(
        [],
        """SELECT count(*) AS purchase_events, count(DISTINCT user_id) AS purchase_users,
  round(count(*) / nullif(count(DISTINCT user_id), 0), 9) AS purchases_per_purchaser
FROM ev WHERE event_name = 'purchase'""",
    )
    found["profile_events"] = with_tables(
        [],
        """SELECT 'events_per_user_p' || lpad(CAST(10 * i AS VARCHAR), 2, '0') AS metric,
  round(CAST(q[i + 1] AS DOUBLE), 9) AS value
FROM (SELECT quantile_cont(n, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q
  FROM (SELECT count(*) AS n FROM ev WHERE user_id IS NOT NULL GROUP BY user_id)), range(0, 11) AS r(i)
WHERE i < 10
UNION ALL SELECT 'events_per_user_p100', CAST(max(n) AS DOUBLE)
FROM (SELECT count(*) AS n FROM ev WHERE user_id IS NOT NULL GROUP BY user_id)
UNION ALL SELECT 'ga_session_id_coverage', round(count(ga_session_id) / count(*), 9) FROM ev""",
    )
    found["funnel_by_device"] = by_segment("dim_device", ["device_category"])
    found["funnel_by_geo"] = by_segment("dim_geo", ["country", "region"])
    found["funnel_by_traffic"] = by_segment("dim_traffic_source", ["traffic_source", "traffic_medium"])
    for name, source in (("new_vs_returning", "dim_user"), ("new_vs_returning_unknown_users", "buyers")):
        found[name] = with_tables(
            ["dim_user"],
            f"""SELECT event_date_utc AS activity_date,
  count(DISTINCT user_id) FILTER (event_date_utc = first_seen_date) AS new_users,
  count(DISTINCT user_id) FILTER (event_date_utc > first_seen_date) AS returning_users,
  count(DISTINCT user_id) FILTER (first_seen_date IS NULL) AS unknown_users,
  count(DISTINCT user_id) AS active_users
FROM ev LEFT JOIN {source} USING (user_id) WHERE user_id IS NOT NULL AND event_date_utc IS NOT NULL GROUP BY 1""",
            "buyers AS (SELECT * FROM dim_user WHERE is_purchaser)",
        )
    status = """CASE WHEN {0} = first_seen_date THEN 'new' WHEN {0} > first_seen_date THEN 'returning'
  ELSE 'unknown' END AS user_status"""
    told = f"""told AS (SELECT ev.*, {status.format('event_date_utc')}
  FROM ev LEFT JOIN dim_user USING (user_id))"""
    found["activated_users_by_status"] = with_tables(
        ["dim_user"],
        """SELECT user_status, count(DISTINCT user_id) AS activated_users FROM told WHERE event_name = 'purchase'
GROUP BY 1""",
        told,
    )
    found["step_users_by_status"] = with_tables(
        ["dim_user"], "SELECT * FROM su", told, step_counts(["user_status"], "told")
    )
    found["funnel_by_status"] = with_tables(
        ["fact_funnel_steps", "dim_user"],
        f"SELECT session_date, user_status, {', '.join(FUNNEL_COLUMNS)}, {RATES} FROM counted",
        f"""told_steps AS (SELECT s.*, {status.format('session_date')}
  FROM fact_funnel_steps s LEFT JOIN dim_user USING (user_id))""",
        """per_session AS (SELECT session_key, min(session_date) AS session_date, max(funnel_step) AS top,
  first(user_status ORDER BY step_ts, user_status) AS user_status FROM told_steps GROUP BY 1)""",
        f"counted AS (SELECT session_date, user_status, {REACHED} FROM per_session GROUP BY 1, 2)",
    )
    opened = """opened AS (SELECT * FROM ev UNION ALL
  SELECT * EXCLUDE (rn, started) REPLACE ('session_start' AS event_name) FROM (
    SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY event_ts_utc, event_date_utc, user_id, {0}) AS rn,
      count(*) FILTER (event_name = 'session_start') OVER (PARTITION BY session_key) > 0 AS started
    FROM ev WHERE session_key IS NOT NULL) WHERE rn = 1 AND NOT started)"""
    found["step_users_first_event"] = with_tables([], "SELECT * FROM su", opened.format("platform"), step_counts([], "opened"))
    found["step_users_first_event_by_device"] = with_tables(
        [],
        "SELECT * FROM su",
        opened.format("device_category NULLS FIRST"),
        step_counts(["device_category"], "opened"),
    )
    found["overall_conversion_first_event"] = with_tables([], overall([]), opened.format("platform"), step_counts([], "opened"))
    found["fact_funnel_steps_first_event"] = with_tables(
        [],
        shown("fact_funnel_steps", "steps"),
        opened.format("device_key, geo_key, traffic_key"),
        f"steps AS ({bodies('opened')['fact_funnel_steps']})",
    )
    found["daily_activity_without_noise"] = with_tables(
        [],
        shown("fact_user_daily_activity", "quiet_days"),
        "quiet AS (SELECT * FROM ev WHERE event_name IS NULL OR event_name NOT IN ('error', 'scroll'))",
        f"quiet_days AS ({bodies('quiet')['fact_user_daily_activity']})",
    )
    found["dedup_events_unidentified"] = with_tables(
        [],
        """SELECT * EXCLUDE (device_key, geo_key, traffic_key, session_key)
  REPLACE (CAST(purchase_revenue AS VARCHAR) AS purchase_revenue)
FROM (SELECT * FROM ev UNION ALL SELECT * REPLACE (platform || '_RETRY' AS platform) FROM ev)
WHERE user_id IS NULL OR event_ts_utc IS NULL""",
    )
    found["dedup_events"] = with_tables(
        [],
        """SELECT * EXCLUDE (rn, device_key, geo_key, traffic_key, session_key)
  REPLACE (CAST(purchase_revenue AS VARCHAR) AS purchase_revenue)
FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_ts_utc, event_name, ga_session_id, transaction_id ORDER BY platform) AS rn
  FROM (SELECT * FROM ev UNION ALL SELECT * REPLACE (platform || '_RETRY' AS platform) FROM ev))
WHERE rn = 1 OR user_id IS NULL OR event_ts_utc IS NULL""",
    )
    found["sessionize_gap"] = with_tables(
        [], "SELECT user_id, event_ts_utc, event_name, derived_id AS session_id FROM derived", gap_sessions("30 MINUTE")
    )
    found["sessionize_fallback"] = with_tables(
        [],
        """SELECT user_id, event_ts_utc, event_name, ga_session_id, coalesce(ga_session_id, derived_id) AS session_id
FROM derived""",
        gap_sessions("8 HOUR"),
    )
    found["fact_sessions_with_gap_sessions"] = with_tables(
        [],
        shown("fact_sessions", "filled_sessions"),
        gap_sessions("8 HOUR"),
        """filled AS (SELECT * REPLACE (coalesce(ga_session_id, derived_id) AS ga_session_id,
    user_id || '-' || CAST(coalesce(ga_session_id, derived_id) AS VARCHAR) AS session_key) FROM derived)""",
        f"filled_sessions AS ({bodies('filled')['fact_sessions']})",
    )
    found["session_start_resolved"] = with_tables(
        [],
        """SELECT session_key, coalesce(min(event_ts_utc) FILTER (event_name = 'session_start'), min(event_ts_utc))
    AS session_start_ts,
  count(*) FILTER (event_name = 'session_start') > 0 AS has_start_event
FROM ev WHERE session_key IS NOT NULL GROUP BY 1""",
    )
    local = """local_ev AS (SELECT * REPLACE (
  CAST(event_ts_utc + INTERVAL 5 HOUR + INTERVAL 30 MINUTE AS DATE) AS event_date_utc) FROM ev)"""
    found["daily_activity_reporting_tz"] = with_tables(
        [],
        shown("fact_user_daily_activity", "local_days"),
        local,
        f"local_days AS ({bodies('local_ev')['fact_user_daily_activity']})",
    )
    return found
