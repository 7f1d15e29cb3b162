"""The given ``events`` table in the shape of a nested event export.

Every row of the table becomes one raw event. The table's users are alike: all start
on the first day and stay to the last. So that cohorts, retention and churn have
something to show, each user's events are moved in time, by integer arithmetic only:
a later first day, a longer or shorter stay, and a pause half-way for two users in three.
Some users never purchase and some never fire ``session_start``. Attributes change from event to event; a few events
have no user or no time, and some give their session id twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usertide.operators.staging import enrich_events, stage_events
from usertide.session import prepare

# Fixed values of the mapping, in microseconds: source epoch 2024-01-01, target epoch 2020-11-01.
SOURCE_EPOCH = 1704067200000000
TARGET_EPOCH = 1604188800000000
DAY = 86400000000
SESSION = 4 * DAY

_NESTED = f"""
    with moved as (
      select event_id, user_id, event_type, value,
        cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
        unix_micros(cast(ts as timestamp)) - {SOURCE_EPOCH} as x,
        {TARGET_EPOCH} + 7 * (user_id % 7) * {DAY} as arrival
      from {{events}}),
    timed as (
      select *, arrival + (x * (3 + 11 * (user_id % 5))) div 30
        + if(x >= 15 * {DAY}, 16 * (user_id % 3) * {DAY}, 0) as u
      from moved)
    select
      if(event_id % 61 = 7, null, cast(user_id as string)) as user_pseudo_id,
      if(event_id % 67 = 5, null, u) as event_timestamp,
      case event_type when 'signup' then if(user_id % 7 = 6, 'scroll', 'session_start')
        when 'view' then 'view_item'
        when 'click' then if(k < 60, 'add_to_cart', 'begin_checkout')
        when 'purchase' then if(user_id % 6 = 5, 'view_item', 'purchase')
        else event_type end as event_name,
      if((user_id + sid + event_id % 9 div 8) % 4 = 3, 'APP', 'WEB') as platform,
      named_struct('category',
        case k % 20 when 0 then null when 1 then ''
          else element_at(array('desktop', 'mobile', 'tablet'), cast((user_id + sid) % 3 as int) + 1)
        end) as device,
      named_struct(
        'country', concat('NATION_', (user_id + event_id % 8 div 7) % 25),
        'region', case when user_id % 25 % 6 = 0 then if(event_id % 2 = 0, null, '')
          else concat('REGION_', user_id % 25 % 5) end) as geo,
      named_struct(
        'source', element_at(array('google', '(direct)', 'newsletter', 'partner', null), cast((user_id + event_id % 7 div 6) % 5 as int) + 1),
        'medium', element_at(array('organic', '(none)', 'email', 'referral', null), cast(user_id % 5 as int) + 1),
        'name', if(sid % 2 = 0, 'brand', null)) as traffic_source,
      array(
        named_struct('key', if(k = 99, 'batch', 'ga_session_id'), 'value', named_struct('int_value', sid)),
        named_struct('key', if(k <> 99 and event_id % 5 = 0, 'ga_session_id', 'page'), 'value',
          named_struct('int_value', -1L)),
        named_struct('key', 'ga_session_number', 'value',
          named_struct('int_value', sid - arrival div {SESSION} + 1))
      ) as event_params,
      named_struct(
        'transaction_id', if(k % 4 <> 0, concat('T', event_id div 12), null),
        'purchase_revenue', if(k % 10 <> 0, value, null)) as ecommerce
    from (select *, u div {SESSION} as sid from timed)
"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the events table as nested raw events."""
    prepare(spark)
    return spark.sql(_NESTED, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_events(raw_events(spark, sf_dir))


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(staged_events(spark, sf_dir))
