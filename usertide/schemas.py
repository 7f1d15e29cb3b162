"""Typed schemas of the raw export and of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "money": MONEY,
}


def _struct(*required: str, **columns: str | T.DataType) -> T.StructType:
    """Columns by name and type; those named in ``required`` may not be NULL."""
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind, name not in required)
            for name, kind in columns.items()
        ]
    )


RAW_EVENTS = _struct(
    user_pseudo_id="string",
    event_timestamp="bigint",
    event_name="string",
    platform="string",
    device=_struct(category="string"),
    geo=_struct(country="string", region="string"),
    traffic_source=_struct(source="string", medium="string", name="string"),
    event_params=T.ArrayType(
        _struct(
            key="string",
            value=_struct(string_value="string", int_value="bigint", float_value="double", double_value="double"),
        )
    ),
    ecommerce=_struct(transaction_id="string", purchase_revenue="double"),
)

TABLES: dict[str, T.StructType] = {
    "dim_date": _struct(
        "date_day",
        date_day="date",
        year="bigint",
        quarter="bigint",
        month="bigint",
        month_name="string",
        week="bigint",
        day_of_week="bigint",
        day_name="string",
        is_weekend="boolean",
    ),
    "dim_user": _struct(
        "user_id",
        user_id="string",
        first_seen_ts="timestamp",
        first_seen_date="date",
        first_purchase_ts="timestamp",
        first_purchase_date="date",
        is_purchaser="boolean",
    ),
    "dim_device": _struct("device_key", device_key="string", device_category="string", platform="string"),
    "dim_geo": _struct("geo_key", geo_key="string", country="string", region="string"),
    "dim_traffic_source": _struct(
        "traffic_key",
        traffic_key="string",
        traffic_source="string",
        traffic_medium="string",
        traffic_campaign="string",
    ),
    "fact_sessions": _struct(
        "session_key",
        "user_id",
        session_key="string",
        user_id="string",
        session_id="bigint",
        session_number="bigint",
        session_start_ts="timestamp",
        session_end_ts="timestamp",
        session_date="date",
        device_key="string",
        geo_key="string",
        traffic_key="string",
        event_count="bigint",
        purchase_count="bigint",
        revenue="money",
    ),
    "fact_funnel_steps": _struct(
        "session_key",
        "user_id",
        "funnel_step",
        "funnel_event_name",
        session_key="string",
        user_id="string",
        session_date="date",
        funnel_step="bigint",
        funnel_event_name="string",
        step_ts="timestamp",
        device_key="string",
        geo_key="string",
        traffic_key="string",
    ),
    "fact_user_daily_activity": _struct(
        "user_id",
        "activity_date",
        user_id="string",
        activity_date="date",
        device_key="string",
        geo_key="string",
        traffic_key="string",
        is_active="boolean",
        event_count="bigint",
        had_session_start="boolean",
        had_view_item="boolean",
        had_add_to_cart="boolean",
        had_begin_checkout="boolean",
        had_purchase="boolean",
        purchase_count="bigint",
        revenue="money",
    ),
    "fact_purchases": _struct(
        "purchase_key",
        "user_id",
        purchase_key="string",
        user_id="string",
        purchase_ts="timestamp",
        purchase_date="date",
        transaction_id="string",
        revenue="money",
        device_key="string",
        geo_key="string",
        traffic_key="string",
        session_key="string",
    ),
}

# The rollup at rest: the columns that hold a slice, and its measures.
SLICES = _struct(
    user_id="string",
    ga_session_id="bigint",
    ga_session_number="bigint",
    event_date_utc="date",
    event_name="string",
    device_category="string",
    platform="string",
    country="string",
    region="string",
    traffic_source="string",
    traffic_medium="string",
    traffic_campaign="string",
    event_count="bigint",
    first_ts="timestamp",
    last_ts="timestamp",
    purchase_revenue="money",
)

# The key under which a load finds a row already present.
LOAD_KEYS: dict[str, list[str]] = {
    "dim_date": ["date_day"],
    "dim_user": ["user_id"],
    "dim_device": ["device_key"],
    "dim_geo": ["geo_key"],
    "dim_traffic_source": ["traffic_key"],
    "fact_sessions": ["session_key"],
    "fact_funnel_steps": ["session_key", "funnel_step"],
    "fact_user_daily_activity": ["user_id", "activity_date"],
    "fact_purchases": ["purchase_key"],
}

DIM_ATTRIBUTES: dict[str, tuple[str, list[str]]] = {
    "dim_device": ("device_key", ["device_category", "platform"]),
    "dim_geo": ("geo_key", ["country", "region"]),
    "dim_traffic_source": ("traffic_key", ["traffic_source", "traffic_medium", "traffic_campaign"]),
}

DIM_KEYS = ["device_key", "geo_key", "traffic_key"]

DATE_COLUMN = {
    "fact_sessions": "session_date",
    "fact_funnel_steps": "session_date",
    "fact_user_daily_activity": "activity_date",
    "fact_purchases": "purchase_date",
}

# Catalog tables may be bucketed by the key they are joined and grouped on.
BUCKET_COLUMN = {
    "dim_user": "user_id",
    "fact_user_daily_activity": "user_id",
    "fact_sessions": "session_key",
    "fact_funnel_steps": "session_key",
    "fact_purchases": "purchase_key",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: its columns, order and types.

    Parquet tables do not enforce NOT NULL, so a NULL in a required column raises here.
    """
    columns = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            column = F.coalesce(column, F.raise_error(F.lit(f"NULL in required column {field.name}")))
        columns.append(column.alias(field.name))
    return df.select(*columns)
