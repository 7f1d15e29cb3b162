"""Small builders for hand-written events and readable results."""

from datetime import datetime, timezone

from usertide import enrich_events, stage_events
from usertide.schemas import RAW_EVENTS


def micros(text: str) -> int:
    """Microseconds of a UTC time such as '2020-12-31 23:59:59.5'."""
    when = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return int(when.timestamp()) * 1_000_000 + when.microsecond


def raw(user, ts, name="page_view", session=1, number=1, **more):
    """One raw event; ``params`` overrides the session parameters."""
    params = more.get(
        "params", [(k, v) for k, v in (("ga_session_id", session), ("ga_session_number", number)) if v is not None]
    )
    return {
        "user_pseudo_id": user,
        "event_timestamp": micros(ts) if ts is not None else None,
        "event_name": name,
        "platform": more.get("platform", "WEB"),
        "device": {"category": more.get("category", "desktop")},
        "geo": {"country": more.get("country", "NO"), "region": more.get("region", "Oslo")},
        "traffic_source": {
            "source": more.get("source", "google"),
            "medium": more.get("medium", "organic"),
            "name": more.get("campaign", "brand"),
        },
        "event_params": None
        if params is None
        else [
            {
                "key": key,
                "value": {"string_value": None, "int_value": value, "float_value": None, "double_value": None},
            }
            for key, value in params
        ],
        "ecommerce": {"transaction_id": more.get("txn"), "purchase_revenue": more.get("revenue")},
    }


def raw_frame(spark, *events):
    return spark.createDataFrame(list(events), RAW_EVENTS)


def staged(spark, *events):
    return stage_events(raw_frame(spark, *events))


def enriched(spark, *events):
    return enrich_events(staged(spark, *events))


def rows(df, *columns):
    """Rows as sorted tuples of the given columns, or of all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
