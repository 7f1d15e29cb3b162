"""Column helpers: keyed lookup, keys, calendar and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the purchase event, which also serves as activation event.
PURCHASE = "purchase"

# Funnel events and their step numbers.
FUNNEL_STEPS: dict[str, int] = {
    "session_start": 1,
    "view_item": 2,
    "add_to_cart": 3,
    "begin_checkout": 4,
    "purchase": 5,
}


def param_int(key: str, params: str = "event_params") -> Column:
    """``int_value`` of the first entry with this key, NULL when there is none.

    Reads the array by field, so the scan prunes to ``key`` and ``value.int_value``
    and no row is exploded.
    """
    return F.expr(f"get({params}.value.int_value, cast(array_position({params}.key, '{key}') as int) - 1)")


def attribute_key(*columns: str) -> Column:
    """Hash of the attributes joined by '|', a NULL counting as the empty text."""
    parts = ", '|', ".join(f"coalesce({name}, '')" for name in columns)
    return F.expr(f"md5(concat({parts}))")


def session_key(user: str = "user_id", session: str = "ga_session_id") -> Column:
    """``user-session``; NULL when either part is NULL."""
    return F.expr(f"concat({user}, '-', cast({session} as string))")


def user_home(user: str = "user_id") -> Column:
    """The user without trailing hyphens: one value for all users who could share a session key.

    ``a-`` with session 5 and ``a`` with session -5 have the same key, and no other users can. So rows that are stored by this column hold
    users and sessions whole, and grouping by it as well changes no group of either.
    """
    return F.rtrim(F.col(user), F.lit("-"))


def session_home(*others: str) -> Column:
    """The session key; rows without one are dealt to up to 1024 values by ``others``, so that they do not lie all together.

    Rows that are stored by this column hold sessions whole, and grouping by it as well changes no group of a session, nor any of ``others``.
    """
    dealt = F.concat(F.lit("-"), F.pmod(F.xxhash64(*others), F.lit(1024)).cast("string"))
    return F.coalesce(session_key(), dealt)


def micros_date(micros: str) -> str:
    """SQL for the calendar date of microseconds since 1970, whatever the session's time zone."""
    return f"date_add(date'1970-01-01', cast(({micros} - pmod({micros}, 86400000000L)) div 86400000000L as int))"


def timestamp_text(ts: str) -> str:
    """SQL for a UTC timestamp as text with 0, 3 or 6 fraction digits and the offset ``+00``."""
    micros = f"unix_micros({ts})"
    second = f"pmod({micros}, 86400000000L) div 1000000L"
    fraction = f"pmod({micros}, 1000000L)"

    def two(number: str) -> str:
        return f"lpad(cast({number} as string), 2, '0')"

    return f"""concat(cast({micros_date(micros)} as string), ' ', {two(f"{second} div 3600")}, ':',
        {two(f"{second} div 60 % 60")}, ':', {two(f"{second} % 60")},
        case when {fraction} = 0 then ''
             when {fraction} % 1000 = 0 then concat('.', lpad(cast({fraction} div 1000 as string), 3, '0'))
             else concat('.', lpad(cast({fraction} as string), 6, '0')) end, '+00')"""


def purchase_key(user: str = "user_id", ts: str = "event_ts_utc", transaction: str = "transaction_id") -> Column:
    """The transaction id, or a hash of user and time where there is none."""
    return F.expr(f"coalesce({transaction}, md5(concat({user}, '|', {timestamp_text(ts)})))")


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def period_start(day: Column, grain: str) -> Column:
    """First day of the day, Monday week or month that holds ``day``."""
    if grain == "day":
        return day
    if grain in ("week", "month"):
        return F.trunc(day, grain)
    raise ValueError(f"grain must be day, week or month, not {grain!r}")


def to_reporting_date(ts: Column, tz: str = "UTC") -> Column:
    """Calendar date of a UTC timestamp in the reporting time zone."""
    micros = F.unix_micros(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))
    day = (micros - F.pmod(micros, F.lit(86400000000))) / 86400000000
    return F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int"))


def between_dates(column: str, start: str | None, end: str | None) -> Column:
    """Inclusive date range; an open end is unbounded."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(column) >= F.to_date(F.lit(start)))
    if end is not None:
        test = test & (F.col(column) <= F.to_date(F.lit(end)))
    return test


def is_event(name: str) -> Column:
    """True only where the event name is known and equal."""
    return F.coalesce(F.col("event_name") == name, F.lit(False))
