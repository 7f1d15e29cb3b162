"""Activity calendars: per user one array of bits, a bit a day; rolling actives, retention and churn by shifts and counts.

Word w of 64 bits holds the days 64 w to 64 w + 63 since 1970. A user's array goes from the word of the first day to that of the last.
Calendars of two periods or two sources merge by OR, so one is kept at rest and a delta of days is all that is ever added. No user is joined with days:
what follows from a user's days is computed in that user's row, and only changes or cells are counted over the users.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.functions.columns import period_start

_EPOCH = "1970-01-01"
#: A calendar's columns besides the user.
WORDS = ["first_word", "active", "started"]


def _day(number: Column) -> Column:
    return F.date_add(F.lit(_EPOCH).cast("date"), number.cast("int"))


def _calendar(words: DataFrame) -> DataFrame:
    """Rows of (user, word, bits) as one row per user."""
    # as few rows per user as there are words from the first to the last day: 57 in ten years
    merged = words.groupBy("user_id", "word").agg(F.bit_or("a").alias("a"), F.bit_or("s").alias("s"))
    users = merged.groupBy("user_id").agg(
        F.min("word").alias("first_word"),
        F.max("word").alias("_last"),
        F.map_from_entries(F.collect_list(F.struct("word", F.struct("a", "s").alias("bits")))).alias("_held"),
    )

    def column(name: str) -> Column:
        every = F.sequence("first_word", "_last")
        return F.transform(every, lambda w: F.coalesce(F.try_element_at("_held", w)[name], F.lit(0).cast("long")))

    return users.select("user_id", "first_word", column("a").alias("active"), column("s").alias("started"))


def activity_calendar(activity: DataFrame) -> DataFrame:
    """The calendar of every user, from user days (``user_id, activity_date, had_session_start``).

    ``active`` has a bit for each active day, ``started`` for those with a session start. Rows without a user or a date count for nothing; repeated
    rows count once.
    """
    number = F.datediff("activity_date", F.lit(_EPOCH).cast("date")).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))
    known = activity.where("user_id is not null and activity_date is not null")
    started = F.when(F.col("had_session_start"), bit).otherwise(F.lit(0).cast("long"))
    word = F.floor((number - F.pmod(number, F.lit(64))) / 64).cast("long")
    return _calendar(known.select("user_id", word.alias("word"), bit.alias("a"), started.alias("s")))


def merge_calendars(*calendars: DataFrame) -> DataFrame:
    """One calendar of all: the OR of each user's bits."""
    pairs = F.explode(F.arrays_zip(F.col("active").alias("a"), F.col("started").alias("s"), _numbers()))
    words = [c.select("user_id", pairs.alias("w")).select("user_id", "w.word", "w.a", "w.s") for c in calendars]
    return _calendar(reduce(DataFrame.unionByName, words))


def _numbers() -> Column:
    last = F.col("first_word") + F.size("active") - 1
    return F.sequence("first_word", last).alias("word")


def _shifted(words: Column, days: int) -> Column:
    """All bits later by ``days``; what would pass the end of the array is lost."""
    whole, rest = divmod(days, 64)
    zero = F.lit(0).cast("long")

    def moved(_: Column, i: Column) -> Column:
        low = F.shiftleft(F.coalesce(F.get(words, (i - whole).cast("int")), zero), rest)
        if not rest:
            return low
        return low.bitwiseOR(F.shiftrightunsigned(F.coalesce(F.get(words, (i - whole - 1).cast("int")), zero), 64 - rest))

    return F.transform(words, moved)


def _combined(a: Column, b: Column, how) -> Column:
    return F.zip_with(a, b, how)


def _alive(calendar: DataFrame, days: int) -> DataFrame:
    """With ``alive``: a bit for each day that has activity on it or on one of the ``days - 1`` before."""
    pad = F.array_repeat(F.lit(0).cast("long"), (days + 1) // 64 + 1)
    found, held = calendar.withColumn("alive", F.concat("active", pad)), 1
    while held < days:
        # each step doubles how far back a bit looks; a column of its own, so that no step is computed twice
        step = min(held, days - held)
        found = found.withColumn("_later", _shifted(F.col("alive"), step))
        found = found.withColumn("alive", _combined(F.col("alive"), F.col("_later"), lambda x, y: x.bitwiseOR(y))).drop("_later")
        held += step
    return found


def _changes(calendar: DataFrame, days: int) -> DataFrame:
    """Days on which a user becomes alive (``entered``) or no longer is, and whether it is the user's first."""
    alive = _alive(calendar, days).withColumn("before", _shifted(F.col("alive"), 1))
    turned = _combined(F.col("alive"), F.col("before"), lambda x, y: x.bitwiseXOR(y))
    word = alive.select("first_word", F.posexplode(F.arrays_zip("alive", turned.alias("turned"))).alias("i", "w")).where("w.turned <> 0")
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("w.turned"), b) == 1)
    bits = word.select("first_word", "i", "w.alive", F.explode(places).alias("b"))
    number = (F.col("first_word") + F.col("i")) * 64 + F.col("b")
    entered = F.getbit("alive", F.col("b")) == 1
    # the first word of an array holds the first day as its lowest bit
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("b")))
    lowest = F.col("alive").bitwiseAND(below) == 0
    return bits.select(_day(number).alias("day"), entered.alias("entered"), (entered & lowest & (F.col("i") == 0)).alias("is_first"))


def _span(calendar: DataFrame) -> DataFrame:
    """First and last date of all activity."""
    words = calendar.select(F.posexplode("active").alias("i", "w"), "first_word").where("w <> 0")
    # one row per word in which there is any activity
    words = words.groupBy((F.col("first_word") + F.col("i")).alias("word")).agg(F.bit_or("w").alias("w"))
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("w"), b) == 1)
    ends = words.select(F.col("word") * 64 + F.array_min(places), F.col("word") * 64 + F.array_max(places)).toDF("lo", "hi")
    return ends.agg(_day(F.min("lo")).alias("lo"), _day(F.max("hi")).alias("hi"))


def rolling_active_users(calendar: DataFrame, days: int = 28) -> DataFrame:
    """Users active on each date or the ``days - 1`` before, from the first to the last date of activity.

    A user counts twice for each spell of activity, whatever its length, not once for each day.
    """
    turn = F.when(F.col("entered"), 1).otherwise(-1)
    per_day = _changes(calendar, days).groupBy("day").agg(F.sum(turn).alias("change"))
    dates = _span(calendar).where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("day"))
    total = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dated = dates.join(per_day, "day", "left").fillna(0, ["change"])
    return dated.select(F.col("day").alias("activity_date"), F.sum("change").over(total).alias("active_users"))


def calendar_churn_rate(calendar: DataFrame, window_days: int = 30, grain: str = "day") -> DataFrame:
    """What ``churn_rate`` gives, from calendars.

    A user is alive on the ``window_days`` from an active day on, churns on the first day after such a spell, and is at risk on the
    days after each alive one, at first ``window_days`` after the first day.
    """
    x = window_days
    turns = _changes(calendar, x)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    at = F.when(F.col("is_first"), F.date_add("day", x)).otherwise(F.date_add("day", 1))
    rows = F.array(
        F.struct(at.alias("day"), F.when(F.col("entered"), one).otherwise(-one).alias("entered"), none.alias("churned")),
        F.struct(F.col("day"), none.alias("entered"), F.when(F.col("entered"), none).otherwise(one).alias("churned")),
    )
    # entered and left on one date are kept apart, as a later date of a period counts only those who entered
    changes = turns.select(F.inline(rows))
    per_day = changes.groupBy("day").agg(
        F.sum(F.greatest("entered", none)).alias("entered"), F.sum(F.least("entered", none)).alias("left"), F.sum("churned").alias("churned")
    )
    bounds = _span(calendar).where(F.col("lo") <= F.date_sub("hi", x))
    dates = bounds.select(F.explode(F.expr(f"sequence(date_add(lo, {x}), hi)")).alias("day"))
    total = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = dates.join(per_day, "day", "left").fillna(0, ["entered", "left", "churned"])
    daily = daily.withColumn("at_risk", F.sum(F.col("entered") + F.col("left")).over(total))
    opening = F.min(F.struct("day", "at_risk", "entered"))
    at_risk = opening["at_risk"] + F.sum("entered") - opening["entered"]
    return daily.groupBy(period_start(F.col("day"), grain).alias("period_start")).agg(
        F.sum("churned").alias("churned_users"), at_risk.alias("at_risk_users"), F.try_divide(F.sum("churned"), at_risk).alias("churn_rate")
    )


def calendar_retention(calendar: DataFrame, max_day: int | None = None) -> DataFrame:
    """What ``nday_retention`` gives for cohorts by the first session start, from calendars.

    A user's active bits are counted from the day of the first started bit.
    """

    def numbers(words: str) -> Column:
        places = F.transform(
            words,
            lambda w, i: F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w, b) == 1), lambda b: (F.col("first_word") + i) * 64 + b
            ),
        )
        return F.flatten(places)

    dated = calendar.select(F.array_min(numbers("started")).alias("c"), numbers("active").alias("days")).where("c is not null")
    sizes = dated.groupBy("c").agg(F.count("*").alias("cohort_size"))
    cells = dated.select("c", F.explode("days").alias("d")).select("c", (F.col("d") - F.col("c")).alias("day_index"))
    inside = F.col("day_index") >= 0 if max_day is None else F.col("day_index").between(0, max_day)
    cells = cells.where(inside).groupBy("c", "day_index").agg(F.count("*").alias("active_users"))
    return cells.join(sizes, "c").select(
        _day(F.col("c")).alias("cohort_date"), "day_index", "cohort_size", "active_users",
        F.try_divide("active_users", "cohort_size").alias("retention_rate"),
    )
