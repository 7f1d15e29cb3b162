"""Quality measures in flight: counts and NULLs of a table taken while it is written, without reading it again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.operators.qa import _WATCHED
from usertide.schemas import DATE_COLUMN


def observed(rows: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The rows, to be written once, and an observation that has their measures afterwards.

    The measures have the names that ``qa_summary`` gives them: ``count_<table>`` and ``nulls_<table>_<column>``; and, for tables with a date,
    ``first_day_<table>`` and ``last_day_<table>``, in days since 1970. A task that is run again counts once, a whole stage that is run again
    may count twice.
    """
    measures = {f"count_{table}": F.count(F.lit(1))}
    measures |= {f"nulls_{table}_{c}": F.count_if(F.col(c).isNull()) for c in _WATCHED.get(table, [])}
    if table in DATE_COLUMN:
        day = F.unix_date(F.col(DATE_COLUMN[table])).cast("long")
        measures |= {f"first_day_{table}": F.min(day), f"last_day_{table}": F.max(day)}
    seen = Observation(uuid.uuid4().hex)
    return rows.observe(seen, *[value.alias(name) for name, value in measures.items()]), seen


def alarms(measures: DataFrame, fall: float = 0.5, more_nulls: float = 0.05) -> DataFrame:
    """Measures of full loads that are out of line with the full load before: ``version, table_name, metric, value, before, alarm``.

    ``rows fell`` by more than the share ``fall``; ``no rows`` where there were some; the share of ``nulls`` in a column rose by more than
    ``more_nulls``. One row per load and measure comes in, so the window over them is small.
    """
    full = measures.where("kind = 'full'")
    rows = full.where("metric like 'count~_%' escape '~'").select("version", "table_name", F.col("value").alias("rows"))
    in_turn = Window.partitionBy("metric").orderBy("version")
    told = full.join(rows, ["version", "table_name"]).withColumns(
        {"before": F.lag("value").over(in_turn), "rows_before": F.lag("rows").over(in_turn)}
    )
    share, share_before = F.try_divide("value", "rows"), F.try_divide("before", "rows_before")
    counted, nulls = F.col("metric").startswith("count_"), F.col("metric").startswith("nulls_")
    alarm = (
        F.when(counted & (F.col("value") == 0) & (F.col("before") > 0), "no rows")
        .when(counted & (F.col("value") < (1 - fall) * F.col("before")), "rows fell")
        .when(nulls & (share - F.coalesce(share_before, F.lit(0.0)) > more_nulls) & F.col("before").isNotNull(), "nulls")
    )
    found = told.withColumn("alarm", alarm).where("alarm is not null")
    return found.select("version", "table_name", "metric", "value", "before", "alarm")
