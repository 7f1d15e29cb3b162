"""Reading and writing event data."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.schemas import RAW_EVENTS
from usertide.session import prepare


def read_events(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    fmt: str = "parquet",
    shard: str = "events_{day}",
) -> DataFrame:
    """Read day shards ``path/events_YYYYMMDD`` with the fixed raw schema; ``shard`` names the folders otherwise.

    ``start`` and ``end`` (ISO dates, inclusive, both or neither) narrow the scan to
    the shards of those days before any file is listed.
    """
    prepare(spark)
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    shards = "*"
    if start is not None:
        first, last = date.fromisoformat(start), date.fromisoformat(end)
        days = [(first + timedelta(n)).strftime("%Y%m%d") for n in range((last - first).days + 1)]
        shards = "{" + ",".join(days) + "}"
    return spark.read.schema(RAW_EVENTS).format(fmt).load(f"{path.rstrip('/')}/{shard.format(day=shards)}")


def write_events(events: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False) -> None:
    """Persist staged or enriched events, one folder per event date.

    Events read from day shards are in date order already: each task writes to a folder
    or two, without a shuffle. Events that come out of a shuffle hold every date in every
    task; ``rebalance`` gathers them by date first, splitting crowded dates over tasks.
    """
    if rebalance:
        events = events.hint("rebalance", F.col("event_date_utc"))
    events.write.mode(mode).partitionBy("event_date_utc").parquet(path)


def read_back(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Stored events in the shape they were written, cut off from what made them."""
    return spark.read.schema(events.schema).parquet(path).select(*events.columns)


def store_events(events: DataFrame, path: str) -> DataFrame:
    """Write events as they lie, for use within one load, and return them as read back."""
    events.write.mode("overwrite").parquet(path)
    return read_back(events.sparkSession, events, path)


@contextmanager
def stored_by(rows: DataFrame, path: str, column: str) -> Iterator[DataFrame]:
    """Rows that lie in partitions by ``column``, written as they lie, and read back as partitions of that column.

    What groups by the column as well then needs no shuffle. Spark knows such files by a table of its catalog only: it has a name of
    its own, is external, and goes afterwards; the files stay.
    """
    spark, name = rows.sparkSession, f"usertide_{uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(home_partitions(spark), column)
    try:
        writer.option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"drop table if exists {name}")


def home_partitions(spark: SparkSession) -> int:
    """How many partitions gathered rows get: as many as any shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
