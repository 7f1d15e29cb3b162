"""Loads from a stream: every batch is merged into a snapshot store exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usertide.functions.columns import param_int
from usertide.plans.pipeline import run_pipeline
from usertide.sources.snapshots import SnapshotStore

_IDENTITY = ["user_pseudo_id", "_at", "event_name", "_session", "_transaction"]


def without_copies(raw: DataFrame, within: str) -> DataFrame:
    """A stream of raw events without those whose user, time, name, session and transaction came already, up to ``within`` before.

    Events that lack a user, a time or a name cannot be told to be copies and all stay. The state holds identities for as long as ``within`` only.
    """
    columns = raw.columns
    known = F.col("user_pseudo_id").isNotNull() & F.col("event_timestamp").isNotNull() & F.col("event_name").isNotNull()
    named = raw.where(known).withColumns(
        {
            "_at": F.timestamp_micros("event_timestamp"),
            "_session": param_int("ga_session_id"),
            "_transaction": F.col("ecommerce.transaction_id"),
        }
    )
    unique = named.withWatermark("_at", within).dropDuplicatesWithinWatermark(_IDENTITY).select(*columns)
    return unique.unionByName(raw.where(~known))


def stream_load(
    raw: DataFrame, store: SnapshotStore, work: str, checkpoint: str, name: str = "events", within: str | None = None, **options
) -> StreamingQuery:
    """Merge a stream of raw events into a store, batch by batch, for all input that there is.

    The manifest that puts a batch's rows in place also says that the stream ``name`` has come that far. A batch that the stream repeats
    after a failure, because it did not learn that it was loaded, is recognised by it and adds nothing; one that was not put in place
    is loaded again as a whole. ``within`` also drops repeated events (``without_copies``). ``options`` are those of ``run_pipeline``.
    """

    def load(batch: DataFrame, number: int) -> None:
        # the batch belongs to a session of its own
        here = SnapshotStore(batch.sparkSession, store.root)
        if number <= here.manifest().get("streams", {}).get(name, -1):
            return
        place = f"{work.rstrip('/')}/batch-{number}"
        # read several times: kept as it is, so that the stream's state is not asked again
        batch.write.mode("overwrite").parquet(f"{place}/raw")
        kept = batch.sparkSession.read.schema(batch.schema).parquet(f"{place}/raw")
        run_pipeline(batch.sparkSession, kept, here, place, "merge", progress=(name, number), **options)

    events = without_copies(raw, within) if within else raw
    return events.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
