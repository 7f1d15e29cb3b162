"""Gap sessions of a stream, with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_gap_sessions(staged: DataFrame, gap: str = "30 minutes", delay: str = "1 day", native_col: str = "ga_session_id") -> DataFrame:
    """Sessions of a stream of staged events, each once, when no event can belong to it any more.

    ``user_id, session_id`` (its first event's time in microseconds), ``session_start_ts, session_end_ts, event_count`` and ``derived_count``, the
    events that have no id of their own and so belong to it by time. A session ends when its user is idle for more than ``gap``, as in
    ``sessionize``, whatever the order of arrival. One is given out once the latest event seen is ``delay`` past its end and the gap; events that
    are older than that, by the batch before the one they come in, are dropped and counted (``late_rows``). Events without a user or a time have no session.
    The state holds a row per user and open session, not the events.
    """
    timed = staged.where("user_id is not null and event_ts_utc is not null").withWatermark("event_ts_utc", delay)
    sessions = timed.groupBy("user_id", F.session_window("event_ts_utc", gap).alias("w")).agg(
        F.min("event_ts_utc").alias("session_start_ts"),
        F.max("event_ts_utc").alias("session_end_ts"),
        F.count("*").alias("event_count"),
        F.count_if(F.col(native_col).isNull()).alias("derived_count"),
    )
    return sessions.select(
        "user_id", F.unix_micros("session_start_ts").alias("session_id"), "session_start_ts", "session_end_ts", "event_count", "derived_count"
    )


def write_sessions(sessions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed sessions to ``path``, exactly once, for all input that there is."""
    writer = sessions.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start(path)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their watermark, over the progress reports that the query still has."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
