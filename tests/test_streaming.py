"""Streams: gap sessions with a watermark, and loads that are applied exactly once."""

import pytest
from helpers import raw, raw_frame, rows
from pyspark.sql import functions as F

import usertide as ut
from usertide.schemas import RAW_EVENTS
from usertide.streaming import loads
from workload import queries


def arrive(spark, path, *batches):
    for events in batches:
        raw_frame(spark, *events).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", 1).parquet(str(path))


def at(user, minute, **more):
    day, minute = divmod(minute, 1440)
    return raw(user, f"2020-01-{1 + day:02d} {minute // 60:02d}:{minute % 60:02d}:00", **more)


FAR = at("z", 20 * 1440)


def test_gap_sessions_are_those_of_a_batch_and_late_events_are_counted(spark, tmp_path):
    batches = [
        [at("a", 0), at("a", 30, session=None), at("b", 100), at(None, 5)],
        [at("a", 95), at("b", 70), at("a", 60), at("c", 3 * 1440)],  # out of order, but in time; the gap of half an hour itself does not part
        [at("d", 2 * 1440 + 600, session=None)],
        [at("b", 200)],  # two days and a batch late
        [FAR],
    ]
    stream = ut.stage_events(arrive(spark, tmp_path / "in", *batches))
    query = ut.write_sessions(ut.stream_gap_sessions(stream, "30 minutes", "1 day"), f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    assert ut.late_rows(query) == 1
    got = spark.read.parquet(f"{tmp_path}/out")
    kept = ut.stage_events(raw_frame(spark, *[e for b in batches for e in b if e["user_pseudo_id"] not in (None, "z")])).where(
        "not (user_id = 'b' and event_ts_utc = timestamp'2020-01-01 03:20:00')"
    )
    want = ut.sessionize(kept, "30 minutes").groupBy("user_id", "session_id").agg(
        F.min("event_ts_utc").alias("a"), F.max("event_ts_utc").alias("b"), F.count("*").alias("n"), F.count_if(F.col("ga_session_id").isNull()).alias("d")
    )
    assert rows(got) == rows(want) and got.count() == 5
    # nothing is given out twice by a stream that goes on
    ut.write_sessions(ut.stream_gap_sessions(stream, "30 minutes", "1 day"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


BATCHES = [
    [at("a", 0, name="session_start"), at("a", 10, name="purchase", txn="T1", revenue=3.0), at("b", 50)],
    [at("a", 5, name="view_item"), at("a", 10, name="purchase", txn="T1", revenue=3.0), at(None, 7), at(None, 7)],  # a copy of a purchase
    [at("c", 1500), at("b", 40, name="add_to_cart"), at("b", 40, name="add_to_cart")],
]


def whole(spark, batches, dedup):
    staged = ut.stage_events(raw_frame(spark, *[e for b in batches for e in b]))
    ev = ut.enrich_events(ut.dedup_events(staged) if dedup else staged)
    model = ut.build_model(ev, ev)
    return {n: rows(ut.conform(t, ut.schemas.TABLES[n])) for n, t in model.items()}


def contents(spark, root):
    return {n: rows(t) for n, t in ut.SnapshotStore(spark, root).model().items()}


@pytest.mark.parametrize("broken", ["before the commit", "after the commit"])
def test_a_batch_that_is_repeated_after_a_failure_adds_nothing(spark, tmp_path, monkeypatch, broken):
    root, place = f"{tmp_path}/dw", [f"{tmp_path}/work", f"{tmp_path}/cp"]
    stream = arrive(spark, tmp_path / "in", *BATCHES)
    real, calls = loads.run_pipeline, []

    def failing(*args, **kwargs):
        calls.append(kwargs["progress"])
        if broken == "after the commit":
            real(*args, **kwargs)
        if len(calls) == 2 or broken == "before the commit" and len(calls) == 1:
            raise RuntimeError("killed")
        if broken == "before the commit":
            real(*args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(loads, "run_pipeline", failing)
        with pytest.raises(Exception, match="killed"):
            ut.stream_load(stream, ut.SnapshotStore(spark, root), *place).awaitTermination()
    done = ut.SnapshotStore(spark, root).manifest().get("streams", {})
    assert done == ({} if broken == "before the commit" else {"events": 1})
    ut.stream_load(stream, ut.SnapshotStore(spark, root), *place).awaitTermination()
    assert contents(spark, root) == whole(spark, BATCHES, dedup=False)
    assert ut.SnapshotStore(spark, root).manifest()["streams"] == {"events": 2}
    assert len(ut.SnapshotStore(spark, root).versions()) == 3


def test_copies_within_the_watermark_are_dropped(spark, tmp_path):
    stream = arrive(spark, tmp_path / "in", *BATCHES)
    ut.stream_load(stream, ut.SnapshotStore(spark, f"{tmp_path}/dw"), f"{tmp_path}/w", f"{tmp_path}/cp", within="3 days").awaitTermination()
    assert contents(spark, f"{tmp_path}/dw") == whole(spark, BATCHES, dedup=True)


def test_a_turn_of_many_rows_comes_in_one_batch_of_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    # the rows of turn 1 lie in one partition of four, so the other tasks of that turn write nothing
    rows_of = spark.range(0, 80, 1, 4).withColumn("late", F.col("id") >= 75)
    stream = queries._in_turn(spark, rows_of, F.col("late").cast("int"), str(tmp_path))
    batches = []
    query = stream.writeStream.foreachBatch(lambda df, _: batches.append((df.count(), df.where("late").count(), df.select(F.input_file_name()).distinct().count()))).trigger(availableNow=True)
    query.option("checkpointLocation", f"{tmp_path}/cp").start().awaitTermination()
    assert [b[:2] for b in batches] == [(75, 0), (5, 5)]
    assert batches[0][2] > 1
