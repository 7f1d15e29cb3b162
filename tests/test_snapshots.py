"""Snapshots: loads that break off, readers of old versions, key filters, and merges of late events."""

import pytest
from helpers import enriched, raw, raw_frame, rows
from pyspark.sql import functions as F

import usertide as ut
from usertide.plans import snapshot_loads
from usertide.sources import key_filters, snapshots

EARLY = [
    raw("a", "2020-01-02 10:00:00", "session_start", session=1),
    raw("a", "2020-01-02 10:05:00", "purchase", session=1, txn="T1", revenue=5.0),
    raw("b", "2020-01-02 23:50:00", "view_item", session=7, country="SE"),
    raw("c", "2020-01-05 12:00:00", "purchase", session=3, revenue=None, txn=None),
    raw("d", "2020-01-09 12:00:00", session=4, campaign=None),
    raw(None, "2020-01-02 08:00:00", session=5),
]
LATE = [
    raw("a", "2020-01-01 23:59:00", "view_item", session=1, category="mobile"),  # before its session, on the day before
    raw("a", "2020-01-02 09:00:00", "purchase", session=2, txn="T1", revenue=9.0),  # an earlier copy of a purchase
    raw("b", "2020-01-03 00:10:00", "purchase", session=7, txn="T2", revenue=None, country="SE"),
    raw("c", "2020-01-05 12:00:01", "view_item", session=3),  # so that revenue is 0, not unknown
    raw("e", "2020-01-20 12:00:00", "session_start", session=9, platform="APP", country="DK"),
    raw("d", None, "scroll", session=4, campaign=""),
    raw("e-", "2020-01-20 12:00:00", session=9),
    raw("e", "2020-01-20 11:00:00", session=-9),
]


def contents(model):
    return {name: rows(table.select(*sorted(table.columns))) for name, table in model.items()}


def whole(spark, *events, **grains):
    ev = enriched(spark, *events)
    model = ut.build_model(ev, ev, **grains)
    return contents({name: ut.conform(table, ut.schemas.TABLES[name]) for name, table in model.items()})


def load(spark, store, events, work, mode="full", **more):
    return ut.run_pipeline(spark, raw_frame(spark, *events), store, str(work), mode, **more)


@pytest.fixture
def store(spark, tmp_path):
    return ut.SnapshotStore(spark, f"{tmp_path}/dw", buckets=4)


def test_versions_and_readers_of_old_ones(spark, store, tmp_path):
    with pytest.raises(ValueError, match="never loaded"):
        store.read("dim_user")
    assert not store.holds_rows() and store.versions() == []
    first = load(spark, store, EARLY, tmp_path / "w1")  # frames of version 1
    assert contents(first) == whole(spark, *EARLY)
    second = load(spark, store, EARLY + LATE, tmp_path / "w2")
    assert contents(second) == whole(spark, *EARLY, *LATE)
    assert contents(first) == contents(store.at(1).model()) == whole(spark, *EARLY)
    assert store.versions() == [1, 2] and store.manifest()["kind"] == "full"
    with pytest.raises(ValueError, match="no version 3"):
        store.at(3).read("dim_user")
    with pytest.raises(ValueError, match="takes no loads"):
        store.at(1).change("full")
    # the first version goes, its folders with it; the second is whole
    assert len(store.expire(keep=1)) == 1 and store.versions() == [2]
    assert contents(store.model()) == whole(spark, *EARLY, *LATE)


STEPS = ["dim_date", "dim_geo", "dim_user", "fact_sessions", "fact_user_daily_activity", "fact_purchases", "event_slices"]


def test_a_load_that_breaks_off_changes_nothing(spark, store, tmp_path, monkeypatch):
    load(spark, store, EARLY[:3], tmp_path / "w1")
    old, manifest = store.model(), store.manifest()
    before = contents(old)

    class Killed(Exception):
        pass

    def killed(*_, **__):
        raise Killed

    def killed_at(step):
        put = snapshots.Change.put

        def put_until(self, table, *args, **kwargs):
            put(self, table, *args, **kwargs)
            if table == step:
                raise Killed

        return put_until

    places = [(snapshots.Change, "put", killed_at(step)) for step in STEPS]
    # before the filters, before the manifest is written, and between its writing and its renaming
    places += [(snapshots.Change, "_put_filter", killed), (snapshots.Change, "commit", killed), (snapshots.json, "dumps", killed)]
    for i, (owner, name, broken) in enumerate(places):
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, broken)
            with pytest.raises(Killed):
                load(spark, store, LATE, tmp_path / f"w2-{i}", "merge" if i % 2 else "full")
        assert store.versions() == [1] and store.manifest() == manifest
    beside = tmp_path / "dw" / "manifests" / ".left"
    beside.write_text("a manifest that was not put in place")
    assert store.versions() == [1] and contents(store.model()) == contents(old) == before
    load(spark, store, LATE, tmp_path / "w3", "merge")  # simply run again
    assert contents(store.model()) == whole(spark, *EARLY[:3], *LATE)
    assert contents(old) == before


def test_of_two_loads_at_once_one_is_refused(spark, store, tmp_path):
    load(spark, store, EARLY, tmp_path / "w")
    one, two = store.change("full"), store.change("full")
    one.put("dim_geo", store.read("dim_geo").limit(1))
    two.put("dim_geo", store.read("dim_geo").limit(0))
    assert one.commit() == 2
    with pytest.raises(ut.ConcurrentLoad):
        two.commit()
    assert store.read("dim_geo").count() == 1 and store.versions() == [1, 2]


@pytest.mark.parametrize(
    "cut,grains", [(0, {}), (1, {"dim_grain": "reference", "funnel_grain": "session_step"}), (2, {})]
)
def test_merged_loads_equal_one_full_load(spark, store, tmp_path, grains, cut):
    events = EARLY + LATE
    loads = [(EARLY, LATE), (LATE, EARLY), (events[::3], events[1::3], events[2::3])][cut]
    for i, part in enumerate(loads):
        model = load(spark, store, part, tmp_path / f"w{i}", "merge" if i else "full", **grains)
    assert contents(model) == whole(spark, *events, **grains)
    # so do the days alone that a reader asks for
    days = rows(store.read("fact_sessions", days=("2020-01-01", "2020-01-04")), "session_key")
    assert days == rows(model["fact_sessions"].where("session_date <= '2020-01-04'"), "session_key")


def test_a_merge_into_nothing_is_a_full_load(spark, store, tmp_path):
    assert contents(load(spark, store, EARLY, tmp_path / "w", "merge")) == whole(spark, *EARLY)
    assert contents(load(spark, store, EARLY[:0], tmp_path / "w2", "merge")) == whole(spark, *EARLY)


def test_a_merge_writes_anew_only_the_parts_it_changes(spark, store, tmp_path):
    many = [raw(f"u{i}", f"2020-02-{1 + i % 20:02d} 10:00:00", "purchase", session=i, txn=f"X{i}") for i in range(80)]
    load(spark, store, many, tmp_path / "w1")
    before = store.manifest()["tables"]
    late = [raw("u3", "2020-02-04 11:00:00", session=3), raw("new", "2020-02-07 10:00:00", session=1)]
    load(spark, store, late, tmp_path / "w2", "merge")
    after = store.manifest()["tables"]
    for table in ("fact_sessions", "fact_user_daily_activity"):
        assert {p for p in before[table] if before[table][p] != after[table][p]} == {"2020-02-04", "2020-02-07"}
        assert set(before[table]["2020-02-04"]).isdisjoint(after[table]["2020-02-04"])  # a row changed: copied
        assert after[table]["2020-02-07"][0] == before[table]["2020-02-07"][0]  # a row was added beside
    assert after["fact_purchases"] == before["fact_purchases"]  # nothing new
    assert len([p for p in before["dim_user"] if before["dim_user"][p] != after["dim_user"].get(p)]) <= 2
    assert before["dim_device"] == after["dim_device"] and before["dim_date"] == after["dim_date"]
    assert contents(store.model()) == whole(spark, *many, *late)


def test_an_incremental_load_equals_that_of_a_plain_store(spark, store, tmp_path):
    plain = ut.TableStore(spark, root=f"{tmp_path}/plain")
    for i, (events, mode) in enumerate([(EARLY, "full"), (EARLY + LATE, "incremental"), (EARLY + LATE, "incremental")]):
        got = load(spark, store, events, tmp_path / f"a{i}", mode)
        assert contents(got) == contents(load(spark, plain, events, tmp_path / f"b{i}", mode))
    with pytest.raises(ValueError, match="no rollup"):
        load(spark, store, LATE, tmp_path / "c", "merge")


def test_an_increment_reads_the_parts_that_may_hold_its_keys(spark, store, tmp_path, monkeypatch):
    many = [raw(f"u{i}", f"2020-02-{1 + i % 25:02d} 10:00:00", "purchase", session=i, txn=f"X{i}") for i in range(200)]
    load(spark, store, many, tmp_path / "w1")
    asked = []
    read = snapshots.SnapshotStore.read

    def spy(self, table, *args, **kwargs):
        found = read(self, table, *args, **kwargs)
        if kwargs.get("parts") is not None:
            asked.append((table, len(kwargs["parts"]), found.count()))
        return found

    monkeypatch.setattr(snapshots.SnapshotStore, "read", spy)
    fresh = [raw(f"new{i}", "2020-03-01 10:00:00", "purchase", session=i, txn=f"N{i}") for i in range(5)]
    load(spark, store, fresh + [many[3]], tmp_path / "w2", "incremental")
    read_rows = {table: n for table, _, n in asked}
    # one date of 25 holds the known session and purchase; a few more may be named wrongly
    assert 8 <= read_rows["fact_sessions"] <= 40 and 8 <= read_rows["fact_purchases"] <= 40
    monkeypatch.undo()
    assert store.read("fact_sessions").count() == 205


def test_filters_miss_nothing_and_seldom_name_too_much(spark):
    held = spark.range(20_000).selectExpr("concat('k', id) as k", "cast(id % 4 as string) as p")
    held = held.unionByName(spark.sql("select cast(null as string) as k, '0' as p"))
    sizes = key_filters.filter_widths(held, F.col("p"))
    words = key_filters.build_filter(held, F.col("p"), ["k"], sizes)
    assert words.count() <= sum(r.width for r in sizes.collect()) <= 4 * 5000 / 2
    widths = sorted({r.width for r in sizes.collect()})
    there = key_filters.may_hold(held.select("k"), ["k"], words, widths)
    assert held.where("k is not null").join(there.withColumnRenamed("part", "p"), ["k", "p"], "left_anti").count() == 0
    absent = spark.range(20_000, 40_000).selectExpr("concat('k', id) as k")
    assert key_filters.may_hold(absent, ["k"], words, widths).count() < 0.03 * 4 * 20_000


def test_marts_are_part_of_a_version(spark, store, tmp_path):
    model = load(spark, store, EARLY, tmp_path / "w")
    marts = ut.build_marts(model)
    store.publish(marts)
    assert store.versions() == [1, 2]
    for name, mart in marts.items():
        assert rows(store.read_mart(name)) == rows(mart)
    assert contents(store.model()) == whole(spark, *EARLY)


def test_merges_are_refused_where_they_could_not_be_right(spark, store, tmp_path):
    for out, more in ((f"{tmp_path}/plain", {}), (store, {"dedup": True}), (store, {"session_gap": "30 minutes"})):
        with pytest.raises(ValueError, match="merge"):
            load(spark, out, EARLY, tmp_path / "w", "merge", **more)
    with pytest.raises(ValueError, match="mode must be"):
        snapshot_loads.load_snapshot(store, {}, None, "", "other")


def test_no_keys_are_broadcast(spark, store, tmp_path, monkeypatch):
    """Frames that loads of a store write hold no broadcast of keys; dimensions, of one part, may be."""
    load(spark, store, EARLY, tmp_path / "w1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    plans, put, kept = {}, snapshots.Change.put, snapshot_loads.store_events

    def planned(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def seen_put(self, table, rows, *args, **kwargs):
        plans[table] = planned(rows)
        return put(self, table, rows, *args, **kwargs)

    def seen_kept(rows, path):
        plans[path.rsplit("/", 1)[1]] = planned(rows)
        return kept(rows, path)

    monkeypatch.setattr(snapshots.Change, "put", seen_put)
    monkeypatch.setattr(snapshot_loads, "store_events", seen_kept)
    try:
        load(spark, store, LATE, tmp_path / "w2", "merge")
        merged = contents(store.model())
        load(spark, store, EARLY + LATE, tmp_path / "w3", "incremental")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert merged == whole(spark, *EARLY, *LATE)
    joined = {name for name, plan in plans.items() if "Join" in plan and not name.startswith(("dim_date", "dim_device", "dim_geo", "dim_traffic"))}
    assert {"fact_sessions_hits", "fact_sessions_same", "fact_user_daily_activity_delta", "fact_funnel_steps", "dim_user"} <= joined
    assert [name for name in sorted(joined) if "Broadcast" in plans[name]] == []


def test_a_filter_by_collected_widths_is_the_same(spark):
    held = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.when(F.col("id") % 9 != 0, (F.col("id") % 7 % 3).cast("string")).alias("p"))
    held = held.withColumn("p", F.coalesce("p", F.lit("none"))).unionByName(spark.sql("select cast(null as string) k, '1' p"))
    sizes = key_filters.filter_widths(held, F.col("p"))
    by_table = key_filters.build_filter(held, F.col("p"), ["k"], sizes)
    collected = key_filters.build_filter(held, F.col("p"), ["k"], {r["part"]: r["width"] for r in sizes.collect()})
    assert rows(by_table) == rows(collected)
    assert "Join" not in collected._jdf.queryExecution().executedPlan().toString()


def test_a_merge_of_new_dates_recomputes_no_days_and_shuffles_no_keys_for_the_filters(spark, store, tmp_path, monkeypatch):
    load(spark, store, EARLY, tmp_path / "w1")
    plans, kept = {}, snapshot_loads.store_events

    def seen_kept(rows, path):
        plans[path.rsplit("/", 1)[1]] = rows._jdf.queryExecution().executedPlan().toString()
        return kept(rows, path)

    monkeypatch.setattr(snapshot_loads, "store_events", seen_kept)
    fresh = [
        raw("a", "2020-02-01 10:00:00", "purchase", session=1, txn="T1", revenue=1.0),  # of a known session, and a known purchase
        raw("b", "2020-02-01 10:05:00", "view_item", session=8),
        raw("a", None, "scroll", session=2),
        raw(None, "2020-02-02 08:00:00", session=5),
    ]
    load(spark, store, fresh, tmp_path / "w2", "merge")
    assert contents(store.model()) == whole(spark, *EARLY, *fresh)
    assert "Join" not in plans["fact_user_daily_activity_delta"]
    for table, key in (("fact_sessions", "session_key"), ("fact_purchases", "purchase_key"), ("dim_user", "user_id")):
        assert f"hashpartitioning({key}" not in plans[f"{table}_hits"] and "hashpartitioning(part" in plans[f"{table}_hits"]
