"""Shard ledger, and quality measures taken while tables are written."""

import time

import pytest
from helpers import enriched, raw, raw_frame, rows
from pyspark.sql import functions as F

import usertide as ut
from usertide.operators.qa import _table_metrics
from workload.queries import FAULTS


def shard(spark, src, day, *events):
    raw_frame(spark, *events).coalesce(1).write.mode("overwrite").parquet(f"{src}/events_{day}")


def of(day, *users):
    return [raw(u, f"2020-01-{day} 10:00:00") for u in users]


def test_only_new_and_changed_shards_are_read(spark, tmp_path, monkeypatch):
    src, ledger = str(tmp_path / "src"), ut.ShardLedger(spark, f"{tmp_path}/ledger")
    assert ledger.refresh(src) == {"new": [], "changed": [], "same": [], "gone": []} and ledger.versions() == []
    shard(spark, src, "20200102", *of("02", "a", "b"))
    shard(spark, src, "20200103", *of("03", "a"))
    shard(spark, src, "20200104")  # an empty one
    assert ledger.refresh(src)["new"] == ["events_20200102", "events_20200103", "events_20200104"]
    first = ledger.manifest()["shards"]
    assert rows(ledger.seen(), "shard", "rows", "version") == [("events_20200102", 2, 1), ("events_20200103", 1, 1), ("events_20200104", 0, 1)]
    time.sleep(0.01)
    shard(spark, src, "20200101", *of("01", "late"))  # a late shard of an old day
    shard(spark, src, "20200103", *of("03", "x"))  # other rows, of the same number and size
    found = ledger.refresh(src)
    assert found == {"new": ["events_20200101"], "changed": ["events_20200103"], "same": ["events_20200102", "events_20200104"], "gone": []}
    assert rows(ledger.events(), "user_id") == [("a",), ("b",), ("late",), ("x",)]
    # those that were not read lie where they lay
    second = ledger.manifest()["shards"]
    assert {s for s in second if second[s] == first.get(s)} == {"events_20200102", "events_20200104"}
    assert rows(ledger.seen(), "shard", "version")[0] == ("events_20200101", 2)
    assert ledger.refresh(src)["same"] == sorted(second) and ledger.versions() == [1, 2]  # nothing new, no version
    old = ut.ShardLedger(spark, f"{tmp_path}/ledger", version=1)
    assert rows(old.events(), "user_id") == [("a",), ("a",), ("b",)]
    with pytest.raises(ValueError, match="takes no shards"):
        old.refresh(src)

    def killed(*_):
        raise OSError("killed")

    shard(spark, src, "20200105", *of("05", "y"))
    with monkeypatch.context() as patch:
        patch.setattr(ut.ShardLedger, "publish_manifest", killed)
        with pytest.raises(OSError):
            ledger.refresh(src)
    assert ledger.manifest()["shards"] == second
    (tmp_path / "src" / "events_20200102").rename(tmp_path / "moved")
    assert ledger.refresh(src)["gone"] == ["events_20200102"] and ledger.events().count() == 5
    ledger.refresh(src, drop_gone=True)
    assert rows(ledger.events(), "user_id") == [("late",), ("x",), ("y",)]


def test_measures_in_flight_are_those_of_a_scan(spark, tmp_path):
    many = [raw(f"u{i}", f"2020-01-0{1 + i % 8} 10:00:00", "purchase", session=i % 3, txn=f"t{i}", revenue=None if i % 4 else 60.0) for i in range(40)]
    events = enriched(spark, *many)
    for name, table in ut.build_model(events, events).items():
        for fault in (lambda df: df, FAULTS.get(name, lambda df: df), lambda df: df.limit(0)):
            rows_, seen = ut.observed(fault(table), name)
            rows_.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
            scanned = _table_metrics(name, spark.read.parquet(f"{tmp_path}/{name}")).first().asDict()
            assert {m: v for m, v in seen.get.items() if "day_" not in m} == {m: v for m, v in scanned.items() if not m.startswith("dupes")}


def test_alarms(spark, tmp_path):
    store = ut.SnapshotStore(spark, f"{tmp_path}/dw")
    loads = [[raw(f"u{i}", "2020-01-01 10:00:00", "purchase", txn=f"t{i}", revenue=1.0) for i in range(n)] for n in (10, 9, 3)]
    loads.append([raw(f"u{i}", "2020-01-01 10:00:00", "purchase", txn=f"t{i}") for i in range(3)])
    loads.append([raw(f"u{i}", "2020-01-01 10:00:00") for i in range(3)])
    for i, events in enumerate(loads):
        ut.run_pipeline(spark, raw_frame(spark, *events), store, f"{tmp_path}/w{i}")
    found = {(r.version, r.metric): r.alarm for r in ut.alarms(store.measures()).collect()}
    assert found[3, "count_fact_sessions"] == "rows fell" and (2, "count_fact_sessions") not in found
    assert found[4, "nulls_fact_purchases_revenue"] == "nulls" and found[5, "count_fact_purchases"] == "no rows"
    days = rows(store.measures().where("version = 1 and metric = 'first_day_fact_sessions'"), "value")
    assert days == [((spark.sql("select unix_date(date'2020-01-01')").first()[0]),)]
    assert store.measures().where("version = 1").where(F.col("kind") == "full").count() > 20
