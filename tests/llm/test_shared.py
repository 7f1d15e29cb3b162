"""Dropping rows by decisions, whatever the size of these and the names of columns."""

import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import _shared, decontaminate, exact_dedup, quality, simhash
from usertide.llm._shared import rows_that_stay


@pytest.mark.parametrize("max_bytes,bits", [(1 << 20, 1 << 10), (0, 1 << 10), (0, 8), (0, 1 << 20)])
def test_the_same_rows_stay_by_broadcast_and_by_filter(spark, tmp_path, max_bytes, bits):
    rows = [(i % 400 if i % 7 else None, f"t{i % 90}", "x") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_key_of` string")
    key = F.xxhash64("text")
    found = docs.select(F.col("doc_id").alias("id"), key.alias("key"), F.coalesce(F.pmod("doc_id", F.lit(3)) != 0, F.length("text") == 2).alias("kept"))
    out = rows_that_stay(docs, found, "doc_id", key, str(tmp_path), max_bytes, bits)
    assert out.columns == docs.columns
    want = {(i, t) for i, t, _ in rows if (len(t) == 2 if i is None else i % 3)}
    got = [tuple(r)[:2] for r in out.collect()]
    assert set(got) == want and len(got) == len(want)


def test_nothing_is_joined_where_nothing_goes(spark, tmp_path):
    docs = frames.docs(spark, ["a", "b", "c"])
    found = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.lit(True).alias("kept"))
    assert rows_that_stay(docs, found, "doc_id", F.xxhash64("text"), str(tmp_path)) is docs


def test_texts_of_rows_that_stay_are_not_shuffled(spark, tmp_path):
    frames.docs(spark, [f"text {i // 2}" for i in range(100)]).write.parquet(f"{tmp_path}/docs")
    out = exact_dedup.drop_copies(spark.read.parquet(f"{tmp_path}/docs"))
    assert out.count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_bits_of_a_filter(spark):
    hashes = spark.createDataFrame([(5,), (5 + 64,), (-1,), (40,)], "h long")
    held = _shared.bit_filter(hashes, 64)
    assert [i for i in range(64) if held[i >> 3] >> (7 - (i & 7)) & 1] == [5, 40, 63]


def test_no_column_is_lost(spark):
    df = frames.clashing(frames.odd(spark)).withColumns({n: F.lit("own") for n in ("_key", "_id_of", "_says", "_hash", "__hash", "__spans")})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(13)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "one"), (2, "another text of the same id")], "item_id long, text string")
    drops = {
        "exact": exact_dedup.drop_copies(df),
        "near": simhash.drop_near_copies(df),
        "documents": decontaminate.decontaminate(df, items),
        "spans": decontaminate.decontaminate(df, items, remove="spans"),
        "quality": quality.keep_good(df, labels, threshold=0.0),
    }
    for name, out in drops.items():
        assert out.columns == df.columns, name
        assert out.select("__key", "__stats").distinct().collect() == [("clash", "clash")], name
    assert drops["quality"].count() == drops["spans"].count() == df.count()


def test_the_quality_model_is_the_same_under_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    models = [quality.fit(docs.repartition(n), labels.repartition(n + 1)) for n in (1, 2, 16)]
    assert models[0] == models[1] == models[2] and models[0].weights
