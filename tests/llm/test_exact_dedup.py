import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import exact_dedup


def brute(rows, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: keep((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    return sorted(
        ((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows),
        key=str,
    )


def found(df):
    cols = df.select("id", "keep_id", "group_size", F.lower(F.hex("digest")))
    return sorted((tuple(r) for r in cols.collect()), key=str)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("parts,fan_in", [(1, 2), (7, 2), (23, 3)])
def test_equals_brute_force_whatever_the_tree(spark, keep, parts, fan_in):
    texts = [["a", "b", "hot", None, "", "c" * (i % 5)][i * i % 6] for i in range(300)]
    df = frames.docs(spark, texts).repartition(parts)
    out = exact_dedup.exact_dedup(df, keep=keep, fan_in=fan_in)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(out) == brute(rows, max if keep == "max" else min)
    kept = out.where("kept").groupBy("digest").count().collect()
    assert {r["count"] for r in kept} == {1}


def test_rounds_merge_without_a_shuffle(spark, tmp_path):
    rows = frames.docs(spark, [f"text {i % 70}" for i in range(400)]).repartition(9)
    best = F.struct(F.lit(True), "id", "row")
    found = exact_dedup.digest_rows(rows, str(tmp_path / "work")).select("run", *exact_dedup.KEY, best.alias("best"), F.lit(1).alias("n"))
    leaf = exact_dedup.merge_runs(found, "max").repartition(4, *exact_dedup.KEY)
    first = exact_dedup.stored_runs(leaf, str(tmp_path / "first"), 4)
    merged = exact_dedup.merge_runs(first.withColumn("run", F.lit(0)), "max")
    decided = first.select("run", *exact_dedup.KEY).join(merged.hint("merge").drop("run"), exact_dedup.KEY)
    for df in (merged, decided):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    assert merged.count() == 70 and decided.count() == first.count() > 70
    # one file a bucket, sorted; the name of the table is gone, its rows are not
    assert len(list((tmp_path / "first").glob("*.parquet"))) <= 4
    for part in first.select("digest", F.input_file_name().alias("f")).toPandas().groupby("f")["digest"]:
        assert list(part[1]) == sorted(part[1])
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("runs_")]


def test_odd_rows(spark):
    df = frames.odd(spark).repartition(5)
    out = exact_dedup.exact_dedup(frames.clashing(df))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(out) == brute(rows)
    # one row stays for each text, also of rows that repeat id and text, and of NULL ids
    assert out.where("kept").count() == len({t or "" for _, t in rows})


def test_drop_copies_keeps_columns_and_one_row_per_text(spark):
    df = frames.clashing(frames.odd(spark))
    out = exact_dedup.drop_copies(df, keep="max")
    assert out.columns == df.columns
    texts = [r.text or "" for r in out.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in df.collect()})


def test_normalise_and_empty_table(spark):
    df = frames.docs(spark, ["A b", "a B", "c"])
    out = exact_dedup.exact_dedup(df, normalise=F.lower)
    assert sorted((r.id, r.keep_id) for r in out.collect()) == [(0, 1), (1, 1), (2, 2)]
    assert exact_dedup.exact_dedup(frames.docs(spark, [])).count() == 0
    assert exact_dedup.drop_copies(frames.docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(df, keep="any")
