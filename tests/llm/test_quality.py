import math

import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import quality
from usertide.llm._shared import crc_remainder

TREES = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     If (feature 0 <= 0.9)
      Predict: 1.0
     Else (feature 0 > 0.9)
      Predict: 0.0
  Tree 1 (weight 1.0):
    If (feature 0 <= 0.5)
     Predict: 0.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""


def test_paths_become_rules():
    rules = quality.tree_rules(TREES, ["a", "b"])
    assert rules == [
        (("a", True, 0.5),),
        (("a", True, 0.5), ("b", True, 2.0)),
        (("a", True, 0.5), ("b", False, 2.0)),
        (("a", False, 0.5),),
        (("a", False, 0.5), ("a", True, 0.9)),
        (("a", False, 0.9),),
    ]


def test_statistics(spark):
    got = quality.with_statistics(frames.docs(spark, ["Ab c\nAb c\n1!! |", "", None])).orderBy("doc_id").collect()
    s = got[0]["__stats"].asDict()
    assert s["n_words"] == 6 and s["distinct_words"] == pytest.approx(4 / 6) and s["distinct_lines"] == pytest.approx(2 / 3)
    assert s["bangs"] == pytest.approx(2 / 6) and s["bars"] == pytest.approx(1 / 6) and s["upper"] == pytest.approx(2 / 15)
    assert got[1]["__stats"] == got[2]["__stats"] and got[1]["__stats"].distinct_lines == 1 and got[1]["__stats"].n_words == 0


def test_compiled_score_equals_the_rules_by_hand(spark):
    model = quality.RuleEnsemble(0.5, (((("n_words", False, 2.0), ("bangs", True, 0.1)), 2.0), ((("bangs", False, 0.1),), -3.0)))
    df = frames.clashing(frames.docs(spark, ["a b c", "a b! c", "a", None]))
    out = quality.score(df, model)
    assert out.columns == df.columns  # the clashing score column is replaced
    want = [0.5 + 2, 0.5 - 3, 0.5, 0.5]
    assert [r.score for r in out.orderBy("doc_id").collect()] == pytest.approx([1 / (1 + math.exp(-w)) for w in want])
    assert "bangs" in model.describe()


def made(spark, n=400):
    good = [f"Line {i} tells of word{i} and thing{i % 7}, plainly. Another sentence follows here." for i in range(n)]
    bad = [f"BUY{i}!! NOW!! CHEAP{i}!! " * 5 for i in range(n)]
    docs = frames.docs(spark, [*good, *bad])
    labels = docs.select("doc_id", (F.col("doc_id") < n).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    return docs, labels


def test_learns_only_from_rows_that_are_not_held_out(spark):
    docs, labels = made(spark)
    learn = crc_remainder("doc_id", 4) != 2
    model = quality.fit(docs, labels, learn=learn)
    scored = quality.score(docs, model).join(labels, "doc_id").where(~learn)
    wrong = scored.where((F.col("score") >= 0.7).cast("int") != F.col("quality")).count()
    assert scored.count() > 100 and wrong == 0
    # labels of held-out rows have no influence
    spoilt = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    assert quality.fit(docs, spoilt, learn=learn) == model


def test_odd_labels_and_rows(spark):
    docs, labels = made(spark, 60)
    more = spark.createDataFrame([(None, 1, 0), (3, None, 0), (5, 0, 0), (10**9, 1, 1)], labels.schema)
    model = quality.fit(frames.clashing(docs), frames.clashing(labels.unionByName(more)))
    odd = frames.clashing(frames.odd(spark))
    out = quality.score(odd, model)
    assert out.count() == odd.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    kept = quality.keep_good(frames.clashing(docs), labels)
    assert kept.columns == frames.clashing(docs).columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(60))


def test_without_both_labels_the_score_is_their_share(spark):
    docs, labels = made(spark, 20)
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    ones = quality.fit(docs, labels.where("quality = 1"))
    assert quality.score(docs, ones).first().score == pytest.approx(21 / 22)
    assert quality.score(docs.limit(0), ones).count() == 0
    assert quality.fit(docs.limit(0), labels).weights == ()


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = crc_remainder("doc_id", 4) == 2
    model = quality.fit(docs, labels, learn=~out)
    scored = quality.score(docs, model).join(labels.where("quality is not null"), "doc_id").where(out)
    right = scored.where((F.col("score") >= 0.7).cast("int") == F.col("quality")).count()
    assert right / scored.count() > 0.95
