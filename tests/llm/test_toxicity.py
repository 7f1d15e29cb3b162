import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import toxicity
from usertide.llm._shared import crc_remainder


def brute_marginals(emissions, starts, moves, first):
    """Textbook forward and backward sums, one text after the other."""
    out, pairs = [], np.zeros((2, 2))
    edges = [*np.flatnonzero(starts).tolist(), len(emissions)]
    for i, j in zip(edges, edges[1:], strict=False):
        em = np.exp(np.stack([np.zeros(j - i), emissions[i:j]], 1))
        a, b = np.zeros((j - i, 2)), np.ones((j - i, 2))
        a[0] = np.exp(first) * em[0]
        for t in range(1, j - i):
            a[t] = a[t - 1] @ np.exp(moves) * em[t]
        for t in range(j - i - 2, -1, -1):
            b[t] = np.exp(moves) @ (em[t + 1] * b[t + 1])
        z = a[-1].sum()
        out += ((a * b)[:, 1] / z).tolist()
        for t in range(1, j - i):
            pairs += a[t - 1][:, None] * np.exp(moves) * (em[t] * b[t])[None] / z
    return np.array(out), pairs


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 400])
def test_marginals_equal_the_plain_recursion(n):
    rng = np.random.default_rng(n)
    starts = rng.random(n) < 0.15
    starts[0] = True
    given = rng.normal(0, 2, n), starts, rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    p, pairs = toxicity.marginals(*given, pairs=True)
    want, want_pairs = brute_marginals(*given)
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs)


def test_long_texts_do_not_overflow():
    n = 200_000
    starts = np.zeros(n, bool)
    starts[0] = True
    p, _ = toxicity.marginals(np.full(n, -40.0), starts, np.zeros((2, 2)), np.zeros(2))
    assert np.isfinite(p).all() and p.max() < 1e-6


def made(spark, n=300):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(400)]
    bad = ["swine", "rotter", "vilelich", "vilekeit", "vileung"]
    texts, toxic = [], []
    for i in range(n):
        text = [words[k] for k in rng.integers(0, 400, 40)]
        if i % 3 == 0:
            for at in rng.integers(0, 40, 3):
                text[at] = bad[int(rng.integers(0, 5))] + ["", ",", "!"][int(rng.integers(0, 3))]
        texts.append(" ".join(text).capitalize())
        toxic.append(int(i % 3 == 0))
    docs = frames.docs(spark, texts)
    return docs, spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], "doc_id long, quality int, toxic int")


def test_scores_and_spans(spark):
    docs, labels = made(spark)
    learn = crc_remainder("doc_id", 5) != 0
    model = toxicity.fit(frames.clashing(docs), frames.clashing(labels), learn=learn)
    out = toxicity.score(frames.clashing(docs), model).join(labels, F.col("id") == F.col("doc_id"))
    wrong = out.where((F.col("score") >= 0.5).cast("int") != F.col("toxic")).count()
    assert out.count() == 300 and wrong == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    said = [texts[r.id][s.first : s.end].lower() for r in out.collect() for s in r.spans]
    assert len(said) > 150
    hits = [any(w in s for w in ("swine", "rotter", "vile")) for s in said]
    assert sum(hits) / len(hits) > 0.95
    # a word of the same kind that no training text holds
    new = toxicity.score(frames.docs(spark, ["word1 vileheit word2 swine word3 rotter"]), model).first()
    assert any("vileheit" in "word1 vileheit word2 swine word3 rotter"[s.first : s.end] for s in new.spans)


def test_held_out_labels_have_no_influence(spark):
    docs, labels = made(spark, 120)
    learn = crc_remainder("doc_id", 5) != 0
    spoilt = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.fit(docs, x, learn=learn) for x in (labels, spoilt))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.document, b.document)


def test_odd_rows_and_labels(spark):
    docs, labels = made(spark, 90)
    more = spark.createDataFrame([(None, 1, 1), (3, 1, None), (6, 1, 0)], labels.schema)
    model = toxicity.fit(docs, labels.unionByName(more))
    odd = frames.clashing(frames.odd(spark))
    out = toxicity.score(odd, model)
    assert out.count() == odd.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(odd, none).first().score == pytest.approx(0.5)
    clean = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.score(odd, clean).where("score > 0.1").count() == 0


def test_sample_is_bounded_in_bytes(spark, tmp_path):
    docs, labels = made(spark, 120)
    known = docs.join(labels, "doc_id").select(F.col("text").alias("t"), F.col("toxic").alias("y"))
    sample = known.select("t", "y", F.xxhash64("t").alias("turn"), F.octet_length("t").alias("size"))
    for room in (0, 1000, 5000, 1 << 20):
        kept = sample.where(toxicity._room(sample, room)).groupBy("y").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
        assert all(r.s <= room for r in kept)
        assert room < 1000 or (len(kept) == 2 and all(r.s > room - 600 or r.n == (80, 40)[r.y] for r in kept))
    whole, enough = (toxicity.fit(docs, labels, max_bytes=b) for b in (64 << 20, 1 << 20))
    assert np.array_equal(whole.weights, enough.weights)
    # no room for any text: the share of label 1, for every text
    none = toxicity.fit(docs, labels, max_bytes=0)
    assert toxicity.score(docs, none).agg(F.min("score"), F.max("score")).first()[0] == pytest.approx(41 / 122)


def test_offsets_are_those_of_split():
    for text in [t or "" for t in frames.ODD_TEXTS]:
        assert [text[i:j] for i, j in toxicity.split_offsets(text)] == text.split()


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = crc_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, labels, learn=~out)
    scored = toxicity.score(docs.where(out), model).join(labels.where("toxic is not null"), F.col("id") == F.col("doc_id"))
    rows = [((r.score >= 0.5), r.toxic) for r in scored.collect()]
    assert sum(p == (y == 1) for p, y in rows) / len(rows) > 0.97
    assert sum(p for p, y in rows if y == 1) / sum(y for _, y in rows) > 0.85
