import re

import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import frames
from tests.llm.test_decontaminate import brute as brute_overlaps
from tests.llm.test_simhash import brute_components, brute_print
from usertide.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(folder / str(k)))
        given, docs = docs, spark.read.parquet(str(folder / str(k)))
        out.append((given, docs))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [after.columns for _, after in stages[:-1]] == [columns] * 4
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_the_good(stages, spark):
    before, after = (texts(df) for df in stages[0])
    scored = {r.doc_id: r.predicted for r in queries.op4_quality_rules(spark, SF).collect()}
    assert set(after) == {i for i in before if scored[i] == 1}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels.get(i) == 1 for i in after) >= 0.98 * sum(labels.get(i) == 1 for i in before)
    assert sum(labels.get(i) == 0 for i in after) <= 0.1 * sum(labels.get(i) == 0 for i in before)


def test_one_row_of_each_text(stages):
    before, after = (texts(df) for df in stages[1])
    best = {}
    for i, t in before.items():
        best[t] = max(i, best.get(t, i))
    assert after == {i: t for t, i in best.items()}


def test_one_document_of_each_group(stages):
    before, after = (texts(df) for df in stages[2])
    ids = sorted(before)
    root = brute_components([brute_print(before[i]) for i in ids])
    assert sorted(after) == [ids[r] for r in sorted(set(root))]


def test_no_document_with_a_benchmark_window(stages, spark):
    before, after = (texts(df) for df in stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # by brute force over documents that share a rare word with an item; others cannot hold a window of it
    shared = {w for _, t in items for w in re.findall(r"\w{7,}", t.lower())}
    near = {i: t for i, t in before.items() if shared & set(re.findall(r"\w{7,}", t.lower()))}
    hit = {i for i, _, n, _ in brute_overlaps(list(near.items())[:60], items) if n}
    assert hit and not hit & set(after)
    leaks = {r.doc_id for r in queries.op6_decontaminate(spark, SF).where("contaminated").collect()}
    assert set(after) == set(before) - leaks


def test_encoding(stages):
    before = texts(stages[4][0])
    rows = stages[4][1].collect()
    assert {r.doc_id for r in rows} == set(before)
    library = tokenizers.Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    wanted = library.encode_batch([before[r.doc_id] or "" for r in rows], add_special_tokens=False)
    for r, want in zip(rows, wanted, strict=True):
        assert r.ids == want.ids and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(want.ids, skip_special_tokens=False)


def test_run_on_odd_and_empty_documents(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, df in (("odd", frames.odd(spark)), ("none", frames.docs(spark, []))):
        sf = str(tmp_path / name)
        df.withColumn("id", F.lit("clash")).write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
        labels.limit(0 if name == "none" else 1000).write.parquet(f"{sf}/labels.parquet")
        out = corpus_pipeline.run(spark, sf)
        assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"] and (name == "odd" or out.count() == 0)
