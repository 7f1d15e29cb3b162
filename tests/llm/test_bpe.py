import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_equals_the_library(spark, sf_dir, library):
    texts = [*frames.ODD_TEXTS, "é" * 50 + " " + "ab" * 500, "ĳ Ǆ ŉ ẞ Å", "_a_b __ -", "Σ ΣΑΣ ας", "<|startoftext|>"]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    got = bpe.round_trip(frames.clashing(frames.docs(spark, texts)), PATH).orderBy("id").collect()
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [r.ids for r in got] == want
    assert [r.decoded for r in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_a_small_table_of_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    coder = bpe.Bpe(PATH)
    for text in ("one two three four five", "six one two", "", "one seven eight nine <|endoftext|> ten"):
        ids, size = coder.encode([text, text])
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and size.tolist() == [len(want)] * 2


def test_columns_nulls_and_unknown_ids(spark, monkeypatch):
    df = frames.docs(spark, [None, "", "hello world", "again"])
    ids = df.select("doc_id", bpe.encode(F.col("text"), PATH).alias("ids"))
    out = ids.select("doc_id", bpe.decode(F.when(F.col("doc_id") < 3, F.col("ids")), PATH).alias("t")).orderBy("doc_id")
    assert [r.t for r in out.collect()] == ["", "", "hello</w> world</w>", ""]
    coder = bpe.load(PATH)
    monkeypatch.setattr(bpe, "MAX_CHARS", 2)
    lists = pa.array([[3306, -1, 10**6, None, 1002], [], None, [3306] * 7], pa.list_(pa.int32()))
    assert coder.decode(lists).to_pylist() == ["hello</w> world</w>", "", "", " ".join(["hello</w>"] * 7)]


def test_empty_table_and_other_files(spark):
    assert bpe.round_trip(frames.docs(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_special_tokens_in_other_case(library):
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|endoftext|> <|ENDOFTEXT|><|endoftext|>", "x<|STARTOFTEXT|>y <|startoftext|>", "<|endoftext|>"]
    for order in (texts, texts[::-1]):
        coder = bpe.Bpe(PATH)
        ids, size = coder.encode(order)
        want = [e.ids for e in library.encode_batch(order, add_special_tokens=False)]
        assert ids.tolist() == sum(want, []) and size.tolist() == [len(w) for w in want]
    assert bpe.Bpe(PATH).encode(["<|ENDOFTEXT|>"])[0].tolist() == [27, 347, 40786, 4160, 91, 285]


def test_a_batch_is_encoded_slice_by_slice(spark, library, monkeypatch):
    texts = pa.array(["one two", None, "", "three four five", "a" * 30, "six", "é" * 4, None])
    monkeypatch.setattr(bpe, "MAX_CHARS", 10)
    parts = list(bpe.slices(texts))
    assert pa.concat_arrays(parts).equals(texts) and [len(p) for p in parts] == [3, 1, 1, 1, 2]
    assert list(bpe.slices(texts.slice(2, 0))) == [] and pa.concat_arrays(list(bpe.slices(texts.slice(3)))).equals(texts.slice(3))
    # one batch of Spark, many slices: every row gets its own ids
    long = [f"word{i} " * 20_000 + ("" if i % 3 else "<|endoftext|>") for i in range(30)] + [None, ""]
    got = bpe.round_trip(frames.docs(spark, long).coalesce(1), PATH).orderBy("id").collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for t in long]
    assert [r.ids for r in got] == want and [r.decoded for r in got] == [library.decode(w, skip_special_tokens=False) for w in want]
    alone = frames.docs(spark, long).coalesce(1).select("doc_id", bpe.encode(F.col("text"), PATH).alias("ids")).orderBy("doc_id")
    assert [r.ids for r in alone.collect()] == want
