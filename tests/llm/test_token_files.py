import numpy as np
import pytest

from tests.llm import frames
from usertide.llm import bpe, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
EOD = 49408


def brute(path, ids, eod):
    out, start = [], 0
    ends = [i for i, x in enumerate(ids) if x == eod]
    for k, end in enumerate(ends):
        out.append((path, k, start, end - start, True))
        start = end + 1
    if start < len(ids):
        out.append((path, len(ends), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("width", [2, 4])
def test_stitches_blocks(spark, tmp_path, block, width):
    rng = np.random.default_rng(block)
    files = [[], [9], [1, 2, 3], [9, 9], [1, 9, 2, 2, 9, 9, 3], [5] * 40 + [9], rng.integers(7, 10, 60).tolist()]
    want = []
    (tmp_path / "files").mkdir()
    for i, ids in enumerate(files):
        name = tmp_path / "files" / f"tokens-{i}.bin"
        name.write_bytes(np.array(ids, f"<u{width}").tobytes() + b"\x01" * (i % 2))
        want += brute(f"file:{name}", ids, 9)
    got = token_files.count_documents(spark, str(tmp_path / "files"), str(tmp_path / "scan"), 9, width, block)
    rows = [(r.path.replace("file://", "file:"), r.ordinal, r.first, r.n_tokens, r.ended) for r in got.collect()]
    assert sorted(rows) == sorted(want)


def test_counts_equal_the_encoder_s(spark, tmp_path):
    df = frames.clashing(frames.odd(spark)).repartition(3)
    order = token_files.write_tokens(df, str(tmp_path / "files"), PATH, EOD)
    found = token_files.count_documents(spark, str(tmp_path / "files"), str(tmp_path / "scan"), EOD, block=1000)
    assert found.where("not ended").count() == 0
    found = found.selectExpr("cast(regexp_extract(path, 'tokens-([0-9]+)', 1) as int) as file", "ordinal", "n_tokens")
    got = sorted((str(r.id), r.n_tokens) for r in found.join(order, ["file", "ordinal"]).collect())
    coder = bpe.Bpe(PATH)
    rows = df.select("doc_id", "text").collect()
    size = coder.encode([r.text or "" for r in rows])[1]
    assert got == sorted((str(r.doc_id), int(n)) for r, n in zip(rows, size, strict=True))


def test_empty_tables_and_bad_separators(spark, tmp_path):
    order = token_files.write_tokens(frames.docs(spark, []), str(tmp_path / "files"), PATH, EOD)
    assert order.count() == 0
    assert token_files.count_documents(spark, str(tmp_path / "files"), str(tmp_path / "scan"), EOD).count() == 0
    with pytest.raises(Exception, match="differ from"):
        token_files.write_tokens(frames.docs(spark, ["hello"]), str(tmp_path / "bad"), PATH, 3306)
