"""Small tables with what real ones hold: NULLs, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 997} und{i % 13}" for i in range(15_000))

ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "Two WORDS",
    "ΑΣ İstanbul ﬁ é É ß K",
    "a\x1cb\x1fc\x85d\xa0e f",
    "x<|endoftext|>y <|startoftext|>Z <|end",
    "日本語 テスト 👍🏽 👨‍👩‍👧",
    "aaa aaaa aaaaa " * 3,
    "don't I'LL we've 'S 12 3.5 ½",
    "\x00\x01 a\x00b",
    LONG,
]


def docs(spark, texts, first: int = 0):
    """Documents numbered from ``first``."""
    rows = [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd(spark):
    """Odd texts, a repeated row, a repeated id with another text, and NULL ids."""
    rows = [(i, t, "en", None, 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], (4, "another text of the same id", None, None, None), (None, "no id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same rows with columns named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ["id", "t", "fp", "digest", "run", "row", "kept", "keep_id", "words", "n_words", "score", "found", "ids", "spans", "text_hash", "label", "key", "n", "root", "node", "__id", "__key", "__text", "__words", "__lines", "__stats", "__score", "c", "p", "cell", "block", "vec", "dims", "slot"]
    return df.withColumns({n: F.lit("clash") for n in names})
