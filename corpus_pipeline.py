"""From raw documents to token ids: quality, exact copies, near copies, benchmark leaks, encoding.

``run`` applies the stages to ``documents`` one after the other. Each stage is written as Parquet in the shared
folder and read again as the next one's input. All stages but the last return the columns of ``documents``.

NULL texts count as empty and NULL ids are documents like others, in every stage; equal rows share their fate, but for the two that drop copies, which leave
one. Ties go as the stage says. An empty table passes through as an empty one, and further columns, whatever their names, stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.llm import bpe, decontaminate, exact_dedup, quality, simhash
from usertide.llm._shared import crc_remainder, stored, table, work_folder
from usertide.llm.queries import tokenizer


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.7 go."""
    learn = crc_remainder("doc_id", 4) != 2
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7, learn=learn)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked at 3 differing fingerprint bits or fewer, the one with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs, shingle=3, max_bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a 10-word window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents", n=10)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and the text that they decode to."""
    found = bpe.round_trip(docs, tokenizer("word_bpe_49k.json"))
    return found.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("bpe encoding", encode_texts),
]

#: A rule ensemble that is fitted here, and near copies by bit distance: not to be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = work_folder(spark), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{work}/stage-{k}")
    return docs
