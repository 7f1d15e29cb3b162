"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.llm import (
    bpe,
    decontaminate,
    embeddings,
    exact_dedup,
    hard_negatives,
    kneser_ney,
    licences,
    oracle,
    prefix_trie,
    quality,
    quotes,
    simhash,
    token_files,
    toxicity,
)
from usertide.llm._shared import crc_remainder, table, work_folder


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file; it is the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations, made into mail that quotes, with quotes linked and replies in order."""
    found = quotes.link_quotes(quotes.quoted_mail(table(spark, sf_dir, "conversations")))
    return found.select(
        "conv_id",
        "turn",
        "parent",
        "thread",
        "depth",
        "quoted",
        "linked",
        F.array_join("sources", ",").alias("sources"),
        F.sha2("own", 256).alias("own_sha256"),
    )


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under a bigram model of those that are not held out."""
    docs, out = table(spark, sf_dir, "documents"), crc_remainder("doc_id", 7) == 2
    model = kneser_ney.fit(docs.where(~out), order=2)
    scored = kneser_ney.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose fingerprints of 3-word shingles are linked at 3 bits or fewer."""
    found = simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, by rules learnt from the labels that are not held out."""
    docs, out = table(spark, sf_dir, "documents"), crc_remainder("doc_id", 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn=~out)
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op5_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score and toxic spans, by a chain learnt from the labels that are not held out."""
    docs, out = table(spark, sf_dir, "documents"), crc_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~out)
    scored = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against 10-word windows of the benchmark items."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_overlaps(docs, items, n=10)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and their lines, that are known licence texts or notices."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "licence", F.array_join("notices", ",").alias("notices"), "n_notices"
    )


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to."""
    found = bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its text that stays."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of documents, found again in flat files that the documents were encoded to."""
    work, eod = work_folder(spark), 49408  # the first id that the vocabulary leaves free
    order = token_files.write_tokens(table(spark, sf_dir, "documents"), f"{work}/files", tokenizer("word_bpe_49k.json"), eod)
    found = token_files.count_documents(spark, f"{work}/files", f"{work}/scan", eod)
    found = found.withColumn("file", F.regexp_extract("path", r"tokens-(\d+)\.bin$", 1).cast("int"))
    return found.join(order, ["file", "ordinal"]).select(
        F.col("id").alias("doc_id"), "n_tokens", "ended", "file", "ordinal", F.col("first").alias("first_token")
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label linked at a cosine of 0.93 or more, and the representative of each group."""
    found = embeddings.near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that borrow their first turns from a neighbour."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), share=20, heads_below=4)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), lambda vec_id: vec_id % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quote_linking,
            op2_kneser_ney,
            op3_simhash_dedup,
            op4_quality_rules,
            op5_toxic_spans,
            op6_decontaminate,
            op7_licence_scan,
            op8_bpe_round_trip,
            op9_exact_dedup,
            op10_token_counts,
            op11_embedding_dedup,
            op12_prefix_trie,
            op13_hard_negatives,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
