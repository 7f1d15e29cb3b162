"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over all windows of the training texts.

Words are hashed once; the hash of a window of n words is made from the hashes of two shorter windows, so a text takes a
handful of passes however long its windows are. Window hashes are looked up in the set, and every hit is verified
on the words themselves. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import ascii_lower, set_aside, stored, whole_text, work_folder

#: What stands between words: ASCII but digits and letters. It also holds for texts that still have capitals.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: Column, lower: bool = True) -> Column:
    return F.array_remove(F.split(ascii_lower(text) if lower else text, f"{BETWEEN}+"), "")


def _slice(values: Column, start: int, n: Column) -> Column:
    return F.slice(values, start, F.greatest(n, F.lit(0)))


def window_hashes(df: DataFrame, lengths: list[int], words: str = "words", n: str = "n_words") -> DataFrame:
    """Add ``w<L>``, the hashes of all windows of L words, for every L asked for."""
    need: dict[int, tuple[int, int]] = {}

    def plan(length: int) -> None:
        if length > 1 and length not in need:
            half = 1 << (length - 1).bit_length() - 1
            plan(half)
            plan(length - half)
            need[length] = (half, length - half)

    for length in lengths:
        plan(length)
    df = df.withColumn("w1", F.transform(words, lambda w: F.xxhash64(w)))
    for length in sorted(need):
        left, right = need[length]
        count = F.col(n) - (length - 1)
        pair = F.zip_with(_slice(F.col(f"w{left}"), 1, count), _slice(F.col(f"w{right}"), left + 1, count), lambda x, y: F.xxhash64(x, y))
        df = df.withColumn(f"w{length}", pair)
    return df


def benchmark_grams(benchmark: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct window of the items: ``len, gram, items``. Items of fewer words are one window; of none, none."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(whole_text(text_col)).alias("words"))
    items = items.withColumn("n_words", F.size("words")).where("n_words > 0")
    items = items.withColumn("len", F.least("n_words", F.lit(n)))
    at = items.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("len") + 1)))
    at = at.select("item", "len", F.array_join(F.slice("words", F.col("at"), F.col("len")), " ").alias("gram"))
    return at.groupBy("len", "gram").agg(F.collect_set("item").alias("items"))


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_broadcast_bytes: int = 64 << 20,
    work: str | None = None,
) -> DataFrame:
    """Per input row: ``id, text_hash, n_words, n_hit, items, spans``.

    A window is n consecutive words of a benchmark item, or all words of an item that has fewer. A word is hit if it lies in any
    occurrence of a window; ``items`` are the ids, as sorted strings, of all items with an occurring window; ``spans`` are
    the merged runs of hit words, as (first, end) word numbers from 0.

    The set of windows is broadcast if its measured size is within ``max_broadcast_bytes``, and joined by a shuffle on
    the window hash beyond that. NULL and empty texts have no words. Rows that repeat id and text get the same result each; rows
    with the same id and other texts are told apart by ``text_hash``. NULL ids are kept. Empty tables give an empty
    result, or documents without hits. Items with a NULL id count for ``n_hit``, not among ``items``.
    """
    work = work_folder(docs.sparkSession, work)
    grams = stored(benchmark_grams(benchmark, n, item_col, item_text_col), f"{work}/grams")
    size = grams.agg(F.sum(F.octet_length("gram") + 64 + 24 * F.size("items"))).first()[0] or 0
    lengths = sorted(r[0] for r in grams.select("len").distinct().collect())  # n at most
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    texts = base.select("id", F.xxhash64("t").alias("text_hash"), words_of(F.col("t")).alias("words"))
    texts = texts.withColumn("n_words", F.size("words"))
    # the key of a window is made from its words in the same way on both sides
    keyed = grams.select("len", "gram", "items", F.split("gram", " ").alias("words")).withColumn("n_words", F.col("len"))
    keyed = window_hashes(keyed, lengths)
    none = F.lit(None).cast("long")
    key = F.coalesce(none, *[F.when(F.col("len") == k, F.element_at(f"w{k}", 1)) for k in lengths])
    keyed = keyed.select(key.alias("key"), "len", "gram", "items")
    seen = window_hashes(texts, lengths)
    sizes = {k: F.greatest(F.col("n_words") - (k - 1), F.lit(0)) for k in lengths}
    every = F.concat(*[F.col(f"w{k}") for k in lengths]) if lengths else F.array().cast("array<long>")
    seen = seen.select("id", "text_hash", "words", "n_words", F.posexplode(every).alias("p", "key"))
    first, before = F.lit(0), F.lit(0)
    for k in lengths:
        first = F.when(F.col("len") == k, F.col("p") - before).otherwise(first)
        before = before + sizes[k]
    if size <= max_broadcast_bytes:
        hits = seen.join(F.broadcast(keyed), "key").withColumn("first", first)
    else:
        # Only the hashes are shuffled; the words come back for what they hit.
        hits = seen.drop("words").join(keyed, "key").withColumn("first", first).where("first >= 0")
        again = texts.select(F.col("id").alias("__i"), F.col("text_hash").alias("__h"), "words")
        hits = hits.join(again, F.col("id").eqNullSafe(F.col("__i")) & (F.col("text_hash") == F.col("__h")))
    there = F.array_join(F.slice("words", F.greatest("first", F.lit(0)) + 1, F.col("len")), " ")
    hits = hits.where((F.col("first") >= 0) & (there == F.col("gram")))
    hits = hits.select("id", "text_hash", F.struct("first", (F.col("first") + F.col("len")).alias("end")).alias("span"), "items")
    found = hits.groupBy("id", "text_hash").agg(F.collect_set("span").alias("spans"), F.collect_set("items").alias("items"))
    # spans come by their first word: one that starts within the last one extends it
    merged = F.aggregate(
        F.sort_array("spans"),
        F.array().cast("array<struct<first:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["first"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["first"].alias("first"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    found = found.select(
        F.col("id").alias("__id"),
        F.col("text_hash").alias("__hash"),
        merged.alias("spans"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
    )
    count = F.size(words_of(F.col("t"), lower=False)).cast("long")
    count = base.select("id", F.xxhash64("t").alias("text_hash"), count.alias("n_words"))
    joined = count.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>"))
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("id", "text_hash", "n_words", hit.alias("n_hit"), items.alias("items"), spans.alias("spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """The input rows, all columns as they were, without documents (or only the hit spans) that hold benchmark windows.

    ``remove="documents"`` drops every row with a hit word. ``remove="spans"`` cuts the hit words, with what stands
    between them, out of the text and leaves all else as it was; a NULL text stays NULL. Rows that repeat id and text share their
    fate; NULL ids are documents like others. An empty table gives an empty one, and no benchmark leaves all rows. No
    column of the input is lost, whatever its name.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    work = work_folder(docs.sparkSession, options.pop("work", None))
    found = find_overlaps(docs, benchmark, work=work, **options).where("n_hit > 0")
    found = stored(found.select("id", "text_hash", "spans").dropDuplicates(["id", "text_hash"]), f"{work}/hits")
    columns = docs.columns
    docs, back = set_aside(docs, ["__key_id", "__key", "__id", "__hash", "__spans"])
    keyed = docs.withColumns({"__key_id": F.col(id_col), "__key": F.xxhash64(whole_text(text_col))})
    found = found.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    on = F.col("__key_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash"))
    if remove == "documents":
        kept = keyed.join(found, on, "left_anti").drop("__key_id", "__key")
        return kept.withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in columns])
    cut = F.concat(
        F.regexp_extract(text_col, f"^{BETWEEN}*", 0),
        F.array_join(
            F.filter(
                F.regexp_extract_all(text_col, F.lit(f"{WORD}+{BETWEEN}*"), F.lit(0)),
                lambda _, i: ~F.exists("__spans", lambda s: (s["first"] <= i) & (i < s["end"])),
            ),
            "",
        ),
    )
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(cut)
    cut_out = keyed.join(found, on, "left").withColumn(text_col, text).drop("__key_id", "__key", "__id", "__hash", "__spans")
    return cut_out.withColumnsRenamed(back).select(*[F.col(f"`{c}`") for c in columns])
