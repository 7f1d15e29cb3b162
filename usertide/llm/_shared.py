"""What several operators share: the work folder, tables, text columns, connected components."""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.session import shared_dir


def work_folder(spark: SparkSession, work: str | None = None) -> str:
    """A fresh folder for written tables, under ``spark.checkpoint.dir`` unless one is given."""
    return work or shared_dir(spark)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str) -> Column:
    """The text as it is; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Plain lower() does that, and faster, where all is ASCII."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)


def crc_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def sampled(id_col: str, fraction: Column | float) -> Column:
    """Whether a row is in a sample of this fraction, by a hash of its id; fine enough for very small fractions."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 40)) < F.lit(float(1 << 40)) * fraction


def unused(df: DataFrame, name: str) -> str:
    """The name, or one made from it, that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The table without columns of these names: they get unused ones. Also the renaming that gives them back."""
    wanted, back = {n.lower() for n in names}, {}
    for column in df.columns:
        if column.lower() in wanted:
            spare = unused(df, f"_aside_{column}")
            df, back = df.withColumnRenamed(column, spare), back | {spare: column}
    return df, back


#: Rows of a text table that are broadcast to say which rows go, at most so many bytes; bits of the filter beyond that.
MAX_DECISIONS, FILTER_BITS = 64 << 20, 1 << 28
_PIECE = 1 << 19


def bit_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit for each of the ``bits`` (a power of two) values that the lowest bits of a long column can have."""
    piece = min(bits, _PIECE)

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(piece, bool)
        held[part["at"].to_numpy() % piece] = True
        return pd.DataFrame({"piece": part["piece"].iloc[:1], "bits": [np.packbits(held).tobytes()]})

    at = F.col(hashes.columns[0]).bitwiseAND(F.lit(bits - 1)).alias("at")
    places = hashes.select(at).distinct().withColumn("piece", F.floor(F.col("at") / piece))
    found = np.zeros((bits // piece, piece // 8), np.uint8)
    for row in places.groupBy("piece").applyInPandas(pack, "piece long, bits binary").toLocalIterator():
        found[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return found.reshape(-1)


def rows_that_stay(
    docs: DataFrame, found: DataFrame, id_col: str, key: Column, work: str, max_bytes: int = MAX_DECISIONS, bits: int = FILTER_BITS
) -> DataFrame:
    """The rows of ``docs`` that ``found`` (``id, key, kept``, one row per input row) says to keep, all columns as they were.

    Decisions are joined back by id and ``key``, an expression of the text. Input rows that repeat both are one document, of which any one
    row stays. Rows of which nothing is said stay.

    Only what is out of the ordinary is joined: documents that go, and those that are repeated. Their ids and keys are broadcast if they measure
    no more than ``max_bytes``, and no row is shuffled, but for repeated ones that stay. Beyond that their hashes are broadcast as a filter of
    ``bits`` bits; rows that it does not hold pass, and only the others are shuffled and told apart exactly.
    """
    spark = docs.sparkSession
    told = found.groupBy("id", "key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    told = stored(told.where(~F.col("kept") | (F.col("n") > 1)).withColumn("hash", F.xxhash64("id", "key")), f"{work}/decisions")
    size, repeated = told.agg(F.sum(F.octet_length(F.col("key").cast("binary" if _is_binary(told) else "string")) + 64), F.count_if("kept")).first()
    if not size:
        return docs
    of, its, says = (unused(docs, n) for n in ("_id_of", "_key_of", "_says"))
    mine, hashed = unused(docs, "_key"), unused(docs, "_hash")
    told = told.select(F.col("id").alias(of), F.col("key").alias(its), F.col("kept").alias(says), "hash")
    keyed = docs.withColumn(mine, key)
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(of)) & (F.col(mine) == F.col(its))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    passed = None
    if size <= max_bytes:
        asked = F.broadcast(told.drop("hash"))
    else:
        held = spark.sparkContext.broadcast(bit_filter(told.select("hash"), bits))

        @F.arrow_udf("boolean")
        def named(hashes: pa.Array) -> pa.Array:
            at = hashes.to_numpy() & (bits - 1)
            return pa.array((held.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

        keyed = keyed.withColumn(hashed, named(F.xxhash64(f"`{id_col}`", mine)))
        passed, keyed, asked = keyed.where(~F.col(hashed)).select(*columns), keyed.where(hashed), told.drop("hash")
    plain = keyed.join(asked, on, "left_anti").select(*columns)
    if repeated:
        again = keyed.join(asked.where(says), on, "left_semi").dropDuplicates([id_col, mine]).select(*columns)
        plain = plain.unionByName(again)
    return passed.unionByName(plain) if passed is not None else plain


def _is_binary(told: DataFrame) -> bool:
    return told.schema["key"].dataType.typeName() == "binary"


def connected_components(edges: DataFrame, work: str, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Smallest reachable node (``root``) of every ``node`` that has a link, by alternating stars.

    Large stars link a node's larger neighbours to its smallest one, small stars its smaller ones; the
    links of a component become one star in a number of rounds that grows with the logarithm of its size.
    A round aggregates before it shuffles and joins on single nodes, so a node with a third of all links is
    split by adaptive execution. Each round is a table in the shared folder. Self links and NULLs are ignored.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    links = edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct()
    links = stored(links, f"{work}/links-0")
    before = None
    for k in range(1, rounds + 1):
        if links.isEmpty():
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the joins are plain exchanges, which Spark can split
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        least = stored(least, f"{work}/large-{k}")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, f"{work}/moved-{k}")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{work}/small-{k}")
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{work}/links-{k}")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
