"""Bloom filters of stored keys as tables: which stored parts may hold a key, without reading their rows.

A filter is one row per 64-bit word: ``part, width, word, bits``. A key sets ``BITS`` bits of a single word, chosen by its
hash, so a filter is built by one aggregation (an OR of masks) and asked by one equi join. A part of n keys has a power of two of words, from
n / 4 to n / 2, or 16 to 32 bits a key: about one absent key in a hundred is thought present. No present key is ever missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key in its word, and keys a word at most.
BITS, WORD_KEYS = 4, 4
#: A filter's columns.
SCHEMA = "part string, width long, word long, bits long"


def _word(keys: list[str], width: Column) -> Column:
    # widths are powers of two
    return F.xxhash64(*keys).bitwiseAND(width - 1)


def _mask(keys: list[str]) -> Column:
    second = F.xxhash64(F.lit("bits"), *keys)
    places = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places])


def filter_widths(rows: DataFrame, part: Column) -> DataFrame:
    """``part, width``: the words of each part's filter, a power of two with no more than ``WORD_KEYS`` keys a word."""
    words = F.ceil(F.log2(F.greatest(F.count("*") / WORD_KEYS, F.lit(1.0)))).cast("int")
    return rows.groupBy(part.alias("part")).agg(F.call_function("shiftleft", F.lit(1).cast("long"), words).alias("width"))


def _width_of(part: Column, widths: dict[str, int]) -> Column:
    """The width of a part, by the few widths that there are: nothing is joined or broadcast."""
    named: dict[int, list[str]] = {}
    for name, width in widths.items():
        named.setdefault(width, []).append(name)
    found = [F.when(part.isin(names), F.lit(width).cast("long")) for width, names in named.items()]
    return F.coalesce(*found, F.lit(None).cast("long"))


def build_filter(rows: DataFrame, part: Column, keys: list[str], widths: DataFrame | dict[str, int]) -> DataFrame:
    """The filter of every part. Rows without a complete key are left out, as they are never found.

    ``widths`` are those of ``filter_widths``, or the same collected: part to width.
    """
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rows = rows.where(known).select(part.alias("part"), *keys)
    rows = rows.withColumn("width", _width_of(F.col("part"), widths)) if isinstance(widths, dict) else rows.join(widths, "part")
    rows = rows.select("part", "width", _word(keys, F.col("width")).alias("word"), _mask(keys).alias("mask"))
    return rows.groupBy("part", "width", "word").agg(F.bit_or("mask").alias("bits"))


def may_hold(keys_of: DataFrame, keys: list[str], filters: DataFrame, widths: list[int]) -> DataFrame:
    """Keys with each part that may hold them. ``widths`` are those that occur among the filters, a few powers of two.

    Filters grow with the keys that are stored, so they are never broadcast.
    """
    sized = keys_of.select(*keys, F.explode(F.array(*[F.lit(w).cast("long") for w in widths])).alias("width"))
    asked = sized.select(*keys, "width", _word(keys, F.col("width")).alias("word"), _mask(keys).alias("mask"))
    found = asked.join(filters.hint("merge"), ["width", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return found.select(*keys, "part").distinct()
