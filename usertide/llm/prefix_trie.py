"""A trie of conversation prefixes, with a count-min sketch that keeps prefixes of one conversation out of the shuffle.

A conversation's rows are summed up in order: a prefix's digest is the XOR of two 64-bit hashes of each turn's place and SHA-256.
Running values come from blocks of a conversation, then from the blocks' totals, so a conversation with a third of all turns is as
many groups as it has blocks. A node is known by depth, both digests and the SHA-256 of its last turn.

All prefix digests are counted in a count-min sketch; its cells are merged to one bit each: seen once, or more often. Bits are
bounded (``MAX_WIDTH`` cells a row of the sketch) and broadcast. A cell seen once proves that its prefix belongs to one conversation,
and so do all longer ones: these tails are emitted where they are. Only prefixes that may be shared, the first of each tail
and the last of each conversation are shuffled, grouped by digest and counted exactly. A sketch that proves less costs more shuffling; results do
not depend on it.

Sums over subtrees need no walk: each node belongs to its smallest member at that depth. A member adds what it owns from a depth on
down, a running sum from its end, and a node adds up its members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.llm._shared import stored, whole_text, work_folder

#: Rows of the sketch; cells of a row, at least and at most.
ROWS, MIN_WIDTH, MAX_WIDTH = 3, 1 << 16, 1 << 27
#: Turns a block; cells whose bits are one message.
BLOCK, SEGMENT = 1024, 1 << 16
NODE = ["depth", "k1", "k2", "turn_digest"]


def turns_of(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``c, bucket, turn, digest, words`` per row: no text goes further. Rows that sort together share a bucket or are in neighbouring ones."""
    role, text = whole_text(role_col), whole_text(text_col)
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.unhex(F.sha2(framed, 256)).alias("digest"), words.alias("words")
    )
    # turns without a number come first; they are all alike, so that their digests order them
    first = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("long")
    number = F.floor(F.col("turn") / BLOCK).cast("long")
    return rows.withColumn("bucket", F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(number, first).alias("at")))


def carried(totals: DataFrame, key: str, block: str, values: dict[str, Column], descending: bool = False) -> DataFrame:
    """Per block of a key what the blocks before it add up to: ``values`` are aggregates of the totals' columns."""
    order = F.desc(block) if descending else F.asc(block)
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({name: value.over(before) for name, value in values.items()})


def lane(number: int, place: Column | str, digest: Column | str) -> Column:
    return F.xxhash64(F.lit(number), place, digest)


def rebuilt(turns: DataFrame, share: int, heads_below: int, work: str) -> DataFrame:
    """Conversations whose first turns are those of the conversation that ``share`` neighbours have in common.

    ``c, p, bucket, digest, words, last`` per turn and place, and a row of place 0 for each conversation.
    """
    counted = turns.groupBy("c", "bucket").agg(F.count("*").alias("rows"))
    blocks = carried(counted, "c", "bucket", {"offset": F.sum("rows")}).withColumn("offset", F.coalesce("offset", F.lit(0)))
    blocks = stored(blocks, f"{work}/blocks")
    in_order = Window.partitionBy("c", "bucket").orderBy(F.asc_nulls_first("turn"), "digest")
    base = F.col("c") - F.col("c") % share
    # the first turns of the conversations that lend them
    few = turns.where(F.col("c") % share == 0).withColumn("i", F.row_number().over(in_order)).where(F.col("i") < heads_below)
    few = few.join(blocks, ["c", "bucket"]).withColumn("i", F.col("i") + F.col("offset")).where(F.col("i") < heads_below)
    # at most ``heads_below - 1`` for each conversation
    heads = few.groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "digest", "words"))).alias("head"))

    taken = (F.crc32(F.col("c").cast("string").cast("binary")) % heads_below).cast("int")
    convs = blocks.groupBy("c").agg(F.sum("rows").alias("own")).withColumns({"base": base, "h": taken})
    convs = convs.join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h"))
    convs = convs.select("c", "own", "h", head.alias("head")).withColumn("k", F.size("head"))
    length = F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = stored(convs.withColumn("length", length), f"{work}/conversations")

    start = F.lit(None).cast(turns.schema["bucket"].dataType)
    borrowed = convs.select("c", "length", F.explode("head").alias("t"), start.alias("bucket"))
    borrowed = borrowed.select("c", F.col("t.i").cast("long").alias("p"), "bucket", "t.digest", "t.words", "length")
    roots = convs.select("c", F.lit(0).cast("long").alias("p"), start.alias("bucket"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words"), "length")
    places = blocks.join(convs.select("c", "h", "k", "length"), "c").select("c", "bucket", "offset", "h", "k", "length")
    own = turns.withColumn("i", F.row_number().over(in_order)).join(places, ["c", "bucket"])
    own = own.withColumn("i", F.col("i") + F.col("offset")).where(F.col("i") > F.col("h"))
    own = own.select("c", (F.col("i") - F.col("h") + F.col("k")).cast("long").alias("p"), "bucket", "digest", "words", "length")
    rows = own.unionByName(borrowed).unionByName(roots)
    return rows.select("c", "p", F.floor(F.col("p") / BLOCK).alias("block"), "digest", "words", (F.col("p") == F.col("length")).alias("last"))


def with_prefixes(rows: DataFrame, work: str) -> DataFrame:
    """Digests of every prefix, ``k1, k2``, and of the one before it, ``u1, u2``; the root's are zero."""
    rows = rows.withColumns({f"l{n}": F.when(F.col("p") > 0, lane(n, "p", "digest")).otherwise(F.lit(0)) for n in (1, 2)})
    so_far = Window.partitionBy("c", "block").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows.withColumns({f"s{n}": F.bit_xor(f"l{n}").over(so_far) for n in (1, 2)}), f"{work}/turns")
    totals = rows.groupBy("c", "block").agg(*[F.bit_xor(f"l{n}").alias(f"t{n}") for n in (1, 2)])
    # only conversations of several blocks carry anything over
    before = carried(totals, "c", "block", {f"b{n}": F.bit_xor(f"t{n}") for n in (1, 2)}).where(F.col("b1").isNotNull())
    joined = rows.join(before.select("c", "block", "b1", "b2"), ["c", "block"], "left")
    for n in (1, 2):
        joined = joined.withColumn(f"k{n}", F.col(f"s{n}").bitwiseXOR(F.coalesce(f"b{n}", F.lit(0))))
        joined = joined.withColumn(f"u{n}", F.col(f"k{n}").bitwiseXOR(F.col(f"l{n}")))
    return joined.select("c", "p", "block", "digest", "words", "last", "k1", "k2", "u1", "u2")


def cells(k1: np.ndarray, k2: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each prefix in each row of the sketch; ``width`` is a power of two."""
    a, b = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    return [(((a + np.uint64(r) * b) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & (width - 1) for r in range(1, ROWS + 1)]


def sketch(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Count-min sketch of the digests of places 1 and on, a bit a cell: seen more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = cells(*(batch.column(n).to_numpy() for n in ("k1", "k2")), width)
            for r, cell in enumerate(found):
                cell, n = np.unique(cell, return_counts=True)
                cut = np.flatnonzero(np.diff(cell // SEGMENT, prepend=-1))
                ends = [*cut[1:].tolist(), len(cell)]
                at = (cell % SEGMENT).astype(np.uint16)
                many = n > 1
                seen = [at[i:j].tobytes() for i, j in zip(cut.tolist(), ends, strict=True)]
                again = [at[i:j][many[i:j]].tobytes() for i, j in zip(cut.tolist(), ends, strict=True)]
                segment = r * (width // SEGMENT) + cell[cut] // SEGMENT
                yield pa.RecordBatch.from_arrays([pa.array(segment), pa.array(seen, pa.binary()), pa.array(again, pa.binary())], names=["segment", "seen", "again"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SEGMENT, np.int64)
        for column in ("seen", "again"):
            for packed in part[column]:
                total[np.frombuffer(packed, np.uint16)] += 1
        return pd.DataFrame({"segment": part["segment"].iloc[:1], "bits": [np.packbits(total > 1).tobytes()]})

    counted = rows.where("p > 0").select("k1", "k2").mapInArrow(count, "segment long, seen binary, again binary")
    merged = counted.groupBy("segment").applyInPandas(merge, "segment long, bits binary")
    bits = np.zeros((ROWS * (width // SEGMENT), SEGMENT // 8), np.uint8)
    for row in merged.toLocalIterator():  # ROWS * width bits, all in all
        bits[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return list(bits.reshape(ROWS, -1))


def screened(rows: DataFrame, bits: list[np.ndarray], width: int) -> DataFrame:
    """``alone``: the sketch proves that the prefix has one member; ``tail``: it proves so of the prefix before."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def proven(k1: pa.Array, k2: pa.Array) -> pa.Array:
        alone = np.zeros(len(k1), bool)
        for row, cell in zip(shared.value, cells(k1.to_numpy(), k2.to_numpy(), width), strict=True):
            alone |= (row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
        return pa.array(alone)

    found = rows.withColumns({"alone": proven("k1", "k2"), "tail": proven("u1", "u2")})
    return found.withColumns({"alone": F.col("alone") & (F.col("p") > 0), "tail": F.col("tail") & (F.col("p") > 1)})


def joined_ids(ids: DataFrame, key: str, id_col: str) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of each key's ids, ascending, joined by commas.

    Ids are sorted and joined to pieces under a range partitioning, which splits a key with many; the pieces of a key then go through the hash one
    after another, as SHA-256 demands, and no more than one is held.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, found = batch.column(0).to_numpy(), batch.column(1)
            cut = np.flatnonzero(np.diff(node, prepend=~node[:1])) if len(node) else np.zeros(0, np.int64)
            ends = [*cut[1:].tolist(), len(node)]
            texts = [",".join(map(str, found.slice(i, j - i).to_pylist())) for i, j in zip(cut.tolist(), ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(node[cut]), found.take(pa.array(cut)), pa.array(texts, pa.string())], names=["node", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, ([], [])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if key != node:
                    if state:
                        out[0].append(node)
                        out[1].append(state.hexdigest())
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], names=["node", "ends_sha256"])
            out = ([], [])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    rows = ids.select(F.col(key).alias("node"), F.col(id_col).cast("long").alias("id"))
    rows = rows.repartitionByRange("node", "id").sortWithinPartitions("node", "id")
    rows = rows.mapInArrow(pieces, "node long, first long, ids string")
    rows = rows.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node long, ends_sha256 string")
    return rows.withColumnRenamed("node", key)


def prefix_trie(
    df: DataFrame,
    share: int = 20,
    heads_below: int = 4,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    max_width: int = MAX_WIDTH,
    work: str | None = None,
) -> DataFrame:
    """The nodes of the trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversations are ordered by turn, NULL first, ties by a hash of role and text; rows that repeat are turns of their own. NULL role or
    text counts as empty. Conversation c takes its first h turns, fewer if there are fewer, from conversation c - c % ``share``, with h = crc32(c) %
    ``heads_below``, and then its own after its first h; it may end up with none. A node is a distinct sequence of first turns; the root has none.
    ``conv_id`` is its smallest member, ``n_convs`` their number, ``saved_tokens`` the words of each subtree node's last turn times its further
    members, and ``ends_sha256`` that of the ids of members that end there.

    Rows without a conversation id take no part. An empty table gives an empty result, without a root. Empty and very long texts are turns
    like others. Other columns are ignored, whatever their names.
    """
    work = work_folder(df.sparkSession, work)
    turns = stored(turns_of(df, id_col, turn_col, role_col, text_col), f"{work}/digests")
    rows = stored(with_prefixes(rebuilt(turns, share, heads_below, work), work), f"{work}/prefixes")
    width = max(MIN_WIDTH, min(max_width, 1 << int(np.ceil(np.log2(max(2, 2 * rows.count()))))))
    rows = stored(screened(rows, sketch(rows, width), width), f"{work}/screened")

    empty = hashlib.sha256(b"").hexdigest()
    ended = F.when(F.col("last"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(F.lit(empty))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    local = rows.where("tail").select(
        F.col("c").alias("conv_id"), F.col("p").alias("depth"), F.col("c").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(F.col("last"), none).otherwise(one).alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"), ended.alias("ends_sha256"),
    )

    # what may be shared, the first of every tail, and, for their leaves, the last of every conversation
    seen = rows.where("not tail or last").select("c", "p", "block", "words", "last", "alone", "tail", "u1", "u2", F.col("p").alias("depth"), "k1", "k2", F.col("digest").alias("turn_digest"))
    members = seen.where("not tail and not alone")
    count = [F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.count_if("last").alias("n_ending")]
    groups = members.groupBy(*NODE).agg(*count).withColumn("node", F.monotonically_increasing_id())
    groups = stored(groups, f"{work}/groups")
    seen = seen.join(groups, NODE, "left").withColumns({"n_convs": F.coalesce("n_convs", one), "first": F.coalesce("conv_id", "c")})
    owner = F.col("c") == F.col("first")
    leaf = F.when(owner & F.col("last") & (F.coalesce("n_ending", one) == F.col("n_convs")), one).otherwise(none)
    saved = F.when(owner, (F.col("n_convs") - 1) * F.col("words")).otherwise(none)
    seen = stored(seen.withColumns({"owner": owner, "leaf": leaf, "saved": saved}).drop("conv_id"), f"{work}/members")

    # what a member owns from each depth on down: within its block, and in the blocks below
    down = Window.partitionBy("c", "block").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    totals = seen.groupBy("c", "block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    below = carried(totals, "c", "block", {"more_leaf": F.sum("leaf"), "more_saved": F.sum("saved")}, descending=True)
    below = below.where("more_leaf is not null").select("c", "block", "more_leaf", "more_saved")
    sums = seen.withColumns({n: F.sum(n).over(down) for n in ("leaf", "saved")}).join(below, ["c", "block"], "left")
    sums = sums.withColumns({n: F.col(n) + F.coalesce(f"more_{n}", none) for n in ("leaf", "saved")})
    sums = sums.where("node is not null").groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    # one row for each node that is not local; its parent is a group, or was proven alone like itself
    nodes = seen.where("owner and not tail")
    ups = groups.select(F.col("depth").alias("up_depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("up"), F.col("node").alias("up_node"))
    above = (F.col("depth") - 1 == F.col("up_depth")) & (F.col("u1") == F.col("up1")) & (F.col("u2") == F.col("up2"))
    nodes = stored(nodes.join(ups, above, "left").drop("up_depth", "up1", "up2"), f"{work}/nodes")
    children = nodes.where("up_node is not null").groupBy(F.col("up_node").alias("node")).agg(F.count("*").alias("n_children"))
    ends = joined_ids(seen.where("node is not null and last"), "node", "c")
    parent = F.when(F.col("depth") > 0, F.coalesce("up", "c")).alias("parent_conv_id")
    top = nodes.where("node is null").select(
        F.col("c").alias("conv_id"), "depth", parent, one.alias("n_convs"), F.when(F.col("last"), none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), none.alias("saved_tokens"), ended.alias("ends_sha256"),
    )
    found = nodes.where("node is not null").join(children, "node", "left").join(sums, "node").join(ends, "node", "left")
    found = found.select(
        F.col("c").alias("conv_id"), "depth", parent, "n_convs", F.coalesce("n_children", none).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
    return stored(found.unionByName(top).unionByName(local), f"{work}/found")
