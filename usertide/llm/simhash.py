"""Near copies by SimHash: fingerprints, a vantage-point tree over Hamming distance, and connected components.

The upper part of the tree is built on the driver from a bounded sample of fingerprints; it only decides where to look, so
results do not depend on it. Spark deals all distinct fingerprints to its leaves, the shards. At a node with
vantage point v and radius mu, fingerprints within mu + r of v go inside and those beyond mu go outside, so those in the
band (mu, mu + r] are in both. Two fingerprints at r bits or fewer never part: if one lies within mu, the triangle inequality puts the
other within mu + r. By induction each such pair meets in a shard. Every shard carries the tree on in its own memory, and
compares what is left in blocks.

Distances of unrelated fingerprints crowd about 32, so bands are wide and shards can stay large; near copies that crowd about one point are not
parted by any radius. A shard of more rows than two blocks is therefore cut into numbered blocks by a hash, and every two of its blocks
are a task of their own. No task holds more than two blocks, give or take the spread of the hash.

A shard returns a link from each fingerprint to the smallest one of its component in that shard, never all pairs: a
cluster of m near copies costs m links.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import connected_components, rows_that_stay, stored, whole_text, work_folder

SEED = 42
#: Leaves of the tree on the driver and fingerprints in its sample, at most; and sampled ones for a shard of the size meant.
MAX_LEAVES, MAX_SAMPLE, SAMPLE_PER_LEAF = 1 << 16, 1 << 17, 16
_BLOCK = 512


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a text's word shingles, repeats included: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()  # of bytes: A-Z only, and white space of ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(shingle, len(words))
    first, last = start[: len(words) - k + 1], end[k - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), 1 << 16):
        spans = zip(first[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], np.dtype("<u8"))
        # how often each byte value occurs at each of the eight places, then the bits of the values
        places = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        ones += (np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: ``id, text_hash, fp`` (64 bits, as a signed long). NULL and empty texts have fingerprint zero."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    return rows.select("id", F.xxhash64("t").alias("text_hash"), simhash(F.col("t").cast("binary")).alias("fp"))


def distances(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def split_at(points: np.ndarray, max_bits: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """The vantage point and radius after which the halves cost least; None if every split leaves over 0.9 in one half.

    A half of n points is taken to cost n**1.5, about what the tree comes to on points without clusters.
    """
    best = None
    n = len(points)
    for v in points[np.linspace(0, n - 1, min(tries, n)).astype(np.int64)]:
        within = np.cumsum(np.bincount(distances(points, v), minlength=65 + max_bits))
        inside, outside = within[max_bits : 65 + max_bits], n - within[:65]
        cost = np.where(np.maximum(inside, outside) <= 0.9 * n, inside**1.5 + outside**1.5, np.inf)
        mu = int(np.argmin(cost))
        if np.isfinite(cost[mu]) and (best is None or cost[mu] < best[0]):
            best = cost[mu], v, mu
    return best and best[1:]


def build_tree(sample: np.ndarray, max_bits: int, max_leaves: int = MAX_LEAVES, small: int = SAMPLE_PER_LEAF) -> dict[str, np.ndarray]:
    """Nodes as arrays: vantage point, radius, and the children inside and outside (below zero: ~shard).

    The part that holds most of the sample is split next, until all are ``small``, cannot be parted, or are ``max_leaves``.
    """
    points, radii, inside, outside = [], [], [], []
    shards = 0
    heap = [(-len(sample), 0, sample, None)]
    pushed = 1
    while heap:
        _, _, part, parent = heapq.heappop(heap)
        found = split_at(part, max_bits) if len(part) > small and shards + len(heap) + 2 <= max_leaves else None
        if found:
            here = len(points)
            points.append(found[0])
            radii.append(found[1])
            inside.append(0)
            outside.append(0)
            d = distances(part, found[0])
            for half, children in ((part[d <= found[1] + max_bits], inside), (part[d > found[1]], outside)):
                heapq.heappush(heap, (-len(half), pushed, half, (children, here)))
                pushed += 1
        else:
            here = ~shards
            shards += 1
        if parent:
            parent[0][parent[1]] = here
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return dict(zip(("point", "radius", "inside", "outside"), map(np.array, (points, radii, inside, outside), kinds), strict=True))


def deal(values: np.ndarray, tree: dict[str, np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which value goes to which shard: positions and shards, level by level for all values at once."""
    at, node = np.arange(len(values)), np.zeros(len(values), np.int64)
    if not len(tree["point"]):
        return at, node
    done = []
    while len(at):
        d = distances(values[at], tree["point"][node]).astype(np.int64)
        near, far = d <= tree["radius"][node] + max_bits, d > tree["radius"][node]
        at, node = np.concatenate([at[near], at[far]]), np.concatenate([tree["inside"][node[near]], tree["outside"][node[far]]])
        leaf = node < 0
        done.append((at[leaf], ~node[leaf]))
        at, node = at[~leaf], node[~leaf]
    return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: the smallest position of each component."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def shard_components(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the sorted distinct values the position of the smallest one it is linked to within this shard."""
    label = np.arange(len(values))
    stack = [np.arange(len(values))]
    while stack:
        at = stack.pop()
        part = values[at]
        found = split_at(part, max_bits) if len(at) > 2 * _BLOCK else None
        if found:
            d = distances(part, found[0])
            stack += [at[d <= found[1] + max_bits], at[d > found[1]]]
            continue
        for i in range(0, len(at), _BLOCK):
            for j in range(i, len(at), _BLOCK):
                x, y = np.nonzero(distances(part[i : i + _BLOCK, None], part[None, j : j + _BLOCK]) <= max_bits)
                x, y = at[x + i], at[y + j]
                label = _union(label, x[x < y], y[x < y]) if i == j else _union(label, x, y)
    return label


def dealt_groups(fps: DataFrame, max_bits: int, work: str, shard_rows: int = 8192, block_rows: int = 16384) -> DataFrame:
    """``fp, shard, low, high``: each fingerprint in every group it is compared in; close pairs meet in one at least.

    A group is a shard, or two of the numbered blocks that one of over ``2 * block_rows`` rows is cut into. Groups hold about
    ``2 * block_rows`` at most.
    """
    n = fps.count()
    every = max(1, shard_rows // SAMPLE_PER_LEAF, n // MAX_SAMPLE)
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0) if n > shard_rows else fps.limit(0)
    sample = np.sort(np.array([r[0] for r in sample.toLocalIterator()], np.int64)).view(np.uint64)
    tree = build_tree(sample, max_bits)  # 32 bytes a leaf
    tree = fps.sparkSession.sparkContext.broadcast(tree)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            at, shard = deal(values.view(np.uint64), tree.value, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(values[at]), pa.array(shard)], names=["fp", "shard"])

    dealt = stored(fps.select("fp").mapInArrow(shards, "fp long, shard long"), f"{work}/dealt")
    large = dealt.groupBy("shard").count().where(F.col("count") > 2 * block_rows)
    large = F.broadcast(large.select("shard", F.ceil(F.col("count") / block_rows).alias("k")))  # one row a leaf at most
    placed = dealt.join(large, "shard", "left").withColumn("block", F.pmod(F.xxhash64("fp", F.lit("block")), F.coalesce("k", F.lit(1))))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda b: b != F.col("block"))
    pairs = F.transform(others, lambda b: F.struct(F.least("block", b).alias("low"), F.greatest("block", b).alias("high")))
    alone = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")))
    return placed.select("fp", "shard", F.inline(F.when(F.col("k").isNull(), alone).otherwise(pairs)))


def close_links(fps: DataFrame, max_bits: int, work: str, **sizes: int) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs of distinct ``fp`` at ``max_bits`` bits or fewer."""

    def links(group: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(group["fp"].to_numpy())
        label = shard_components(values.view(np.uint64), max_bits)
        linked = label != np.arange(len(values))
        return pd.DataFrame({"a": values[linked], "b": values[label[linked]]})

    groups = dealt_groups(fps, max_bits, work, **sizes).groupBy("shard", "low", "high")
    return groups.applyInPandas(links, "a long, b long")


def simhash_dedup(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    work: str | None = None,
) -> DataFrame:
    """Per input row: ``id, text_hash, fp, component_id, kept``.

    Fingerprints at ``max_bits`` or fewer differing bits are linked; ``component_id`` is the smallest id that links lead to, the
    row's own included. ``kept`` marks the row with that id; if ids repeat, the one with the smallest text hash.

    Texts are lower-cased A-Z and cut at ASCII white space. Fewer words than a shingle are one shingle; NULL, empty and blank
    texts have fingerprint zero and are linked like any other. NULL ids come last: ``component_id`` is NULL only
    where no row of the component has an id. Rows that repeat id and text are all ``kept`` or none. An empty
    table gives an empty result. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    work = work_folder(spark, work)
    rows = stored(fingerprints(docs, shingle, id_col, text_col), f"{work}/fingerprints")
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash"))
    fps = stored(rows.groupBy("fp").agg(best.alias("best")), f"{work}/distinct")
    links = stored(close_links(fps.select("fp"), max_bits, work), f"{work}/links")
    root = connected_components(links, f"{work}/components")
    label = fps.join(root, fps["fp"] == root["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "best")
    label = stored(label, f"{work}/labels")
    least = stored(label.groupBy("root").agg(F.min("best").alias("best")), f"{work}/least")
    label = label.select("fp", "root").join(least, "root").select("fp", "best")
    return rows.join(label, "fp").select(
        "id",
        "text_hash",
        "fp",
        F.col("best.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows, all columns as they were, whatever their names, one of each component: that with the smallest id.

    NULL, empty and blank texts are one component. Of rows that repeat the id and text that stay, any one does; NULL ids stay only where a
    component has no other. An empty table gives an empty one. Texts of rows that stay are not shuffled (``rows_that_stay``).
    """
    work = work_folder(docs.sparkSession, options.pop("work", None))
    found = simhash_dedup(docs, id_col=id_col, text_col=text_col, work=work, **options)
    return rows_that_stay(docs, found.withColumnRenamed("text_hash", "key"), id_col, F.xxhash64(whole_text(text_col)), work)
