"""Hard negatives by threshold joins in the manner of L2AP: partial scores, suffix norms, thresholds that fall until windows fill.

Anchors go to the workers in chunks of bounded size; rows are never shuffled. Of each block of rows a worker makes an
inverted index over the dimensions, heaviest first. A row's posting in a dimension is left out once the norm of what is left
of it, times the largest norm of an anchor, is under the least threshold: such a row's tail alone reaches no
threshold. Rows lie by the number of dimensions indexed, so that a posting list is a leading slice of the block, and scores are accumulated a
few dimensions at a time by products of slices. After each step a pair goes whose partial score plus the product of both remaining
norms is under the anchor's threshold, and so do rows and anchors without pairs. What is left is completed exactly.

Scores are sums of whole numbers below 2^53, so they are exact in double precision, in whatever order they are added. Thresholds start
high, from a bounded sample of rows. Anchors with a window that is not full are searched again under a lower one, at last
under one that no partner can miss. So the sample decides the work only, not the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from usertide.llm._shared import sampled, stored, work_folder
from usertide.llm.embeddings import unpack, vectors

#: Anchors a chunk, their bytes, and sampled rows that first thresholds and the order of dimensions come from.
CHUNK, CHUNK_BYTES, SAMPLE = 4096, 1 << 25, 4096
_BLOCK, _STEP = 2048, 8


def whole_vectors(df: DataFrame, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id, label, dims, norm, vec`` of the rows that take part: components as whole numbers ``floor(scale * x)``, in doubles."""
    schema = "id long, label long, dims int, norm double, vec binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in vectors(batch.column(2), np.float64):
                matrix = np.floor(scale * matrix)
                norm, packed = np.sqrt((matrix * matrix).sum(axis=1)), [row.tobytes() for row in matrix]
                made = [pa.array(np.full(len(at), matrix.shape[1], np.int32)), pa.array(norm), pa.array(packed, pa.binary())]
                kept = [batch.column(c).take(pa.array(at)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=["id", "label", "dims", "norm", "vec"])

    whole = isinstance(df.schema[label_col].dataType, T.IntegralType)
    label = F.col(label_col).cast("long") if whole else F.xxhash64(label_col)
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.mapInArrow(pack, schema)


def matrix_of(packed: list[bytes], width: int, order: np.ndarray) -> np.ndarray:
    """Vectors as a matrix, missing components zero, columns in the order of dimensions."""
    if len({len(p) for p in packed}) <= 1 and packed and len(packed[0]) == 8 * width:
        return unpack(packed, np.float64)[:, order]
    found = np.zeros((len(packed), width))
    for row, p in zip(found, packed, strict=True):
        row[: len(p) // 8] = np.frombuffer(p)
    return found[:, order]


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norm of what follows, for each row and dimension; one more column, of zeros."""
    squares = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1))


def pairs_above(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs whose score is at least the anchor's ``least``: anchors, rows, scores."""
    width = anchors.shape[1]
    a_left, r_left = suffix_norms(anchors) * (1 + 1e-9), suffix_norms(rows)
    # dimensions that are indexed, a row: up to where its tail cannot reach the least threshold by itself
    beyond = r_left * a_left[:, 0].max(initial=0) >= least.min(initial=np.inf)
    indexed = np.where(beyond[:, :-1].any(axis=1), width - beyond[:, -2::-1].argmax(axis=1), 0)
    indexed = np.minimum(-(-indexed // _STEP) * _STEP, width)
    if least.min(initial=np.inf) <= 0:
        indexed[:] = width
    who, them = np.arange(len(anchors)), np.argsort(-indexed, kind="stable")
    depth = indexed[them]
    score = np.zeros((len(who), len(them)))
    for first in range(0, width, _STEP):
        last = min(first + _STEP, width)
        posting = int(np.searchsorted(-depth, -first, "left"))  # rows that are indexed here, a leading slice
        score[:, :posting] += anchors[who, first:last] @ rows[them[:posting], first:last].T
        at = np.minimum(depth, last)
        alive = score + a_left[np.ix_(who, at)] * r_left[them, at] >= least[who, None]
        keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
        if keep_a.mean() < 0.9 or keep_r.mean() < 0.9:
            who, them, depth, score = who[keep_a], them[keep_r], depth[keep_r], score[np.ix_(keep_a, keep_r)]
            alive = alive[np.ix_(keep_a, keep_r)]
        if not len(who) or not len(them) or alive.mean() < 0.02:
            break
    else:
        last = width
    x, y = np.nonzero(alive) if len(who) and len(them) else (np.zeros(0, np.int64),) * 2
    who, them, found = who[x], them[y], []
    for i in range(0, len(who), 1 << 15):
        a, r = who[i : i + (1 << 15)], them[i : i + (1 << 15)]
        found.append(np.einsum("ij,ij->i", anchors[a], rows[r]))
    exact = np.concatenate(found) if found else np.zeros(0)
    good = exact >= least[who]
    return who[good], them[good], exact[good]


class Best:
    """For each of some slots the ``k`` best partners so far: higher score first, ties by smaller id."""

    def __init__(self, k: int):
        self.k, self.slot = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0), np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        slot, score, id = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, id)))
        order = np.lexsort((id, -score, slot))
        slot, score, id = slot[order], score[order], id[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        self.slot, self.score, self.id = slot[rank < self.k], score[rank < self.k], id[rank < self.k]

    def floor(self, slots: int) -> np.ndarray:
        """The worst score kept in slots that are full, minus infinity in others."""
        found = np.full(slots, -np.inf)
        full = np.bincount(self.slot, minlength=slots) >= self.k
        last = np.flatnonzero(np.diff(np.append(self.slot, -1)) != 0)
        found[self.slot[last]] = self.score[last]
        return np.where(full, found, -np.inf)


def search(
    rows: DataFrame, anchors: dict[str, np.ndarray], same: bool, k: int, low: int, high: int, order: np.ndarray
) -> DataFrame:
    """``slot, score, id``: of every task the ``k`` best of each slot, among rows of the same or of another label.

    A slot is a window of scores of an anchor, ``low * bar <= 100 * score <= high * bar``, or any score if there is no bar.
    """
    shared = rows.sparkSession.sparkContext.broadcast((anchors, order))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order = shared.value
        vec, owner, bar = known["vec"], known["owner"], known["bar"]
        best, slots = Best(k), len(owner)
        # slots lie by anchor
        first = np.searchsorted(owner, np.arange(len(vec)))
        count = np.searchsorted(owner, np.arange(len(vec)), "right") - first
        least = known["least"].copy()
        for batch in batches:
            for i in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(i, _BLOCK)
                ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
                block = matrix_of(part.column("vec").to_pylist(), len(order), order)
                a, r, score = pairs_above(vec, block, least)
                fits = (labels[r] == known["label"][a]) & (ids[r] != known["id"][a]) if same else labels[r] != known["label"][a]
                a, r, score = a[fits], r[fits], score[fits]
                # every pair with each slot of its anchor
                pair = np.repeat(np.arange(len(a)), count[a])
                slot = first[a[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(count[a]) - count[a], count[a])
                if not same:
                    within = (low * bar[slot] <= 100 * score[pair]) & (100 * score[pair] <= high * bar[slot])
                    pair, slot = pair[within], slot[within]
                best.add(slot, score[pair], ids[r[pair]])
                # no worse score can enter the full slots of an anchor; a tie may, by its id
                worst = np.full(len(vec), np.inf)
                np.minimum.at(worst, owner, best.floor(slots))
                least = np.maximum(least, np.where(np.isfinite(worst), worst, -np.inf))
        made = [pa.array(best.slot), pa.array(best.score.astype(np.int64)), pa.array(best.id)]
        yield pa.RecordBatch.from_arrays(made, names=["slot", "score", "id"])

    found = rows.select("id", "label", "vec").mapInArrow(task, "slot long, score long, id long")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def filled(rows: DataFrame, slots: dict[str, np.ndarray], falling: list[np.ndarray], path: str, k: int, **options) -> DataFrame:
    """The ``k`` best of every slot: thresholds of anchors fall until all their slots are full; the last ones are final.

    ``slots`` has the anchors (``vec``, ``id``, ``label``) and, for each slot, its anchor (``owner``) and its ``bar``.
    """
    spark, owner = rows.sparkSession, slots["owner"]
    left, found = np.arange(len(owner)), []
    for turn, least in enumerate(falling):
        if not len(left):
            break
        some, here = np.unique(owner[left], return_inverse=True)
        part = {name: slots[name][some] for name in ("vec", "id", "label")}
        part |= {"owner": here, "bar": slots["bar"][left], "least": least[some]}
        out = stored(search(rows, part, k=k, **options), f"{path}-{turn}")
        size = np.zeros(len(left), np.int64)
        for row in out.groupBy("slot").count().collect():  # one for each slot of the chunk
            size[row["slot"]] = row["count"]
        # an anchor with any slot that is not full is searched again whole
        done = np.bincount(here, size < k, len(some))[here] == 0
        done |= turn == len(falling) - 1
        final = pd.DataFrame({"slot": np.flatnonzero(done), "number": left[done]})
        if len(final):
            found.append(out.join(F.broadcast(spark.createDataFrame(final)), "slot").drop("slot"))
        left = left[~done]
    if not found:
        return spark.createDataFrame([], "score long, id long, rank int, number long")
    return reduce(DataFrame.unionByName, found)


def falling_thresholds(anchors: dict[str, np.ndarray], sample: np.ndarray, labels: np.ndarray, share: float, k: int) -> list[np.ndarray]:
    """First thresholds for partners of the same label: where the sample leads one to expect twice ``k`` of them, then its median, then none."""
    first, second = (np.full(len(anchors["id"]), -np.inf) for _ in range(2))
    want = max(1, int(np.ceil(2 * k * share)))
    for i in range(0, len(first), 256):
        score = anchors["vec"][i : i + 256] @ sample.T
        score[anchors["label"][i : i + 256, None] != labels] = -np.inf
        score = np.sort(score, axis=1)[:, ::-1]
        n = np.isfinite(score).sum(axis=1)
        at = np.arange(len(score))
        first[i : i + 256] = np.where(n >= want, score[at, min(want, score.shape[1]) - 1], -np.inf)
        second[i : i + 256] = np.where(n > 0, score[at, np.maximum(n // 2, 1) - 1], -np.inf)
    return [first, np.minimum(first, second), np.full(len(first), -np.inf)]


def hard_negatives(
    df: DataFrame,
    anchor: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    work: str | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of the whole-numbered vectors ``floor(scale * x)``; where lengths differ, missing components are zero.
    Higher scores come first, ties by smaller id. Anchors are the rows whose id meets the condition ``anchor``; their positives are their first ``positives`` other rows of the same label, and for each of these the first ``negatives`` rows of
    other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score`` are returned, ranked from 1. Fewer, if
    there are fewer.

    Rows without an id or a label, and vectors that are NULL, empty, or hold NULL or non-finite components take no part. Of rows that repeat an anchor's id
    the one with the smallest label and vector is the anchor, and no row of that id is its positive; as partners, rows that repeat an id
    count each. Scores must stay below 2^53; a table whose norms allow larger ones is refused. An empty table, or one without
    anchors, gives an empty result. Other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    work = work_folder(spark, work)
    rows = stored(whole_vectors(df, scale, id_col, vec_col, label_col), f"{work}/rows")
    n, width, norm = rows.agg(F.count("*"), F.max("dims"), F.max("norm")).first()
    if n and norm * norm >= 2.0**53:
        raise ValueError("scores would not be exact: vectors too long for this scale")
    share = min(1.0, SAMPLE / max(n, 1))
    sample = rows.where(sampled("id", share)).limit(4 * SAMPLE).orderBy("id", "label", "vec").select("label", "vec").toPandas()
    order = np.arange(width or 0)
    seen = matrix_of(sample["vec"].tolist(), width or 0, order)
    order = np.argsort(-(seen * seen).sum(axis=0), kind="stable")
    seen, labels = seen[:, order], sample["label"].to_numpy(np.int64)

    chosen = rows.where(anchor(F.col("id"))).groupBy("id")
    chosen = stored(chosen.agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.*"), f"{work}/anchors")
    chunks = -(-chosen.count() // max(64, min(CHUNK, CHUNK_BYTES // (8 * max(width or 1, 1)))))
    # by a hash of distinct ids, so that chunks are of about the same size
    chosen = chosen.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(max(chunks, 1))))
    out = []
    for c in range(chunks):
        part = chosen.where(F.col("chunk") == c).orderBy("id").toPandas()
        if not len(part):
            continue
        known = {"vec": matrix_of(part["vec"].tolist(), width, order), "id": part["id"].to_numpy(np.int64), "label": part["label"].to_numpy(np.int64)}
        falling = falling_thresholds(known, seen, labels, share, positives)
        slots = known | {"owner": np.arange(len(part)), "bar": np.zeros(len(part))}
        near = filled(rows, slots, falling, f"{work}/positives-{c}", positives, same=True, low=low, high=high, order=order)
        # at most ``positives`` for each anchor of the chunk
        near = near.orderBy("number", "rank").select("number", "id", "score").toPandas()
        if not len(near):
            continue
        owner, bar = near["number"].to_numpy(np.int64), near["score"].to_numpy(np.float64)
        # windows of an anchor begin at its floor; first a search down to three quarters of the way from there to the lowest end
        bottom, top = np.ceil(low * bar / 100), np.floor(high * bar / 100)
        some, floor, end = bottom <= top, np.full(len(part), np.inf), np.full(len(part), np.inf)
        np.minimum.at(floor, owner[some], bottom[some])
        np.minimum.at(end, owner[some], top[some])
        start = np.where(floor < np.inf, np.ceil(0.25 * floor + 0.75 * end), np.inf)
        slots = known | {"owner": owner, "bar": bar}
        hard = filled(rows, slots, [start, floor], f"{work}/negatives-{c}", negatives, same=False, low=low, high=high, order=order)
        names = pd.DataFrame({"number": np.arange(len(near)), "anchor_id": known["id"][owner], "positive_id": near["id"], "positive_score": near["score"]})
        hard = hard.join(F.broadcast(spark.createDataFrame(names)), "number")
        out.append(hard.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return stored(reduce(DataFrame.unionByName, out), f"{work}/found")
