"""Near copies among embeddings: spherical k-means cells, blocked cosine products within cells, one representative per group.

Vectors are compared only under one label and of one length. Equal vectors become one entry first, so exact copies cost
nothing. A label with more than ``cell_rows`` entries is cut into cells by spherical k-means, fitted on a bounded sample (``SAMPLE``
entries a cell, ``MAX_CELLS`` cells at most). Every entry has its home cell, the one of the nearest centroid, and visits
those cells whose border is near: with centroids a (home) and b, the border is the plane between them, at distance
(y.a - y.b) / |a - b| from y. Two vectors at the threshold are at most a chord apart. If they have different homes, one of the two is no
further than half the chord from the border, so with ``reach=1`` every pair meets: the one near the border visits the home of the other.
Smaller ``reach`` visits fewer cells and is approximate: in d dimensions the difference of two near copies has only about 1/sqrt(d) of
its length across a border, so that a pair is lost only if that share is ``2 * reach`` or more.

Homes meet homes and visitors, in blocks of ``block_rows`` that Spark deals to tasks by cell and pair of blocks; a crowded cell
is many tasks. A task gives each entry its number of links and one link to the smallest entry of its component there, never
all pairs. Where two entries visit each other's home, the pair counts in the smaller cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.llm._shared import connected_components, sampled, stored, work_folder
from usertide.llm.simhash import _union

#: Cells in all, and sampled entries a cell that k-means is fitted on.
MAX_CELLS, SAMPLE = 1 << 14, 16
_ROUNDS = 10
_CHUNK = 512


def vectors(lists: pa.Array, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a column of lists: positions and matrix, for each length that occurs.

    NULL lists, empty ones, and those with NULL or non-finite components are not usable.
    """
    size = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)  # NULL components become NaN
    start = np.cumsum(size) - size
    for length in np.unique(size[size > 0]):
        at = np.flatnonzero(size == length)
        matrix = flat[start[at, None] + np.arange(length)]
        good = np.isfinite(matrix).all(axis=1)
        yield at[good], matrix[good] + kind(0)  # -0.0 becomes 0.0


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    matrix = matrix.astype(np.float64)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def unpack(packed: pd.Series | list, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1)


def packed_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, type]:
    """Per row ``id, label, dims, digest, vec``: the vector as bytes and its digest, NULL where it takes no part; and the type of number."""
    element = getattr(df.schema[vec_col].dataType, "elementType", T.DoubleType())
    kind = np.float32 if isinstance(element, T.FloatType) else np.float64
    kept = [T.StructField("id", df.schema[id_col].dataType), T.StructField("label", df.schema[label_col].dataType)]
    schema = T.StructType([*kept, T.StructField("dims", T.IntegerType()), T.StructField("digest", T.BinaryType()), T.StructField("vec", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digest, vec = ([None] * batch.num_rows for _ in range(3))
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            for at, matrix in vectors(batch.column(2), kind):
                for i, row in zip(at[known[at]].tolist(), matrix[known[at]], strict=True):
                    if row.any():
                        dims[i], vec[i] = len(row), row.tobytes()
                        digest[i] = hashlib.sha256(vec[i]).digest()
            made = [pa.array(dims, pa.int32()), pa.array(digest, pa.binary()), pa.array(vec, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=schema.names)

    numbers = F.col(vec_col).cast("array<float>" if kind is np.float32 else "array<double>")
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), numbers.alias("vec"))
    return rows.mapInArrow(pack, schema), kind


def kmeans(points: np.ndarray, k: int, too_close: float) -> np.ndarray:
    """At most ``k`` unit centroids. No two are at cosine ``too_close`` or more, so a dense group is not cut up."""

    def apart(centroids: np.ndarray) -> np.ndarray:
        close = np.triu(centroids @ centroids.T >= too_close, 1)
        keep = np.ones(len(centroids), bool)
        for i in range(len(centroids)):
            if keep[i]:
                keep[close[i]] = False
        return centroids[keep]

    centroids = apart(points[:k])
    for _ in range(_ROUNDS):
        home = np.concatenate([(points[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(points), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        size = np.linalg.norm(sums, axis=1)
        centroids = sums[size > 1e-9] / size[size > 1e-9, None]
    return apart(centroids)


def fit_cells(entries: DataFrame, kind: type, threshold: float, cell_rows: int) -> dict[tuple, np.ndarray]:
    """Centroids by (label, length), for those with more than ``cell_rows`` entries.

    Cells are larger where there would be more than ``MAX_CELLS``; so are the numbers of centroids and sampled entries bounded.
    """
    cell_rows = max(cell_rows, -(-entries.count() // MAX_CELLS))
    large = entries.groupBy("label", "dims").agg(F.count("*").alias("rows")).where(F.col("rows") > cell_rows)
    sample = entries.where(sampled("node", SAMPLE / cell_rows)).join(F.broadcast(large), ["label", "dims"])

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        found = kmeans(unit(unpack(part["vec"], kind)), -(-int(part["rows"].iloc[0]) // cell_rows), threshold)
        return pd.DataFrame({"label": part["label"].iloc[0], "dims": part["dims"].iloc[0], "centroid": [c.tobytes() for c in found]})

    label = entries.schema["label"].dataType.simpleString()
    found = sample.groupBy("label", "dims").applyInPandas(fit, f"label {label}, dims int, centroid binary")
    centroids: dict[tuple, list] = {}
    for row in found.collect():  # at most MAX_CELLS, or a few more for the sample
        centroids.setdefault((row["label"], row["dims"]), []).append(row["centroid"])
    return {key: unpack(sorted(packed), np.float64) for key, packed in centroids.items()}


def cells_of(u: np.ndarray, centroids: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which other cells it visits (a matrix of flags)."""
    s = u @ centroids.T
    home = s.argmax(axis=1)
    gap = s[np.arange(len(u)), home][:, None] - s
    apart = np.sqrt(np.maximum(2 - 2 * (centroids[home] @ centroids.T), 0))
    visits = gap <= width * apart
    visits[np.arange(len(u)), home] = False
    return home, visits


def deal(entries: DataFrame, centroids: dict[tuple, np.ndarray], kind: type, width: float) -> DataFrame:
    """Entries by cell: ``node, label, dims, n, vec, cell, home, visits``, once at home and once for each visit."""
    placed = entries.sparkSession.sparkContext.broadcast(centroids)
    added = [T.StructField("cell", T.IntegerType()), T.StructField("home", T.IntegerType()), T.StructField("visits", T.BinaryType())]
    schema = T.StructType([*entries.schema.fields, *added])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dims = batch.column("label").to_pylist(), batch.column("dims").to_pylist()
            vec = batch.column("vec").to_pylist()
            groups: dict[tuple, list] = {}
            for i, key in enumerate(zip(label, dims, strict=True)):
                groups.setdefault(key if key in placed.value else None, []).append(i)
            for key, at in groups.items():
                for i in range(0, len(at), _CHUNK):
                    here = np.array(at[i : i + _CHUNK])
                    if key is None:
                        who, cell, home, lists = here, np.zeros(len(here), np.int32), np.zeros(len(here), np.int32), [b""] * len(here)
                    else:
                        home, visits = cells_of(unit(unpack([vec[r] for r in here], kind)), placed.value[key], width)
                        x, y = np.nonzero(visits)
                        who, cell = np.concatenate([here, here[x]]), np.concatenate([home, y]).astype(np.int32)
                        lists = [np.flatnonzero(v).astype(np.int32).tobytes() for v in visits] + [b""] * len(x)
                        home = np.concatenate([home, home[x]]).astype(np.int32)
                    made = [pa.array(cell, pa.int32()), pa.array(home, pa.int32()), pa.array(lists, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(who)).columns, *made], names=schema.names)

    return entries.mapInArrow(place, schema)


def block_links(part: pd.DataFrame, cell: int, i: int, j: int, kind: type, threshold: float) -> pd.DataFrame:
    """Links between blocks ``i`` and ``j`` of a cell: ``node, n_links, link`` for each entry that has any there."""
    part = part.sort_values(["home", "node"], key=lambda c: (c != cell) if c.name == "home" else c, ignore_index=True)
    u, n = unit(unpack(part["vec"], kind)), part["n"].to_numpy()
    home, block = part["home"].to_numpy(), part["block"].to_numpy()
    lists = [np.frombuffer(v, np.int32) for v in part["visits"]]
    wide = 1 + max(int(home.max()), max((int(v.max()) for v in lists if len(v)), default=0))
    visited = np.concatenate([k * wide + v for k, v in enumerate(lists)]) if lists else np.zeros(0, np.int64)
    at_home = np.flatnonzero(home == cell)
    degree, label = np.zeros(len(part), np.int64), np.arange(len(part))
    for side, other in ((i, j), (j, i))[: 1 + (i != j)]:
        rows = at_home[block[at_home] == side]
        # homes of both blocks meet once, seen from the first; visitors meet the homes of the other block
        partners = np.flatnonzero((block == other) & ((home != cell) | (side == i)))
        for first in range(0, len(rows), _CHUNK):
            here = rows[first : first + _CHUNK]
            for second in range(0, len(partners), 8 * _CHUNK):
                there = partners[second : second + 8 * _CHUNK]
                x, y = np.nonzero(u[here] @ u[there].T >= threshold)
                x, y = here[x], there[y]
                once = (x < y) if i == j else np.ones(len(x), bool)
                once &= ~((home[y] < cell) & np.isin(x * wide + home[y], visited))
                x, y = x[once], y[once]
                degree += np.bincount(x, n[y], len(part)).astype(np.int64) + np.bincount(y, n[x], len(part)).astype(np.int64)
                label = _union(label, x, y)
    node, linked = part["node"].to_numpy(), degree > 0
    return pd.DataFrame({"node": node[linked], "n_links": degree[linked], "link": node[label[linked]]})


def cell_links(dealt: DataFrame, kind: type, threshold: float, block_rows: int) -> DataFrame:
    """``node, n_links, link`` of every block pair of every cell; cells with more than ``block_rows`` entries have several."""
    key = ["label", "dims", "cell"]
    crowded = dealt.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > block_rows)
    # only cells of k-means can be crowded, or labels that are one cell: MAX_CELLS rows at most
    rows = dealt.join(F.broadcast(crowded), key, "left")
    blocks = F.ceil(F.coalesce("rows", F.lit(1)) / block_rows).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return block_links(part, key[2], key[3], key[4], kind, threshold)

    rows = rows.select(*key, "i", "j", "node", "n", "vec", "home", "visits", "block")
    return rows.groupBy(*key, "i", "j").applyInPandas(compare, "node long, n_links long, link long")


def near_dedup(
    df: DataFrame,
    threshold: float = 0.93,
    reach: float = 0.35,
    cell_rows: int = 512,
    block_rows: int = 4096,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    work: str | None = None,
) -> DataFrame:
    """Per input row: ``id, n_links, component_id, kept``.

    Vectors of equal label and length are linked at a cosine of ``threshold`` (above 0) or more. ``n_links`` counts the other
    rows linked directly, equal vectors among them; ``component_id`` is the smallest id that links lead to, the row's own included;
    ``kept`` marks the representative, whose id that is. ``reach`` of 1 finds every link; see the module for less.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and those without a label, link with nothing: no links, their own
    id, kept. NULL ids come last: ``component_id`` is NULL only where no row of the component has an id. Rows that repeat id and
    vector count as two linked rows and are ``kept`` alike. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    work = work_folder(spark, work)
    rows, kind = packed_vectors(df, id_col, vec_col, label_col)
    rows = stored(rows, f"{work}/rows")
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id")).alias("best")
    entries = rows.where("digest is not null").groupBy("label", "dims", "digest").agg(best, F.count("*").alias("n"), F.first("vec").alias("vec"))
    entries = stored(entries.withColumn("node", F.monotonically_increasing_id()), f"{work}/entries")

    points = entries.select("node", "label", "dims", "n", "vec")
    centroids = fit_cells(points, kind, threshold, cell_rows)
    width = reach * float(np.sqrt(2 - 2 * threshold)) / 2
    dealt = stored(deal(points, centroids, kind, width), f"{work}/dealt")
    links = stored(cell_links(dealt, kind, threshold, block_rows), f"{work}/links")

    degree = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    root = connected_components(links.select(F.col("node").alias("a"), F.col("link").alias("b")), f"{work}/components")
    found = entries.select("node", "label", "dims", "digest", "n", "best").join(degree, "node", "left").join(root, "node", "left")
    found = stored(found.withColumn("root", F.coalesce("root", "node")), f"{work}/found")
    least = found.groupBy("root").agg(F.min("best").alias("least"))
    found = found.join(least, "root").select(
        "label", "dims", "digest", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least.id"
    )
    found = found.withColumnRenamed("id", "component_id")
    joined = rows.drop("vec").join(found, ["label", "dims", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
