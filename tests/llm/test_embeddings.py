import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """``(id, n_links, component_id, kept)`` per row, by all pairs."""

    def usable(r):
        e = r.embedding
        return r.label is not None and e and None not in e and np.isfinite(e).all() and any(e)

    good = [r for r in rows if usable(r)]
    u = [np.array(r.embedding, float) / np.linalg.norm(r.embedding) for r in good]
    root, degree = list(range(len(good))), [0] * len(good)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(good)):
        for y in range(x):
            if good[x].label == good[y].label and len(u[x]) == len(u[y]) and u[x] @ u[y] >= threshold:
                degree[x] += 1
                degree[y] += 1
                root[find(x)] = find(y)
    least = {}
    for i, r in enumerate(good):
        least.setdefault(find(i), []).append(r.vec_id)
    out = [(r.vec_id, 0, r.vec_id, True) for r in rows if not usable(r)]
    for i, r in enumerate(good):
        first = min((x for x in least[find(i)] if x is not None), default=None)
        out.append((r.vec_id, degree[i], first, r.vec_id == first))
    return sorted(out, key=str)


def clustered(n, dims, seed, spread):
    """Random directions, near copies of some, a dense group, and exact copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = base[: n // 3] + spread * rng.normal(size=(n // 3, dims)) / np.sqrt(dims)
    dense = base[0] + 0.2 * rng.normal(size=(n // 2, dims)) / np.sqrt(dims)
    every = np.concatenate([base, near, dense, base[:5], base[:5] * 1.0]).astype(np.float32)
    return [(i, v.tolist(), i % 2) for i, v in enumerate(every[rng.permutation(len(every))])]


def found(df, **options):
    return sorted((tuple(r) for r in embeddings.near_dedup(df, **options).collect()), key=str)


@pytest.mark.parametrize("dims,spread", [(3, 0.2), (64, 0.3)])
def test_full_reach_finds_every_link(spark, dims, spread):
    df = spark.createDataFrame(clustered(240, dims, 1, spread), SCHEMA)
    assert found(df, reach=1, cell_rows=16, block_rows=64) == brute(df.collect())


def test_default_reach_misses_few_links(spark):
    df = spark.createDataFrame(clustered(600, 64, 2, 0.37), SCHEMA)  # near copies about the threshold
    want = brute(df.collect())
    got = found(df, cell_rows=32)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 1000
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_a_dense_group_is_one_cell_and_many_blocks(spark):
    rng = np.random.default_rng(3)
    u = embeddings.unit(rng.normal(size=64) + 0.1 * rng.normal(size=(500, 64)))
    assert len(embeddings.kmeans(u, 20, 0.93)) == 1
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)], SCHEMA)
    out = found(df, cell_rows=32, block_rows=50)
    assert {r[1:] for r in out} == {(499, 0, True), (499, 0, False)}


def odd_vectors(spark):
    v = [0.6, 0.8, 0.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, [1.2, 1.6, 0.0], 1), (4, [0.61, 0.79, 0.01], 1), (5, v, 2), (6, v, None), (7, None, 1),
        (8, [0.0, 0.0, -0.0], 1), (9, [], 1), (10, [0.6, None, 0.0], 1), (11, [0.6, float("nan"), 0.0], 1), (12, [float("inf"), 0.0, 0.0], 1),
        (None, v, 1), (None, [0.0, 1.0], 7), (13, [0.6, 0.8], 1), (14, [-0.6, -0.8, 0.0], 1), (None, None, None), (15, [3e38, 3e38, 0.0], 3), (16, [1.0, 1.0, -0.0], 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows(spark):
    df = odd_vectors(spark)
    assert found(frames.clashing(df.drop("label")).drop("label").join(df, ["vec_id", "embedding"]).limit(0)) == []
    assert found(df.withColumns({n: F.lit("clash") for n in ("id", "node", "vec", "cell", "n", "dims")}), reach=1) == brute(df.collect())


def test_other_types_and_empty_tables(spark):
    rows = [("b", [1.0, 0.0], "x"), ("a", [2.0, 0.1], "x"), ("c", [1.0, 0.0], "y")]
    df = spark.createDataFrame(rows, "name string, v array<double>, kind string")
    out = embeddings.near_dedup(df, id_col="name", vec_col="v", label_col="kind").collect()
    assert sorted(tuple(r) for r in out) == [("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]
    assert found(df.limit(0).select(F.lit(1).alias("vec_id"), F.col("v").alias("embedding"), F.lit(1).alias("label"))) == []
