import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import simhash
from usertide.llm._shared import connected_components


def brute_print(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(prints, max_bits=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    v = np.array(prints, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= max_bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def test_fingerprints(spark):
    texts = [*frames.ODD_TEXTS, "a b c a b c a b c", "A B C A b c a b\x0bc"]
    got = simhash.fingerprints(frames.clashing(frames.docs(spark, texts))).orderBy("id").collect()
    assert [r.fp % 2**64 for r in got] == [brute_print(t) for t in texts]


def clustered(n, seed):
    """Random points, chains of near ones, and a dense cluster."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    one = np.uint64(1)
    near = base[: n // 2] ^ (one << rng.integers(0, 64, n // 2, dtype=np.uint64)) ^ (one << rng.integers(0, 64, n // 2, dtype=np.uint64))
    dense = base[0] ^ np.bitwise_or.reduce(one << rng.integers(0, 12, (2, n), dtype=np.uint64))
    return np.unique(np.concatenate([base, near, near ^ (one << np.uint64(5)), dense]))


def test_shards_hold_every_close_pair():
    points = clustered(1500, 1)
    for leaves in (1, 16, 64):
        tree = simhash.build_tree(points[::3], 3, leaves)
        assert len(tree["point"]) < leaves
        at, shard = simhash.deal(points, tree, 3)
        where = [set() for _ in points]
        for a, s in zip(at.tolist(), shard.tolist(), strict=True):
            where[a].add(s)
        assert all(where)
        for i in range(len(points)):
            for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3):
                assert where[i] & where[int(j)]


def test_components_within_a_shard(monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    points = clustered(1200, 2)
    label = simhash.shard_components(points, 3)
    want = brute_components(points.tolist())
    assert len(set(zip(label.tolist(), want, strict=True))) == len(set(label.tolist())) == len(set(want))


def test_links_over_shards_give_the_components(spark, tmp_path):
    points = clustered(1500, 3)
    fps = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    links = simhash.close_links(fps, 3, str(tmp_path / "links"), shard_rows=100, block_rows=200)
    root = {r.node: r.root for r in connected_components(links, str(tmp_path)).collect()}
    got = [root.get(int(x), int(x)) for x in points.view(np.int64)]
    want = brute_components(points.tolist())
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def crowded(n, seed, bits=24):
    """Fingerprints about one point: many are close to each other, and no radius parts them well."""
    rng = np.random.default_rng(seed)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, bits, (4, 3 * n), dtype=np.uint64))
    return np.unique(rng.integers(0, 2**64, 1, dtype=np.uint64) ^ flips)[:n]


def test_no_group_is_large_and_links_stay_whole(spark, tmp_path):
    rng = np.random.default_rng(4)
    kinds = {"random": rng.integers(0, 2**64, 8000, dtype=np.uint64), "crowded": crowded(4000, 5)}
    for kind, points in kinds.items():
        fps = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
        groups = simhash.dealt_groups(fps, 3, str(tmp_path / kind), shard_rows=256, block_rows=512)
        sizes = [r["count"] for r in groups.groupBy("shard", "low", "high").count().collect()]
        assert max(sizes) <= 1.25 * 1024 and len(sizes) > 8
        links = simhash.close_links(fps, 3, str(tmp_path / f"{kind}-links"), shard_rows=256, block_rows=512)
        root = {r.node: r.root for r in connected_components(links, str(tmp_path / f"{kind}-roots")).collect()}
        got = [root.get(int(x), int(x)) for x in points.view(np.int64)]
        if kind != "random":
            want = brute_components(points.tolist())
            assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def near_texts():
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(words)
    return [base, " ".join([*words[:-1], "other"]), " ".join(["first", *words[1:]]), "a b c d", "A  b\tc d", "quite another text here"]


def test_equals_brute_force_with_odd_rows(spark):
    texts = [*near_texts(), *frames.ODD_TEXTS]
    got = simhash.simhash_dedup(frames.clashing(frames.docs(spark, texts, first=100))).orderBy("id").collect()
    prints = [brute_print(t) for t in texts]
    assert [r.fp % 2**64 for r in got] == prints
    assert [r.component_id - 100 for r in got] == brute_components(prints)
    assert [r.kept for r in got] == [r.id == r.component_id for r in got]
    assert got[0].component_id == got[1].component_id == got[2].component_id == 100


def test_null_and_repeated_ids(spark):
    df = frames.odd(spark)
    out = simhash.simhash_dedup(df).collect()
    assert len(out) == df.count()
    blank = {r.component_id for r in out if r.fp == 0}
    assert blank == {0}  # NULL, empty and blank texts are linked, the NULL id among them
    kept = simhash.drop_near_copies(frames.clashing(df))
    assert kept.columns == frames.clashing(df).columns
    assert kept.count() == len(set(brute_components([r.fp % 2**64 for r in out])))
    assert simhash.simhash_dedup(frames.docs(spark, [])).count() == 0
    assert simhash.drop_near_copies(frames.docs(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark, tmp_path):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*chain[::-1], *star, (7, 7), (None, 3), (5000, 4000), (4500, 5000)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges, str(tmp_path)).collect()}
    assert {got[i] for i in range(1, 201)} == {0} and {got[1000 + i] for i in range(1, 300)} == {1000}
    assert got[5000] == got[4500] == 4000 and 0 not in got
    none = connected_components(edges.where(F.lit(False)), str(tmp_path / "none"))
    assert none.count() == 0
