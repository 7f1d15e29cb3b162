import numpy as np
import pytest

from tests.llm import frames
from usertide.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=5, low=80, high=100):
    """All pairs, by whole-number arithmetic."""
    good = [r for r in rows if r.vec_id is not None and r.label is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    q = [[int(np.floor(256 * float(np.float64(x)))) for x in r.embedding] for r in good]
    out, seen = [], set()
    for a in sorted(range(len(good)), key=lambda i: (good[i].vec_id, good[i].label, np.array(q[i], float).tobytes())):
        if good[a].vec_id % every or good[a].vec_id in seen:
            continue
        seen.add(good[a].vec_id)
        scored = [(-sum(x * y for x, y in zip(q[a], q[b], strict=False)), good[b].vec_id, good[b].label) for b in range(len(good))]
        near = sorted(s for s in scored if s[2] == good[a].label and s[1] != good[a].vec_id)[:k]
        for p in near:
            hard = sorted(s for s in scored if s[2] != good[a].label and low * -p[0] <= 100 * -s[0] <= high * -p[0])[:k]
            out += [(good[a].vec_id, p[1], i + 1, s[1], -p[0], -s[0]) for i, s in enumerate(hard)]
    return sorted(out)


def found(df, every, **options):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, lambda i: i % every == 0, **options).collect())


def vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    points = centres[rng.integers(0, 6, n)] * 0.5 + rng.normal(size=(n, dims))
    points *= np.geomspace(1, 0.01, dims)[rng.permutation(dims)]  # some dimensions weigh much more
    return [(i, (v / 8).astype(np.float32).tolist(), int(rng.integers(0, labels))) for i, v in enumerate(points)]


@pytest.mark.parametrize("dims,seed", [(5, 1), (64, 2)])
def test_equals_brute_force_under_any_cut(spark, monkeypatch, dims, seed):
    df = spark.createDataFrame(vectors(400, dims, seed), SCHEMA)
    want = brute(df.collect(), 10)
    assert len(want) > 100
    assert found(df, 10) == want
    # several chunks, small blocks, and a sample that says next to nothing
    monkeypatch.setattr(hard_negatives, "CHUNK", 1)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 20)
    monkeypatch.setattr(hard_negatives, "_BLOCK", 32)
    assert found(df.where("vec_id % 10 > 0 or vec_id < 100"), 10) == brute(df.where("vec_id % 10 > 0 or vec_id < 100").collect(), 10)


def test_pairs_above_prunes_but_loses_none():
    rng = np.random.default_rng(3)
    for least in (-np.inf, 0.0, 40.0, 400.0, 4000.0, np.inf):
        anchors, rows = (np.floor(rng.normal(size=(n, 21)) * np.geomspace(20, 0.1, 21)) for n in (30, 70))
        a, r, score = hard_negatives.pairs_above(anchors, rows, np.full(30, least))
        want = anchors @ rows.T
        assert sorted(zip(a.tolist(), r.tolist(), strict=True)) == sorted(zip(*(x.tolist() for x in np.nonzero(want >= least)), strict=True))
        assert (score == want[a, r]).all()


def test_few_rows_are_in_the_index_of_high_thresholds(monkeypatch):
    rows = np.concatenate([np.full((50, 16), 1.0), np.full((3, 16), 50.0)])
    anchors = np.full((4, 16), 10.0)
    a, r, _ = hard_negatives.pairs_above(anchors, rows, np.full(4, 5000.0))
    assert set(r.tolist()) == {50, 51, 52} and len(a) == 12


def odd(spark):
    v = [0.5, 0.25]
    rows = [
        (0, v, 1), (0, v, 1), (0, [0.1, 0.9], 2), (1, v, 1), (1, v, 1), (2, [0.4, 0.2], 1), (3, v, 2), (3, v, 2), (4, [0.4, 0.25], 2), (5, [0.45, 0.2, 9.0], 3),
        (10, [-0.5, 0.0], 1), (11, [0.5, 0.0], 1), (20, [0.0, 0.0], 2), (None, v, 1), (6, v, None), (7, None, 1), (8, [None, 1.0], 1), (9, [float("nan"), 1.0], 1),
        (12, [float("inf"), 1.0], 2), (13, [], 1), (30, [0.5], 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows(spark):
    df = odd(spark)
    want = brute(df.collect(), 10)
    assert {r[0] for r in want} >= {0, 20}
    assert found(df, 10) == want
    kept = df.select("vec_id", "embedding", df.label.alias("label"))
    assert found(frames.clashing(kept).drop("label").crossJoin(spark.range(0)).selectExpr("vec_id", "embedding", "1 as label"), 10) == []


def test_tables_without_rows_or_anchors_and_long_vectors(spark):
    df = odd(spark)
    assert found(df.where("vec_id < 0"), 10) == []
    assert found(df.where("vec_id in (1, 2, 3)"), 10) == []
    huge = spark.createDataFrame([(0, [1e9, 1e9], 1)], SCHEMA)
    with pytest.raises(ValueError, match="exact"):
        found(huge, 10)
