import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from usertide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, share=20, heads_below=4):
    """The trie built node by node."""
    said = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            said[r.conv_id].append(((r.turn is not None, r.turn or 0, turn_digest(role, text)), role, text))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in said.items()}
    members, whole = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads_below
        base = c - (abs(c) % share) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[b] for b in children[node]]
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        ends = sorted(c for c in members[node] if len(whole[c]) == len(node))
        out[node] = (
            min(members[node]),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(members[node]),
            len(below),
            sum(b[5] for b in below) or 1,
            sum(b[6] for b in below) + (len(members[node]) - 1) * words,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **options).collect()), key=str)


def conversations(spark, seed=1, n=160):
    """Few different turns, so that prefixes are shared, and lengths from one to nine."""
    rows = []
    for c in range(n):
        for t in range(1 + c * c % 9):
            kind = (c * 7 + t * t * seed) % (3 if t < 3 else 11)
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {kind} says " + "word " * (kind % 4)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 5])
def test_equals_brute_force(spark, seed):
    df = conversations(spark, seed)
    assert found(df.repartition(7)) == brute(df.collect())


def test_the_sketch_decides_the_work_only(spark, monkeypatch):
    df = conversations(spark, 2)
    want = brute(df.collect())
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    for width in (16, 256, 1 << 12):  # nothing is proven; some; nearly all
        monkeypatch.setattr(prefix_trie, "MIN_WIDTH", width)
        assert found(df, max_width=width) == want


def test_long_conversations_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(c, t, "user", f"t{t % 5}" if t < 30 - c else f"own {c} {t}") for c in (1, 2, 21, 45) for t in range(40 - c // 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(df.collect())


def odd(spark):
    rows = [
        (0, 0, "user", "a b"), (0, 1, "assistant", "c"), (0, None, None, None), (0, None, "user", "first"), (0, None, "user", "first"), (20, 3, "user", ""), (20, 3, "assistant", ""),
        (20, 3, "user", "tie"), (21, -5, "user", "x" * 100_000), (22, 1, "user", " \t\n "), (23, 1, "us", "er:x"), (24, 1, "user", ":x"), (-3, 0, "user", "a b"), (-20, 0, "user", "a b"),
        (41, 0, None, "no base"), (None, 0, "user", "nobody"), (22, 2, "user", "日本語 テスト x"), (7, 5_000_000_000, "user", "late"), (7, 2, "user", "early"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows(spark):
    df = odd(spark)
    extra = {n: F.lit("clash") for n in ("c", "p", "block", "digest", "words", "last", "k1", "node", "bucket", "depth")}
    assert found(df.withColumns(extra)) == brute(df.collect())
    everyone = brute(df.collect())
    assert sum(r[1] == 0 for r in everyone) == 1


def test_empty_table_has_no_root(spark):
    assert found(conversations(spark).limit(0)) == []
    assert found(odd(spark).where("conv_id is null")) == []


def test_ids_of_one_key_go_through_the_hash_in_order(spark):
    ids = spark.range(5000).selectExpr("id % 3 as k", "id * 7919 % 5003 - 100 as c").repartition(5)
    got = {r.k: r.ends_sha256 for r in prefix_trie.joined_ids(ids, "k", "c").collect()}
    for k in range(3):
        mine = sorted(i * 7919 % 5003 - 100 for i in range(5000) if i % 3 == k)
        assert got[k] == hashlib.sha256(",".join(map(str, mine)).encode()).hexdigest()
