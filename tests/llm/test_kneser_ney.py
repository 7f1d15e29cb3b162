import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import kneser_ney


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", text), "</s>"]


class Brute:
    """The same model from dictionaries, token by token."""

    def __init__(self, texts, order):
        self.order, self.raw = order, Counter()
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for text in texts:
            found = tokens(text)
            self.raw.update(found)
            padded = ["<s>"] * (order - 1) + found
            for i in range(order - 1, len(padded)):
                self.counts[order][tuple(padded[i - order + 1 : i + 1])] += 1
        for k in range(order - 1, 0, -1):
            for gram, n in self.counts[k + 1].items():
                self.counts[k][gram[1:]] += n if gram[1] == "<s>" else 1
        self.tokens, self.types = sum(self.raw.values()), len(self.raw)
        self.discounts, self.contexts = {}, {}
        for k in range(1, order + 1):
            of = Counter(self.counts[k].values())
            self.discounts[k] = kneser_ney.discounts(of[1], of[2], of[3], of[4])
            self.contexts[k] = defaultdict(lambda: [0, 0, 0, 0])
            for gram, n in self.counts[k].items():
                self.contexts[k][gram[:-1]][0] += n
                self.contexts[k][gram[:-1]][min(n, 3)] += 1

    def p(self, before, word):
        p = 1 / (self.types + 1)
        for k in range(1, self.order + 1):
            context = tuple(before[len(before) - k + 1 :])
            if context in self.contexts[k]:
                total, *ns = self.contexts[k][context]
                n, d = self.counts[k][(*context, word)], (0, *self.discounts[k])
                p = (n - d[min(n, 3)] + p * sum(a * b for a, b in zip(d[1:], ns, strict=True))) / total
        return p

    def score(self, text):
        found = tokens(text)
        padded = ["<s>"] * (self.order - 1) + found
        ps = [self.p(padded[i - self.order + 1 : i], padded[i]) for i in range(self.order - 1, len(padded))]
        base = [math.log10((self.raw[w] + 1) / (self.tokens + self.types + 1)) for w in found]
        return len(found), sum(self.raw[w] > 0 for w in found), sum(base), sum(map(math.log10, ps))


TRAIN = [
    "the cat sat on the mat",
    "The dog sat on the log",
    "a cat and a dog and a cat",
    "the cat sat on the dog",
    "on on on on",
    *frames.ODD_TEXTS[:8],
]
NEW = ["the cat sat", "unknown words only", "a dog on the mat and an owl", "", None, "THE\x0bCAT", *frames.ODD_TEXTS]


@pytest.mark.parametrize("order,cells", [(2, 1), (2, 9), (3, 5), (4, 4)])
def test_equals_the_model_by_hand(spark, order, cells):
    model = kneser_ney.fit(frames.clashing(frames.docs(spark, TRAIN).repartition(4)), order=order, cells=cells)
    brute = Brute(TRAIN, order)
    assert (model.tokens, model.types) == (brute.tokens, brute.types)
    got = kneser_ney.score(frames.clashing(frames.docs(spark, TRAIN + NEW)), model).orderBy("id").collect()
    for row, text in zip(got, TRAIN + NEW, strict=True):
        n, known, base, score = brute.score(text)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, brute.tokens)
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(score)
        assert row.perplexity == pytest.approx(10 ** (-score / n))


def test_probabilities_sum_to_one():
    brute = Brute(TRAIN, 3)
    for before in (("<s>", "<s>"), ("the", "cat"), ("never", "seen"), ("x", "the")):
        assert sum(brute.p(before, w) for w in [*brute.raw, "unknown"]) == pytest.approx(1)


def test_small_batches_change_nothing(spark, monkeypatch):
    reader = kneser_ney.Reader(2)
    flat, size = reader.tokens([b"a b", b"", b"A"])
    assert size.tolist() == [2, 0, 1] and len(flat) == 9 and (flat == kneser_ney.END).sum() == 3
    monkeypatch.setattr(kneser_ney, "MAX_WORDS", 1)
    again = kneser_ney.Reader(2)
    again.tokens([b"x y z"])
    assert np.array_equal(again.tokens([b"a b", b"", b"A"])[0], flat)


def test_without_training_texts(spark):
    model = kneser_ney.fit(frames.docs(spark, []), order=2)
    got = kneser_ney.score(frames.odd(spark), model).collect()
    assert len(got) == frames.odd(spark).count()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert kneser_ney.score(frames.docs(spark, []), model).count() == 0


def test_held_out_texts_are_likelier_than_under_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = kneser_ney.score(docs.where(out), kneser_ney.fit(docs.where(~out), order=2))
    row = scored.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row.s > 0.9 * row.b


def test_needs_a_folder_that_workers_can_map():
    with pytest.raises(ValueError):
        kneser_ney.mounted("hdfs://somewhere/work")
    assert kneser_ney.mounted("file:///a/b") == "/a/b"
