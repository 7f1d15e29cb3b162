"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of whole documents. Tokens are labelled from them: a token of a toxic document is toxic if its word, or a beginning of it,
occurs in a far larger share of the toxic documents than of the others. On these labelled tokens a chain of two states is
trained: hashed features of a word give the emissions, and transitions say how toxic words stand together. Forward and
backward sums give every token's probability of being toxic; a logistic fit on their sum, maximum and rate gives the document's
score, and neighbouring tokens that are likelier toxic than not make its spans.

A chain step is a 2 x 2 matrix, and products of matrices can be grouped at will: tokens of all texts of a batch
lie in one array, cut into as many strips as a strip has tokens, and all strips advance together. That is exact; the first
token of a text has a matrix that forgets what came before.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import sampled, stored, whole_text, work_folder

#: Hashed features; different tokens that a worker keeps; characters scored at once.
SLOTS, MAX_TOKENS, MAX_CHARS = 1 << 18, 400_000, 4 << 20
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_RESULT = "struct<score:double,spans:array<struct<first:int,end:int,score:double>>>"


def word_of(token: str) -> str:
    """A token without what surrounds its letters and digits, in lower case."""
    return _EDGES.sub("", token).lower()


def beginnings(word: str) -> list[str]:
    """The word itself, and its first letters where there are more."""
    return ["w" + word, *("p" + word[:k] for k in range(4, 9) if len(word) > k)]


def slots(word: str) -> list[int]:
    """The places of a word's features among the weights."""
    found = [*beginnings(word), "s" + word[-3:], "s" + word[-4:], "n" + str(min(len(word), 12)), "b"]
    return [zlib.crc32(f.encode()) % SLOTS for f in found]


class Tokens(dict):
    """Numbers of tokens, with the emission of each number's word: the log odds its features give to toxic."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.emissions = weights, []

    def __missing__(self, token: str) -> int:
        self[token] = n = len(self)
        self.emissions.append(float(self.weights[slots(word_of(token))].sum()))
        return n


@dataclass(frozen=True)
class Crf:
    """Emission weights, transitions (from, to) and first state as logs, and the document's logistic weights."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    document: np.ndarray


def _steps(emissions: np.ndarray, starts: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The matrix of each token, as [from, to, token]."""
    toxic = np.exp(np.clip(emissions, -30, 30))
    step = np.exp(moves)[:, :, None] * np.ones(len(toxic))
    step[:, :, starts] = np.exp(first)[None, :, None]
    step[:, 1] *= toxic
    return step / step.sum((0, 1))


def _forward(step: np.ndarray) -> np.ndarray:
    """The normalised forward sums [state, token] of a row vector through all steps, from equal shares."""
    n = step.shape[2]
    length = max(1, int(np.sqrt(n)))
    strips = -(-n // length)
    # left over places at the end keep the vector as it is
    grid = np.zeros((2, 2, strips * length))
    grid[0, 0], grid[1, 1] = 1, 1
    grid[:, :, :n] = step
    grid = grid.reshape(2, 2, strips, length)
    whole = grid[..., 0].copy()
    for t in range(1, length):
        whole = np.einsum("abs,bcs->acs", whole, grid[..., t])
        whole /= whole.sum((0, 1))
    enter = np.empty((2, strips))
    vector = np.array([0.5, 0.5])
    for s in range(strips):
        enter[:, s] = vector
        vector = vector @ whole[:, :, s]
        vector /= vector.sum()
    out = np.empty((2, strips, length))
    for t in range(length):
        enter = np.einsum("as,abs->bs", enter, grid[..., t])
        enter /= enter.sum(0)
        out[..., t] = enter
    return out.reshape(2, -1)[:, :n]


def marginals(
    emissions: np.ndarray, starts: np.ndarray, moves: np.ndarray, first: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Each token's probability of being toxic; with ``pairs``, how many moves (from, to) within texts are expected."""
    if not len(emissions):
        return np.zeros(0), np.zeros((2, 2)) if pairs else None
    step = _steps(emissions, starts, moves, first)
    forward = _forward(step)
    # backward sums of token t come from the steps after it, last one first, as column vectors
    backward = np.full_like(forward, 0.5)
    if len(emissions) > 1:
        backward[:, :-1] = _forward(step[:, :, :0:-1].transpose(1, 0, 2))[:, ::-1]
    both = forward * backward
    found = both[1] / both.sum(0)
    if not pairs:
        return found, None
    inner = np.flatnonzero(~starts[1:]) + 1
    joint = forward[:, None, inner - 1] * step[:, :, inner] * backward[None, :, inner]
    return found, (joint / joint.sum((0, 1))).sum(2)


def _flat(types: list[str], features: Callable[[str], list[int]], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of all types in one array, and where those of each type begin."""
    flat, ends = array(kind), array("q", [0])
    for t in types:
        flat.extend(features(t))
        ends.append(len(flat))
    return np.frombuffer(flat, flat.typecode), np.frombuffer(ends, np.int64)


def label_tokens(
    types: list[str], docs: list[np.ndarray], toxic: np.ndarray, lift: float = 15.0, share: float = 0.01
) -> np.ndarray:
    """Which types are toxic words: those with a beginning that is ``lift`` times as common, by documents, among the
    toxic ones as among the others, and in ``share`` of them. ``docs``: the types of each document's tokens.
    """
    hashes, begin = _flat(types, lambda t: [xxhash.xxh64_intdigest(b) for b in beginnings(t)], "Q")
    known, ids = np.unique(hashes, return_inverse=True)
    count = np.zeros((2, len(known)), np.int32)
    size = np.diff(begin)
    for found, y in zip(docs, toxic, strict=True):
        found = np.unique(found)
        n = size[found]
        at = np.arange(n.sum()) + np.repeat(begin[found] - (np.cumsum(n) - n), n)
        count[y, np.unique(ids[at])] += 1
    clean, bad = np.bincount(toxic, minlength=2)
    often = (count[1] + 0.5) / (bad + 1) >= lift * (count[0] + 0.5) / (clean + 1)
    marked = often & (count[1] >= max(3, share * bad))
    words = np.fromiter(map(bool, types), bool, len(types))
    return np.logical_or.reduceat(marked[ids], begin[:-1]) & words


def _parts(starts: np.ndarray, most: int = 1 << 17) -> Iterator[slice]:
    """Runs of whole texts of so many tokens at most, or of one text."""
    edges = [*np.flatnonzero(starts).tolist(), len(starts)]
    first = 0
    for last, after in zip(edges, edges[1:], strict=False):
        if after - first > most and last > first:
            yield slice(first, last)
            first = last
    if first < len(starts):
        yield slice(first, len(starts))


def train_chain(types: list[str], of: np.ndarray, starts: np.ndarray, toxic: np.ndarray, rounds: int = 40) -> Crf:
    """Maximum likelihood with a small penalty, by adaptive gradient steps. ``of``: the type of each token.

    Texts are gone through a part at a time, so that memory does not grow with their number.
    """
    place, begin = _flat(types, slots, "i")
    owner = np.repeat(np.arange(len(types), dtype=np.int32), np.diff(begin))
    weights, moves, first = np.zeros(SLOTS), np.zeros((2, 2)), np.zeros(2)
    inner = np.flatnonzero(~starts[1:]) + 1
    moved = np.zeros((2, 2))
    np.add.at(moved, (toxic[inner - 1], toxic[inner]), 1)
    began = np.bincount(toxic[starts], minlength=2)
    seen = np.bincount(of, toxic, len(types))
    past = [np.full_like(x, 1e-6) for x in (weights, moves, first)]
    for _ in range(rounds):
        emissions = np.bincount(owner, weights[place], len(types))
        slope, expected, ones = seen.copy(), np.zeros((2, 2)), 0.0
        for part in _parts(starts):
            p, pairs = marginals(emissions[of[part]], starts[part], moves, first, pairs=True)
            slope -= np.bincount(of[part], p, len(types))
            expected += pairs
            ones += p[starts[part]].sum()
        slopes = (
            np.bincount(place, slope[owner], SLOTS) - 0.05 * weights,
            moved - expected - 0.05 * moves,
            began - np.array([starts.sum() - ones, ones]) - 0.05 * first,
        )
        for x, g, total in zip((weights, moves, first), slopes, past, strict=True):
            total += g * g
            x += 0.5 * g / np.sqrt(total)
    return Crf(weights, moves, first, np.zeros(4))


def document_features(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each text: a constant, and the sum, maximum and rate of its tokens' probabilities."""
    out = np.zeros((len(size), 4))
    out[:, 0] = 1
    some = size > 0
    first = (np.cumsum(size) - size)[some]
    if len(first):
        total = np.add.reduceat(p, first)
        out[some, 1:] = np.stack([np.log1p(total), np.maximum.reduceat(p, first), np.log1p(1000 * total / size[some])], 1)
    return out


def train_document(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small penalty, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [1e-2 * weight.sum() / len(weight)] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend + 1e-9 * np.eye(len(w)), slope)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = 2000,
    max_bytes: int = 64 << 20,
    work: str | None = None,
) -> Crf:
    """Fit on about ``max_docs`` documents of each label at most, chosen by a hash of their id, and of ``max_bytes`` of text for each.

    The sample's labels, a bounded number of rows, are broadcast to find its texts, which are written once; the driver fits on those that
    ``max_bytes`` has room for, whole texts in the order of a hash of theirs. ``learn`` is a
    condition on ``id_col`` that says which rows labels may be learnt from. Rows without an id or a label, and ids whose
    labels contradict each other, are left out; equal texts count once. Without both labels the score is the smoothed share
    of label 1.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        known = known.where(learn)
    y = F.col(label_col).cast("int")
    known = known.groupBy(F.col(id_col).alias("__of")).agg(F.min(y).alias("y"), F.max(y).alias("other")).where("y = other")
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    n = np.array([counts.get(0, 0), counts.get(1, 0)], float)
    part = F.when(F.col("y") == 1, min(1.0, max_docs / max(n[1], 1))).otherwise(min(1.0, max_docs / max(n[0], 1)))
    chosen = known.where(sampled("__of", part))
    texts = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("t"))
    sample = texts.join(F.broadcast(chosen), F.col("__id") == F.col("__of")).groupBy("t").agg(F.max("y").alias("y"))
    sample = sample.select("t", "y", F.xxhash64("t").alias("turn"), F.octet_length("t").alias("size"))
    sample = stored(sample, f"{work_folder(docs.sparkSession, work)}/sample")
    sample = sorted((r.t, r.y) for r in sample.where(_room(sample, max_bytes)).collect())
    toxic = np.array([y for _, y in sample], int)
    if len(set(toxic.tolist())) < 2:
        document = np.array([np.log((n[1] + 1) / (n[0] + 1)), 0, 0, 0])
        return Crf(np.zeros(SLOTS), np.zeros((2, 2)), np.zeros(2), document)
    index = _Numbers()
    of = []
    for text, _ in sample:
        found = text.split()
        of.append(np.fromiter((index[word_of(t)] for t in found), np.int32, len(found)))
    types = list(index)
    marked = label_tokens(types, of, toxic)
    size = np.array([len(x) for x in of])
    flat = np.concatenate(of)
    starts = np.zeros(len(flat), bool)
    starts[(np.cumsum(size) - size)[size > 0]] = True
    tokens = (marked[flat] & np.repeat(toxic == 1, size)).astype(np.int8)
    crf = train_chain(types, flat, starts, tokens)
    place, begin = _flat(types, slots, "i")
    emissions = np.add.reduceat(crf.weights[place], begin[:-1])
    p = [marginals(emissions[flat[x]], starts[x], crf.moves, crf.first)[0] for x in _parts(starts)]
    of_label = np.bincount(toxic, minlength=2)
    weight = (n / n.sum())[toxic] / (of_label / of_label.sum())[toxic]
    document = train_document(document_features(np.concatenate([np.zeros(0), *p]), size), toxic, weight)
    return Crf(crf.weights.astype(np.float32), crf.moves, crf.first, document)


def _room(sample: DataFrame, max_bytes: int) -> Column:
    """A condition for the texts of each label that ``max_bytes`` has room for, by turn; only sizes come to the driver."""
    sizes = sample.select("y", "turn", "size").toPandas().sort_values(["turn", "size"])
    total = sizes["size"].groupby(sizes["y"]).cumsum()
    last = sizes[total > max_bytes].groupby("y")["turn"].min()
    kept = F.lit(True)
    for y, turn in last.items():
        kept = kept & ((F.col("y") != int(y)) | (F.col("turn") < int(turn)))
    return kept


class _Numbers(dict):
    """Numbers the keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Tagger:
    """Scores batches of texts."""

    def __init__(self, crf: Crf):
        self.crf, self.index = crf, Tokens(crf.weights)

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """The score of each text and its spans: character offsets of first and end, and the largest probability."""
        if len(self.index) > MAX_TOKENS:
            self.index = Tokens(self.crf.weights)
        of = []
        for text in texts:
            found = text.split()
            of.append(np.fromiter(map(self.index.__getitem__, found), np.int64, len(found)))
        size = np.fromiter(map(len, of), np.int64, len(of))
        flat = np.concatenate([np.zeros(0, np.int64), *of])
        starts = np.zeros(len(flat), bool)
        first = np.cumsum(size) - size
        starts[first[size > 0]] = True
        p, _ = marginals(np.array(self.index.emissions)[flat], starts, self.crf.moves, self.crf.first)
        score = 1 / (1 + np.exp(-np.clip(document_features(p, size) @ self.crf.document, -30, 30)))
        spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        hit = np.flatnonzero(p > 0.5)
        for i in np.unique(np.searchsorted(first + size, hit, side="right")):
            mine = p[first[i] : first[i] + size[i]]
            last = -2
            for t, token in enumerate(split_offsets(texts[i])):
                if mine[t] > 0.5:
                    if last == t - 1:
                        spans[i][-1] = (spans[i][-1][0], token[1], max(spans[i][-1][2], float(mine[t])))
                    else:
                        spans[i].append((*token, float(mine[t])))
                    last = t
        return score, spans


def split_offsets(text: str) -> list[tuple[int, int]]:
    """Where the pieces of split() lie."""
    out, at = [], 0
    for piece in text.split():
        at = text.index(piece, at)
        out.append((at, at + len(piece)))
        at += len(piece)
    return out


_taggers: dict[int, Tagger] = {}


def score(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``id, score, spans``: the document's probability of label 1 and its toxic spans.

    ``spans`` are runs of tokens likelier toxic than not, with character offsets into the text and the largest
    probability. NULL counts as empty; a text without tokens has no spans and the score of an all-clean one. Repeated rows get the
    same result each. Other columns are ignored, whatever their names.
    """
    key = zlib.crc32(crf.weights.tobytes() + crf.document.tobytes())
    shared = docs.sparkSession.sparkContext.broadcast(crf)  # SLOTS weights

    @F.arrow_udf(_RESULT)
    def tagged(texts: pa.Array) -> pa.Array:
        if key not in _taggers:
            _taggers.clear()
            _taggers[key] = Tagger(shared.value)
        tagger, scores, spans, part, chars = _taggers[key], [], [], [], 0
        for i, text in enumerate(texts, 1):
            part.append(text.as_py())
            chars += len(part[-1])
            if chars >= MAX_CHARS or i == len(texts):
                found = tagger.tag(part)
                scores.append(found[0])
                spans += found[1]
                part, chars = [], 0
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        spans = pa.array([[dict(zip(("first", "end", "score"), s, strict=True)) for s in x] for x in spans], kind)
        return pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0), *scores])), spans], names=["score", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), tagged(whole_text(text_col)).alias("found"))
    return rows.select("id", "found.score", "found.spans")
