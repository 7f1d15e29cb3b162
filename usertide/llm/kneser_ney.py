"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Counting. Tasks count the n-grams of their texts and send them, packed by cell, to the task of that cell. A cell is a
square of a grid over (context, suffix): the followers of a frequent context, and the words before a frequent word, are dealt
over a whole row or column of the grid, and yet each context and each suffix is only in as many cells as the grid is wide.
A cell's task adds up its n-grams, writes them as arrays sorted by hash, and sends on what the next lower order needs: the number
of different words before each suffix, and for each context how many followers it has, by count. Orders follow each
other in one job. The driver gets a few totals a cell.

Scoring. Workers map the arrays and look up the distinct n-grams of a batch of texts by binary search. No table of
words or n-grams is broadcast or joined.

The arrays lie in the work folder, which must be a path that all workers can open: a shared file system. Counts
are those of 64-bit hashes of words and n-grams.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import whole_text, work_folder

GRAM, CONTEXT, TOTAL = 0, 1, 2
#: Hashes of the ends of a text. Words are hashed with another seed.
START, END = np.uint64(xxhash.xxh64_intdigest(b"start", 1)), np.uint64(xxhash.xxh64_intdigest(b"end", 1))
#: Tokens counted, or scored, at once, and different words that a worker keeps.
FLUSH, BATCH, MAX_WORDS = 3 << 20, 1 << 20, 300_000
_ROWS = "kind int, part int, blob binary"


def mounted(folder: str) -> str:
    """The folder as a path for open()."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{folder}: the model's arrays need a folder on a mounted shared file system")
    return url.path


class _Words(dict):
    """Numbers of words, and the hash of each number's word."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n


class Reader:
    """Turns texts into token hashes: ``order - 1`` starts, the words, an end."""

    def __init__(self, order: int):
        self.order, self.words = order, _Words()

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in one array, and for each text the number of its words."""
        if len(self.words) > MAX_WORDS:
            self.words = _Words()
        codes = []
        for text in texts:
            found = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
            codes.append(np.fromiter(map(self.words.__getitem__, found), np.int64, len(found)))
        size = np.fromiter(map(len, codes), np.int64, len(codes))
        hashes = np.array(self.words.hashes, np.uint64)
        flat = np.full(int(size.sum()) + self.order * len(texts), START)
        at = 0
        for code in codes:
            at += self.order - 1
            flat[at : at + len(code)] = hashes[code]
            flat[at + len(code)] = END
            at += len(code) + 1
        return flat, size


def fold(words: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of hashes; of one column, itself."""
    out = words[0]
    for w in words[1:]:
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def cell_of(words: list[np.ndarray], grid: int) -> np.ndarray:
    """The cell of n-grams; their context (all words but the last) gives the row, their suffix (but the first) the column."""
    if len(words) == 1:
        return (words[0] % np.uint64(grid * grid)).astype(np.int64)
    g = np.uint64(grid)
    return (fold(words[:-1]) % g * g + fold(words[1:]) % g).astype(np.int64)


def context_part(keys: np.ndarray, grid: int) -> np.ndarray:
    return (keys % np.uint64(grid * grid)).astype(np.int64)


def _pack(columns: list[np.ndarray]) -> bytes:
    raw = np.concatenate([c.astype(np.uint64) for c in columns])
    return len(columns).to_bytes(1, "little") + pa.compress(raw, codec="zstd", asbytes=True) + len(raw).to_bytes(8, "little")


def _unpack(blob: bytes) -> list[np.ndarray]:
    n = int.from_bytes(blob[-8:], "little")
    raw = np.frombuffer(pa.decompress(blob[1:-8], 8 * n, codec="zstd"), np.uint64)
    return np.split(raw, blob[0])


def _parts(kind: int, part: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row for each part, its columns sorted by the first one."""
    order = np.lexsort((columns[0], part))
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for i, j in zip(first, [*first[1:], len(part)], strict=True):
        yield _row(kind, int(part[i]), _pack([c[order[i:j]] for c in columns]))


def _row(kind: int, part: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names=["kind", "part", "blob"]
    )


def summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The sorted distinct keys, where each first was, and the sums of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], order[first], [np.add.reduceat(v[order], first) if len(keys) else v for v in values]


def count_grams(batches: Iterator[pa.RecordBatch], order: int, grid: int) -> Iterator[pa.RecordBatch]:
    """The n-grams of the highest order in each few million tokens, with their counts, by cell."""
    reader = Reader(order)

    def flush(tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(tokens)
        tokens.clear()
        last = np.flatnonzero(flat != START)
        key = fold([flat[last - k] for k in range(order - 1, -1, -1)])
        place = np.argsort(key)
        key = key[place]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.diff(np.append(first, len(key))).astype(np.uint64)
        last = last[place[first]]
        del key, place, first
        words = [flat[last - k] for k in range(order - 1, -1, -1)]
        del flat, last
        yield from _parts(GRAM, cell_of(words, grid), [*words, n])

    held, size = [], 0
    for batch in batches:
        texts, chars = [], 0
        for text in batch.column(0):
            texts.append(text.as_py())
            chars += len(texts[-1])
            if chars >= 4 * BATCH:
                held.append(reader.tokens(texts)[0])
                size += len(held[-1])
                texts, chars = [], 0
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        held.append(reader.tokens(texts)[0])
        size += len(held[-1])
    if size:
        yield from flush(held)


def _save(path: str, array: np.ndarray) -> None:
    """Written beside its place and moved there whole; a repeated task writes the same again."""
    other = f"{path}.{uuid.uuid4().hex}"
    with open(other, "wb") as f:
        np.save(f, array)
    os.replace(other, path)


def merge_order(batches: Iterator[pa.RecordBatch], k: int, order: int, grid: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Add up what came for this part: n-grams of order k, and contexts of order k + 1. Send on what order k - 1 needs."""
    grams, contexts, part = [], [], 0
    for batch in batches:
        for kind, p, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
            if kind.as_py() == TOTAL:
                yield _row(TOTAL, p.as_py(), blob.as_py())
            else:
                part = p.as_py()
                (grams if kind.as_py() == GRAM else contexts).append(_unpack(blob.as_py()))
    if contexts:
        key, *stats = (np.concatenate(c) for c in zip(*contexts, strict=True))
        key, _, stats = summed(key, stats)
        _save(f"{folder}/context{k + 1}-{part}.npy", key)
        _save(f"{folder}/context{k + 1}-{part}-stats.npy", _small(np.stack(stats, 1)))
        yield _row(TOTAL, part, _pack([np.array([CONTEXT, k + 1, part, *[0] * 7])]))
    if not grams:
        return
    columns = [np.concatenate(c) for c in zip(*grams, strict=True)]
    del grams, contexts
    words, counts = columns[:k], columns[k:]
    key, at, counts = summed(fold(words), counts)
    n, raw = counts[0], counts[-1]
    _save(f"{folder}/gram{k}-{part}.npy", key)
    _save(f"{folder}/gram{k}-{part}-n.npy", _small(n))
    if k == 1:
        _save(f"{folder}/gram{k}-{part}-raw.npy", _small(raw))
    of = [np.count_nonzero(n == i) for i in (1, 2, 3, 4)]
    yield _row(TOTAL, part, _pack([np.array([GRAM, k, part, len(n), n.sum(), raw.sum(), *of])]))
    if k == 1:
        return
    words = [w[at] for w in words]
    context, _, stats = summed(fold(words[:-1]), [n, n == 1, n == 2, n >= 3])
    yield from _parts(CONTEXT, context_part(context, grid), [context, *stats])
    # a suffix that begins a text has one word before it, the start: its count is how often it occurs
    left = np.where(words[1] == START, n, 1).astype(np.uint64)
    _, at, counts = summed(fold(words[1:]), [left, raw])
    suffix = [w[at] for w in words[1:]]
    yield from _parts(GRAM, cell_of(suffix, grid), [*suffix, *counts])


def _small(n: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest needs."""
    return n.astype(np.min_scalar_type(n.max()))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals. ``tokens``: of the training texts; ``types``: different ones among them."""

    folder: str
    order: int
    grid: int
    tokens: int = 0
    types: int = 0
    total: int = 0
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    ones: tuple[float, float, float] = (0.0, 0.0, 0.0)
    names: frozenset[str] = frozenset()


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's discounts for counts of 1, 2, and 3 or more.

    Where too few n-grams occur once to four times, an estimate may not lie above 0 and up to the count; it is then half the
    count. So something is always left for unseen words.
    """
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [k - (k + 1) * y * after / n if n else 0.0 for k, n, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(float(d) if 0 < d <= k else k / 2 for k, d in enumerate(found, 1))


def fit(docs: DataFrame, order: int = 2, text_col: str = "text", cells: int | None = None, work: str | None = None) -> Model:
    """Count all texts. ``cells``: tasks to deal the n-grams over, by default the session's shuffle partitions.

    NULL and empty texts count with their end alone. Without rows there are no counts, and every token is as likely.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    folder = mounted(work_folder(spark, work))
    os.makedirs(folder, exist_ok=True)
    cells = cells or int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = max(1, int(np.ceil(np.sqrt(cells))))
    rows = docs.select(whole_text(text_col).cast("binary")).mapInArrow(lambda it: count_grams(it, order, grid), _ROWS)
    for k in range(order, 0, -1):
        rows = rows.repartitionById(grid * grid, F.col("part"))
        rows = rows.mapInArrow(lambda it, k=k: merge_order(it, k, order, grid, folder), _ROWS)
    found = [_unpack(bytes(r.blob))[0] for r in rows.where(F.col("kind") == TOTAL).collect()]  # order x cells
    grams = [f for f in found if f[0] == GRAM]
    totals = {k: sum((f[3:] for f in grams if f[1] == k), np.zeros(7, np.uint64)).tolist() for k in range(1, order + 1)}
    d = {k: discounts(*t[3:]) for k, t in totals.items()}
    types, total, tokens, n1, n2, *_ = totals[1]
    names = frozenset(f"{('gram', 'context')[f[0]]}{f[1]}-{f[2]}" for f in found)
    return Model(folder, order, grid, tokens, types, total, d, (n1, n2, types - n1 - n2), names)


class Tables:
    """A worker's view of a model's arrays; pages are read as they are needed and shared with other workers."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def array(self, name: str) -> np.ndarray:
        if name not in self.open:
            self.open[name] = np.load(f"{self.model.folder}/{name}.npy", mmap_mode="r")
        return self.open[name]

    def find(self, name: str, part: np.ndarray, keys: np.ndarray, values: str, width: int = 1) -> np.ndarray:
        """The values of sorted keys, 0 where a key is absent."""
        out = np.zeros((len(keys), width))
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for i, j in zip(first, [*first[1:], len(part)], strict=True):
            at = order[i:j]
            file = f"{name}-{part[i]}"
            if file in self.model.names:
                known = self.array(file)
                place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                hit = known[place] == keys[at]
                out[at[hit]] = self.array(f"{file}-{values}")[place[hit]].reshape(-1, width)
        return out if width > 1 else out[:, 0]

    def probabilities(self, flat: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the tokens at ``last``: how often each occurs in training, and its probability after what stands before it."""
        m = self.model
        word, where, back = np.unique(flat[last], return_index=True, return_inverse=True)
        part = cell_of([word], m.grid)
        raw = self.find("gram1", part, word, "raw")[back]
        n = self.find("gram1", part, word, "n")
        p = np.full(len(word), 1 / (m.types + 1))
        if m.total:
            d = np.array([0.0, *m.discounts[1]])
            p = (n - d[np.minimum(n, 3).astype(int)]) / m.total + np.dot(d[1:], m.ones) / m.total * p
        p = p[back]
        for k in range(2, m.order + 1):
            words = [flat[last - i] for i in range(k - 1, -1, -1)]
            d = np.array([0.0, *m.discounts.get(k, (0, 0, 0))])
            key, where, back = np.unique(fold(words), return_index=True, return_inverse=True)
            n = self.find(f"gram{k}", cell_of([w[where] for w in words], m.grid), key, "n")[back]
            key, back = np.unique(fold(words[:-1]), return_inverse=True)
            stats = self.find(f"context{k}", context_part(key, m.grid), key, "stats", 4)[back]
            seen = stats[:, 0] > 0
            total = np.where(seen, stats[:, 0], 1)
            p = np.where(seen, (n - d[np.minimum(n, 3).astype(int)] + stats[:, 1:] @ d[1:] * p) / total, p)
        return raw, p


_opened: dict[str, Tables] = {}


def _open(model: Model) -> Tables:
    """A worker keeps the model it has used last."""
    if model.folder not in _opened:
        _opened.clear()
        _opened[model.folder] = Tables(model)
    return _opened[model.folder]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``id, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    ``score`` is the text's log10 probability under the model, ``base_score`` under add-one unigrams; ``n_known`` counts the
    tokens that occur in training. Tokens are the words, lower-cased A-Z and cut at ASCII white space, and an end; so a
    NULL, empty or blank text has one token. Other columns are ignored; repeated rows get the same result each.
    """
    order = model.order

    @F.arrow_udf("struct<n_tokens:long,n_known:long,base_score:double,score:double>")
    def scores(texts: pa.Array) -> pa.Array:
        tables, reader = _open(model), Reader(order)
        out: list[list[np.ndarray]] = [[], [], [], []]

        def flush(part: list[bytes]) -> None:
            flat, size = reader.tokens(part)
            last = np.flatnonzero(flat != START)
            ends = np.cumsum(size + 1)
            known, base, total = (np.zeros(len(last)) for _ in range(3))
            for i in range(0, len(last), BATCH):
                raw, p = tables.probabilities(flat, last[i : i + BATCH])
                known[i : i + BATCH] = raw > 0
                base[i : i + BATCH] = np.log10((raw + 1) / (model.tokens + model.types + 1))
                total[i : i + BATCH] = np.log10(p)
            first = ends - size - 1
            for column, values in zip(out, (np.ones(len(last)), known, base, total), strict=True):
                column.append(np.add.reduceat(values, first) if len(first) else values)

        part, chars = [], 0
        for text in texts:
            part.append(text.as_py())
            chars += len(part[-1])
            if chars >= 4 * BATCH:
                flush(part)
                part, chars = [], 0
        flush(part)
        columns = [np.concatenate(c) for c in out]
        arrays = [pa.array(c.astype(np.int64)) for c in columns[:2]] + [pa.array(c) for c in columns[2:]]
        return pa.StructArray.from_arrays(arrays, names=["n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).alias("id"), scores(whole_text(text_col).cast("binary")).alias("s"))
    return rows.select(
        "id",
        "s.n_tokens",
        "s.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "s.base_score",
        "s.score",
        F.pow(F.lit(10.0), -F.col("s.score") / F.col("s.n_tokens")).alias("perplexity"),
    )
