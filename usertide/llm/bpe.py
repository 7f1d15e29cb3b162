"""Byte-pair encoding and decoding with a public tokenizer file, in batched numpy merge rounds.

A batch of texts is cut into pieces between white space, and each distinct piece is encoded once. The symbols of all new
pieces lie in one flat array. In a round every word finds its lowest-rank pair, by binary search of its adjacent
pairs in the sorted pair keys, and merges all occurrences of it; words without a known pair are done and leave the array.
A worker keeps the pieces it has seen, up to a bound that only costs time to exceed. Spark's batches of texts are encoded and given back
slice by slice, so that a worker holds the ids and decoded texts of one slice, however long the texts of a batch are.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import whole_text

#: Distinct pieces a worker keeps, and characters handled at once.
MAX_PIECES, MAX_CHARS = 400_000, 1 << 20
#: Characters that split() takes for white space and a regular expression's \s does not.
_CONTROLS = re.compile("[\x1c-\x1f]")
_NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """A tokenizer file with word-end BPE: NFC, white space to blanks, lower case; split by pattern, then bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [x["type"] for x in [*(spec["normalizer"] or {}).get("normalizers", []), *pre]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError("not a tokenizer file of the kind that this encoder reads")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"])
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols])
        self.final = np.array([vocab[s + end] for s in symbols])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in merges])[order]
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added = added
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        names = [""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in (vocab | added).items():
            names[i] = token
        self.names = pa.array(names, pa.string())
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = _Index()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[raw]
        ids[ends - 1] = self.final[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        done_ids, done_words = [], []
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], _NO_RANK)
            rank = np.append(rank, _NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(first, len(word)))
            lowest = np.minimum.reduceat(rank, first)
            live = np.repeat(lowest != _NO_RANK, count)
            take = live & (rank == np.repeat(lowest, count))
            # pairs that overlap, as in "aaa", go from the left: every other one of a run
            run = np.flatnonzero(take)
            if len(run):
                new = np.append(True, np.diff(run) != 1)
                place = np.arange(len(run)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(run))))
                run = run[place % 2 == 0]
                ids = ids.copy()
                ids[run] = self.merged[at[run]]
                keep = np.ones(len(ids), bool)
                keep[run + 1] = False
            else:
                keep = np.ones(len(ids), bool)
            done_ids.append(ids[~live])
            done_words.append(word[~live])
            keep &= live
            ids, word = ids[keep], word[keep]
        ids, word = np.concatenate([[], *done_ids]).astype(np.int32), np.concatenate([[], *done_words]).astype(np.int64)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words))

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces and add them to the table, which the index numbers in this order."""
        words: list[bytes] = []
        counts = np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            if piece.startswith(" "):
                words.append(b"")
                counts[i] = 1
            else:
                found = self.pattern.findall(piece)
                words += [w.encode() for w in found]
                counts[i] = len(found)
        special = [i for i, w in enumerate(words) if not w]
        ids, size = self.merge([w or b" " for w in words])
        ends = np.cumsum(size)
        for i, piece in zip(special, (p for p in pieces if p.startswith(" ")), strict=True):
            ids[ends[i] - 1] = self.added[piece[1:]]
        total = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + total[1:]])

    def pieces(self, text: str) -> list[str]:
        """What lies between white space, after normalisation; special tokens are pieces of their own, marked by a blank before."""
        if self.split_added and "<|" in text and (parts := self.split_added.split(text))[1:]:
            return [p for i, part in enumerate(parts) for p in ([" " + part] if i % 2 else self.pieces(part))]
        if not text.isascii():
            # lower case goes character by character: no special form of sigma at a word's end
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return regex.split(r"\s+", text) if _CONTROLS.search(text) else text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        if len(self.index) > MAX_PIECES:
            self.forget()
        known, numbers, counts = len(self.index), [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = self.pieces(text)
            counts[i] = len(pieces)
            numbers.append(np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces)))
        new = list(self.index)[known:] if len(self.index) > known else []
        if new:
            self.learn(new)
        number = np.concatenate([np.zeros(0, np.int64), *numbers])
        first, size = self.starts[number], np.diff(self.starts)[number]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]
        edges = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return ids, np.diff(edges)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list, joined by blanks as no decoder is named; unknown ids and NULLs leave nothing."""
        size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.fill_null(ids.flatten(), -1).to_numpy(zero_copy_only=False)
        known = (flat >= 0) & (flat < len(self.names))
        size = np.bincount(np.repeat(np.arange(len(ids)), size)[known], minlength=len(ids))
        flat, ends, texts, row = flat[known], np.cumsum(size), [], 0
        while row < len(ids):  # a part at a time, so that Arrow's offsets hold it
            start = ends[row] - size[row]
            last = max(row + 1, int(np.searchsorted(ends, start + MAX_CHARS, side="right")))
            offsets = pa.array(np.append(start, ends[row:last]) - start, pa.int32())
            tokens = self.names.take(pa.array(flat[start : ends[last - 1]]))
            texts.append(pc.binary_join(pa.ListArray.from_arrays(offsets, tokens), " "))
            row = last
        return pa.concat_arrays(texts) if texts else pa.array([], pa.string())


class _Index(dict):
    """Numbers the keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One per worker process."""
    return Bpe(path)


def _encode(texts: pa.Array, path: str) -> pa.ListArray:
    bpe, all_ids, sizes, part, chars = load(path), [], [], [], 0
    for text in texts:
        part.append(text.as_py() or "")
        chars += len(part[-1])
        if chars >= MAX_CHARS:
            ids, size = bpe.encode(part)
            all_ids.append(ids)
            sizes.append(size)
            part, chars = [], 0
    ids, size = bpe.encode(part)
    ids = np.concatenate([*all_ids, ids])
    offsets = np.append(0, np.cumsum(np.concatenate([*sizes, size])))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """All rows in turn, as many at a time as hold ``MAX_CHARS`` bytes, or one that is longer."""
    ends, row = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while row < len(texts):
        start = ends[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(ends, start + MAX_CHARS, side="right")))
        yield texts.slice(row, last - row)
        row = last


def encode(text: Column, path: str) -> Column:
    """The ids of a text, without special tokens around it, as ``array<int>``.

    NULL counts as empty and gives an empty array. White space, of any length, gives no ids. Special tokens that stand
    in a text are encoded as such. ``path`` names the tokenizer file, at the same place on every executor.
    """

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in slices(texts):
                yield _encode(part, path)

    return ids_of(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids, special tokens included. NULL and empty lists give an empty text; ids that the file lacks, nothing."""

    @F.arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        return load(path).decode(lists)

    return text_of(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``id, ids, decoded``, encoded and decoded in one pass through the workers.

    Other columns are ignored, whatever their names; an empty table gives no rows.
    """

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in slices(texts):
                ids = _encode(part, path)
                yield pa.StructArray.from_arrays([ids, load(path).decode(ids)], names=["ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), both(whole_text(text_col)).alias("found"))
    return rows.select("id", "found.ids", "found.decoded")
