"""Benchmark decontamination by winnowing.

Both sides are cut into words. Each k-gram of words has a hash, and of every ``window - k + 1`` k-grams in a row the smallest is
kept as a fingerprint. Any ``window`` words that an item and a document share contain the same k-grams, so they keep the same
smallest one: every shared window is found through a common fingerprint. The fingerprints of a block of the benchmark are a
sorted array of bounded size that is broadcast and joined with those of the documents by search; each hit is extended word by
word to both sides, and the words of every whole shared window are marked. Items shorter than a window are one window and are found
by their whole hash, then compared word by word. A benchmark beyond one block is worked through block by block.

Words are numbered by the block's vocabulary, so two numbers are equal just when the words are; words that no item has are 0,
and only runs of known words are hashed at all.

Defined results: a NULL text, or one without words, has no words, no hits and is clean; so is every document where the benchmark is empty.
Items without words are never found. Items with a NULL id mark words but are not listed; an id that repeats is listed once.
Repeated documents are judged each. All other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import shared
from tallyloft.session import stage

WINDOW = 13
K = 5
# A block of the benchmark: about 30 bytes a word in each Python worker at most.
BLOCK_WORDS = 4_000_000
# Words of documents that are searched at a time, and fingerprint hits extended at a time.
CHUNK_WORDS, CHUNK_HITS = 1 << 20, 1 << 20
SLICE_BYTES = 1 << 23

# Lower-cased letters, digits and all bytes of non-ASCII characters are word bytes; everything else is a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

FOUND = "n_words bigint, n_hit bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words, in slices of bounded length."""
    text = text or b""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        while end < len(text) and _BYTES[text[end]] != 32:
            end += 1
        yield text[start:end].translate(_BYTES).split()
        start = end


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of each k words in a row."""
    out = np.zeros(max(0, len(ids) - k + 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[j:len(ids) - k + 1 + j].astype(np.uint64)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def winnow(ids: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams kept over all windows of known words; 0 separates texts."""
    hashes, span = gram_hashes(ids, k), window - k + 1
    if len(hashes) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    zeros = np.cumsum(np.append(0, ids == 0))
    whole = zeros[window:] == zeros[:-window]  # no separator within the window
    smallest = np.lib.stride_tricks.sliding_window_view(hashes, span)[whole].argmin(axis=1)
    at = np.unique(np.flatnonzero(whole) + smallest)
    return at, hashes[at]


class Block:
    """Items of a benchmark: vocabulary, numbered words and fingerprints."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], k: int, window: int):
        self.k, self.window = k, window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.names = [name for name, _ in items]
        texts, pad = [], np.zeros(window, np.int32)
        for _, words in items:
            texts += [pad, np.array([number(w, len(self.vocabulary) + 1) for w in words], np.int32)]
        self.ids = np.concatenate([*texts, pad]) if texts else pad
        lengths = np.array([len(w) for _, w in items], np.int64)
        starts = np.cumsum(lengths + window) - lengths
        self.item_at = np.repeat(np.arange(len(items)), lengths + window)
        long = np.repeat(lengths >= window, lengths)
        own = self.ids.copy()
        inside = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)]) if len(items) else np.zeros(0, np.int64)
        own[inside[~long]] = 0
        at, hashes = winnow(own, k, window)
        order = np.argsort(hashes, kind="stable")
        self.at, self.hashes = at[order], hashes[order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({int(n) for n in lengths if 0 < n < window}):
            at = starts[lengths == n]
            hashes = np.concatenate([gram_hashes(self.ids[a:a + n], n) for a in at])
            order = np.argsort(hashes, kind="stable")
            self.short[n] = (at[order], hashes[order])

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))

    def search(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Shared windows in ``ids`` (texts apart by 0): positions, item numbers, length."""
        shortest = min([self.window, *self.short])
        known = np.concatenate([[False], ids != 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        runs = edges.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= shortest]
        if not len(runs):
            return
        pad = np.full(self.window, -1)
        where = np.concatenate([pad, *(x for a, b in runs for x in (np.arange(a, b), pad))])
        stream = np.where(where < 0, 0, ids[where])
        reach = self.window - self.k
        at, hashes = winnow(stream, self.k, self.window)
        for p, q in self._pairs(at, hashes, self.at, self.hashes):
            left, right = (self._reach(stream, p, q, reach, step, first) for step, first in ((-1, 1), (1, self.k)))
            same = self._reach(stream, p, q, self.k, 1, 0) == self.k
            for back in range(reach + 1):
                ok = same & (left >= back) & (right >= reach - back)
                if ok.any():
                    yield where[p[ok] - back], self.item_at[q[ok]], self.window
        for n, (starts, own) in self.short.items():
            hashes = gram_hashes(stream, n)
            hashes, at = hashes[np.isin(hashes, own)], np.flatnonzero(np.isin(hashes, own))
            for p, q in self._pairs(at, hashes, starts, own):
                ok = self._reach(stream, p, q, n, 1, 0) == n
                if ok.any():
                    yield where[p[ok]], self.item_at[q[ok]], n

    @staticmethod
    def _pairs(at: np.ndarray, hashes: np.ndarray, starts: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        first, last = np.searchsorted(own, hashes, "left"), np.searchsorted(own, hashes, "right")
        at, first, counts = at[last > first], first[last > first], (last - first)[last > first]
        total = np.cumsum(counts)
        for lo in range(0, int(total[-1]) if len(total) else 0, CHUNK_HITS):
            i = np.arange(lo, min(lo + CHUNK_HITS, int(total[-1])))
            hit = np.searchsorted(total, i, "right")
            yield at[hit], starts[first[hit] + i - (total[hit] - counts[hit])]

    def _reach(self, stream: np.ndarray, p: np.ndarray, q: np.ndarray, most: int, step: int, first: int) -> np.ndarray:
        """How many words in a row are equal from ``first`` words off the pair on, up to ``most``."""
        run, going = np.zeros(len(p), np.int64), np.ones(len(p), bool)
        for j in range(first, first + most):
            a = stream[np.clip(p + step * j, 0, len(stream) - 1)]
            going &= (a != 0) & (a == self.ids[np.clip(q + step * j, 0, len(self.ids) - 1)])
            run += going
        return run


def blocks(benchmark: DataFrame, id_col: str, text_col: str, k: int, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of bounded size; the driver holds one at a time."""
    items, held = [], 0
    for name, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).toLocalIterator():
        words = [w for part in words_of(text and bytes(text)) for w in part]
        if words:
            items.append((name, words))
            held += len(words)
        if held >= block_words:
            yield Block(items, k, window)
            items, held = [], 0
    if items:
        yield Block(items, k, window)


def find(texts: list[bytes | None], spans: list, items: list, block: Block) -> pd.DataFrame:
    """FOUND for each text, with the spans and items found before added."""
    out: list[tuple] = []
    start = 0
    numbered: list[np.ndarray] = []

    def finish(upto: int) -> None:
        lengths = np.array([len(x) for x in numbered], np.int64)
        offsets = np.cumsum(lengths + 1) - lengths - 1
        zero = np.zeros(1, np.int32)
        ids = np.concatenate([y for x in numbered for y in (x, zero)]) if numbered else zero
        hit = np.zeros(len(ids) + 1, np.int64)
        found = [set(items[i] if items[i] is not None else ()) for i in range(start, upto)]
        for at, item, n in block.search(ids):
            np.add.at(hit, at, 1)
            np.add.at(hit, at + n, -1)
            text_no = np.searchsorted(offsets, at, "right") - 1
            for t, i in np.unique(np.stack([text_no, item], axis=1), axis=0).tolist():
                if block.names[i] is not None:
                    found[t].add(block.names[i])
        marked = np.cumsum(hit[:-1]) > 0
        for t, (a, n) in enumerate(zip(offsets.tolist(), lengths.tolist())):
            own = marked[a:a + n]
            for s in spans[start + t] if spans[start + t] is not None else ():
                own[s["start"]:s["end"]] = True
            hits = int(own.sum())
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))).reshape(-1, 2).tolist() if hits else []
            out.append((n, hits, [{"start": x, "end": y} for x, y in edges], sorted(found[t])))

    for i, text in enumerate(texts):
        parts = [block.number(words) for words in words_of(text)]
        numbered.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
        if sum(map(len, numbered[-1:])) >= CHUNK_WORDS or (i - start) % 256 == 255 and sum(map(len, numbered)) >= CHUNK_WORDS:
            finish(i + 1)
            start, numbered = i + 1, []
    finish(len(texts))
    return pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])


def _searcher(block) -> Column:
    @F.pandas_udf(FOUND)
    def search(texts: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        return find(list(texts), list(spans), list(items), block())

    return search


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  k: int = K, window: int = WINDOW, block_words: int = BLOCK_WORDS, name: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``name`` (FOUND): words, hit words, hit spans in word positions, ids of items found."""
    context = docs.sparkSession.sparkContext
    none = F.struct(F.lit(None).cast("array<struct<start: bigint, end: bigint>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    out, passes = docs.withColumn(name, none), 0
    for block in blocks(benchmark, item_col, item_text, k, window, block_words):
        if passes:  # written, so that workers hold one block at a time
            out = stage(out, "contamination")
        out = out.withColumn(name, _searcher(shared(context, block))(F.col(text_col).cast("binary"), f"{name}.spans", f"{name}.items"))
        passes += 1
    if not passes:
        out = out.withColumn(name, _searcher(shared(context, Block([], k, window)))(F.col(text_col).cast("binary"), f"{name}.spans", f"{name}.items"))
    return out


def contaminated(found: Column, share: int = 20) -> Column:
    """Whether the hit words are at least one in ``share`` words."""
    return (found["n_hit"] > 0) & (found["n_hit"] * share >= found["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return contamination(docs, benchmark, name="__found", **options).filter(~contaminated(F.col("__found"))).drop("__found")
