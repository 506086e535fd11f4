"""Benchmark decontamination by SimHash of item-sized windows.

Every benchmark item and every document window of an item's length in words gets a 64-bit
SimHash of its words. Fingerprints are cut into one block more than the radius, so two
within the radius agree in a block; blocks index the items of each length, and a window
looks its blocks up. Candidates within the radius are decided by the exact similarity of
their weighted five-word shingles (a shingle weighs what it counts).

A window can only reach the similarity if it holds a shingle of the item, so windows are
taken around the places where a document has a shingle of any item; this loses none.

The benchmark is a stated query set. It is sent out in blocks of a bounded number of words,
one pass over the documents per block, so its size does not matter for memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, clean_text, documents, importable

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 16
#: Words of benchmark items that are sent out together.
BLOCK_WORDS = 2_000_000

_WORDS = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.arange(64, dtype=np.uint64)
_FILTER_BITS = 22


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-cased words; marks and white space count for nothing."""
    words = _WORDS.findall(text.lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """In order, with repeats; a shorter text is one shingle."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - size + 1, size, np.uint64)
    for n in range(size):
        total = (total ^ words[n:len(words) - size + 1 + n]) * _STEP
        total ^= total >> np.uint64(32)
    return total


def votes(words: np.ndarray) -> np.ndarray:
    """Running sums of the words' bits as +1 and -1; a window's votes are a difference."""
    signs = ((words[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])


def simhash(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=-1, dtype=np.uint64)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger shingle counts."""
    keys, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    mine = np.bincount(place[:len(a)], minlength=len(keys))
    theirs = np.bincount(place[len(a):], minlength=len(keys))
    return float(np.minimum(mine, theirs).sum() / np.maximum(mine, theirs).sum())


class HammingIndex:
    """All fingerprints of a length within ``radius`` of a query of that length.

    One sorted table holds the keys (length, block, bits of the block) of all items.
    """

    def __init__(self, lengths: np.ndarray, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        edges = np.linspace(0, 64, radius + 2).round().astype(np.uint64)
        self.shifts = edges[:-1]
        self.masks = (np.uint64(1) << (edges[1:] - edges[:-1])) - np.uint64(1)
        keys = self._keys(lengths, prints)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], order // len(self.shifts)

    def _keys(self, lengths: np.ndarray, prints: np.ndarray) -> np.ndarray:
        bits = (prints[:, None] >> self.shifts) & self.masks
        named = lengths.astype(np.uint64)[:, None] * np.uint64(256) + np.arange(len(self.shifts), dtype=np.uint64)
        return ((named << np.uint64(32)) | bits).ravel()

    def near(self, lengths: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, distance), the closest first."""
        keys = self._keys(lengths, queries)
        first, last = (np.searchsorted(self.keys, keys, side) for side in ("left", "right"))
        many = last - first
        query = np.repeat(np.arange(len(keys)), many)
        item = self.items[np.arange(len(query)) - np.repeat(np.cumsum(many) - many, many) + first[query]]
        pairs = np.unique(np.stack([query // len(self.shifts), item]), axis=1)
        distance = np.bitwise_count(queries[pairs[0]] ^ self.prints[pairs[1]])
        close = np.flatnonzero(distance <= self.radius)
        close = close[np.argsort(distance[close], kind="stable")]
        return pairs[0][close], pairs[1][close], distance[close]


class Benchmark:
    """A block of items, ready to be looked up."""

    def __init__(self, items: Iterable[tuple[int, str]], radius: int = RADIUS):
        self.items: list[tuple[int, np.ndarray]] = []
        lengths, prints = [], []
        for item_id, text in items:
            words = word_hashes(text)
            if len(words):
                self.items.append((item_id, shingle_hashes(words)))
                lengths.append(len(words))
                prints.append(simhash(votes(words)[-1]))
        self.lengths = np.unique(np.array(lengths, np.int64))
        self.index = HammingIndex(np.array(lengths, np.int64), np.array(prints, np.uint64), radius)
        self.shingles = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s for _, s in self.items)]))
        # Shorter items are one shingle of their own length.
        self.sizes = sorted({min(size, SHINGLE_WORDS) for size in self.lengths.tolist()})
        self.mask = np.zeros(1 << _FILTER_BITS, bool)
        self.mask[self.shingles >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Positions where a shingle of any item begins."""
        found = []
        for size in self.sizes:
            if len(words) < size:
                continue
            own = shingle_hashes(words, size)
            maybe = np.flatnonzero(self.mask[own >> np.uint64(64 - _FILTER_BITS)])
            if len(maybe):
                at = np.searchsorted(self.shingles, own[maybe])
                at[at == len(self.shingles)] = 0
                found.append(maybe[self.shingles[at] == own[maybe]])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def matches(self, text: str, similarity: float) -> list[tuple[int, float, int, int, int]]:
        """(item, similarity, first word, words, distance) of the best window of every item found."""
        words = word_hashes(text)
        hits = self.hits(words)
        if not len(hits):
            return []
        starts, lengths, sizes = [], [], []
        marked = np.zeros(len(words) + 1, np.int64)
        marked[hits + 1] = 1
        before = np.cumsum(marked)
        for size in self.lengths.tolist():
            # A document shorter than the item is compared as it is.
            length = min(size, len(words))
            span = max(1, length - SHINGLE_WORDS + 1)
            # So many shingles of items a similar window must hold.
            inside = before[span:len(words) - length + 1 + span] - before[:len(words) - length + 1]
            own = np.flatnonzero(inside >= similarity * max(1, size - SHINGLE_WORDS + 1))
            starts.append(own)
            lengths.append(np.full(len(own), length))
            sizes.append(np.full(len(own), size))
        start, length, size = (np.concatenate(x) for x in (starts, lengths, sizes))
        if not len(start):
            return []
        sums = votes(words)
        prints = simhash(sums[start + length] - sums[start])
        best: dict[int, tuple[int, float, int, int, int]] = {}
        for at, n, distance in zip(*(x.tolist() for x in self.index.near(size, prints))):
            item_id, theirs = self.items[n]
            if n in best and best[n][1] == 1.0:
                continue
            value = weighted_similarity(
                shingle_hashes(words[start[at]:start[at] + length[at]]), theirs)
            if value >= similarity and (n not in best or value > best[n][1]):
                best[n] = (item_id, value, int(start[at]), int(length[at]), distance)
        return list(best.values())


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about so many words; one block at a time is on the driver."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), clean_text("text"))
             .filter(F.length("text") > 0).orderBy("item_id", "text"))
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += 1 + row["text"].count(" ")
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


_MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                      ("first_word", pa.int64()), ("words", pa.int64()), ("distance", pa.int64())])
_MATCH_COLUMNS = "doc_id long, item_id long, similarity double, first_word long, words long, distance long"


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that it holds: the best window and its similarity.

    NULL and empty texts hold nothing; items without words are in nothing; items with one
    text are found one by one. Repeated documents give repeated rows. A document shorter than
    an item is compared as a whole.
    """
    rows = documents(docs)
    found = None
    for block in _blocks(benchmark, block_words):
        sent = docs.sparkSession.sparkContext.broadcast((block, radius))

        def search(stream: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Benchmark(*sent.value)
            yield from batches(
                ((doc_id.as_py(), *match) for batch in stream
                 for doc_id, text in zip(*batch.columns)
                 for match in index.matches(text.as_py(), similarity)), _MATCHES)

        part = rows.mapInArrow(search, _MATCH_COLUMNS)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], _MATCH_COLUMNS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                  radius: int = RADIUS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` with all their columns, without those that hold an item."""
    importable(docs.sparkSession)
    kept = docs
    place = docs.columns.index("text")
    for block in _blocks(benchmark, block_words):
        sent = docs.sparkSession.sparkContext.broadcast((block, radius))

        def drop(stream: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Benchmark(*sent.value)
            for batch in stream:
                yield batch.filter(pa.array(
                    [not index.matches(text.as_py() or "", similarity) for text in batch.column(place)],
                    pa.bool_()))

        kept = kept.mapInArrow(drop, docs.schema)
    return kept
