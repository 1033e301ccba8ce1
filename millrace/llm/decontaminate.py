"""Benchmark passages in documents, by SimHash of item-sized windows.

Every item has a 64-bit SimHash of its 5-word shingles. A document is looked at through
windows of as many words as the items have. The fingerprint of a window comes from
running sums, one for each bit. Fingerprints within ``RADIUS`` bits of an item's are all
found: 64 bits are cut into four blocks, one of which then differs in at most a quarter of
the radius, and a table per block holds, for every key within that distance of an item's
block, the items. Candidates are verified by the exact weighted Jaccard similarity of their
shingles, which weighs each shingle with its number of occurrences.

Windows without any shingle of an item have similarity 0 with all of them, so only windows
around such shingles are fingerprinted. Similar windows may differ in more bits than the
radius. They hold at least 4/9 as many places with a shingle of the item as both have
shingles, so windows with that many are candidates whatever their fingerprint is, and no
window that passes is missed.

Items of fewer words than a shingle are found where a document holds just these words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops

SHINGLE = 5
SIMILARITY = (4, 5)
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
ITEMS = 2000  # items held by a task at once; more are taken in turns
ITEM_CHARS = 8 << 20  # characters of their texts, likewise
RUN = 4096  # windows fingerprinted at once


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of one sequence; fewer words than a shingle are one."""
    return textops.shingles(words, min(SHINGLE, len(words))) if len(words) else words[:0]


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    bits = np.unpackbits(textops.mix(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def simhash(shingles: np.ndarray) -> int:
    return int(_fingerprint(_signs(shingles).sum(0)[None])[0])


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(sum of the smaller weights, sum of the larger ones), a shingle's weight being its number."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(n[i], m[j]).sum())
    return least, len(a) + len(b) - least


def _ball(radius: int) -> np.ndarray:
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(BLOCK_BITS), r)]
    return np.array(masks, np.uint64)


class Items:
    """The items of the benchmark, by number of words, with the tables of their fingerprint blocks."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = textops.pack(pa.array(texts, pa.string()))
        data = textops.lower_ascii(data)
        starts, ends, first = textops.words(data, offsets)
        hashes = textops.content_hashes(data, starts, ends)
        self.ids, self.words = ids, np.diff(first)
        self.shingles = [_shingles(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        prints = np.array([simhash(s) if len(s) else 0 for s in self.shingles], np.uint64)
        self.short = {int(n): np.flatnonzero(self.words == n) for n in np.unique(self.words) if 0 < n < SHINGLE}
        self.short_hashes = {n: np.array([self.shingles[i][0] for i in own], np.uint64) for n, own in self.short.items()}
        long = [i for i, n in enumerate(self.words) if n >= SHINGLE]
        held = np.concatenate([*(self.shingles[i] for i in long), np.zeros(0, np.uint64)])
        self.known = np.unique(held)
        ball = _ball(RADIUS // BLOCKS)
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size in sorted({int(w) for w in self.words if w >= SHINGLE}):
            own = np.flatnonzero(self.words == size)
            tables = []
            for block in range(BLOCKS):
                key = (prints[own] >> np.uint64(block * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
                near = (key[:, None] ^ ball).astype(np.int64)
                order = np.argsort(near, axis=None, kind="stable")
                at = np.searchsorted(near.ravel()[order], np.arange((1 << BLOCK_BITS) + 1))
                tables.append((at.astype(np.int32), np.repeat(own, len(ball))[order].astype(np.int32)))
            self.tables[size] = tables
        self.prints = prints

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every fingerprint within the radius of an item of that size."""
        windows, items = [], []
        for block, (at, own) in enumerate(self.tables[size]):
            key = ((prints >> np.uint64(block * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            count = (at[key + 1] - at[key]).astype(np.int64)
            total = np.cumsum(count)
            w = np.repeat(np.arange(len(prints)), count)
            windows.append(w)
            items.append(own[np.arange(len(w)) + np.repeat(at[key] - (total - count), count)])
        w, i = np.concatenate(windows), np.concatenate(items)
        good = np.bitwise_count(prints[w] ^ self.prints[i]) <= RADIUS
        pairs = np.unique(w[good] * len(self.ids) + i[good])
        return pairs // len(self.ids), pairs % len(self.ids)

    def search(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item id, first word, number of words, similarity): the best window of each item that the sequence holds."""
        best: dict[int, tuple[float, int, int]] = {}
        for size, own in self.short.items():
            keys, first = np.unique(textops.shingles(words, size), return_index=True)
            wanted = self.short_hashes[size]
            k = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            for j in np.flatnonzero(keys[k] == wanted) if len(keys) else ():
                best[int(own[j])] = (1.0, int(first[k[j]]), size)
        shingles = _shingles(words)
        at = np.minimum(np.searchsorted(self.known, shingles), max(0, len(self.known) - 1))
        hits = np.flatnonzero(self.known[at] == shingles) if len(self.known) else at[:0]
        if len(hits):
            self._windows(words, shingles, hits, best)
        return [(self.ids[i], s, n, x) for i, (x, s, n) in sorted(best.items())]

    def _windows(self, words: np.ndarray, shingles: np.ndarray, hits: np.ndarray, best: dict[int, tuple[float, int, int]]) -> None:
        sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_signs(shingles), axis=0, dtype=np.int32)))
        for size in self.tables:
            span = max(1, min(size, len(words)) - SHINGLE + 1)  # shingles in a window
            last = len(shingles) - span
            close = np.unique((hits[:, None] - np.arange(span)).ravel())
            close = close[(close >= 0) & (close <= last)]
            pairs = []
            for k in range(0, len(close), RUN):
                start = close[k : k + RUN]
                w, own = self.near(size, _fingerprint(sums[start + span] - sums[start]))
                pairs.append((start[w], own))
            if not pairs:
                continue
            # In order of the windows, so that the first of equally similar ones is named.
            both = np.unique(np.concatenate([s * len(self.ids) + i for s, i in pairs]))
            for s, i in zip((both // len(self.ids)).tolist(), (both % len(self.ids)).tolist(), strict=True):
                least, most = weighted_jaccard(shingles[s : s + span], self.shingles[i])
                if SIMILARITY[1] * least >= SIMILARITY[0] * most and least / most > best.get(i, (0.0,))[0]:
                    best[i] = (least / most, s, min(size, len(words)))


FOUND = "doc_id long, item_id long, first_word int, words int, similarity double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, words, similarity): each item that a document holds, with its best window.

    Texts are compared by words in lower case (A-Z). A window has as many words as the
    item, or all those of a shorter document. Windows of similarity 0.8 whose fingerprint lies
    within ``RADIUS`` bits of the item's are found, all of them; that is more than 0.95 of the windows
    just at 0.8, and nearly all above (``test_recall_of_the_radius``). An item
    of fewer than five words is held where these words follow each other. Null and empty texts and items match
    nothing. A repeated item matches under each of its ids, and repeated documents match
    each. The items are taken in turns of ``ITEMS``, each of them against all documents;
    empty tables give an empty result.
    """
    spark = docs.sparkSession
    ordered = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    held, turns = [], []
    size = 0
    for row in ordered.toLocalIterator():
        held.append(row)
        size += len(row["text"])
        if len(held) == ITEMS or size >= ITEM_CHARS:
            turns.append(held)
            held, size = [], 0
    turns += [held] if held or not turns else []
    out = None
    for turn in turns:
        found = _turn(docs, spark.sparkContext.broadcast(([r["item_id"] for r in turn], [r["text"] for r in turn])))
        out = found if out is None else out.union(found)
    return out


def _turn(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = None
        for piece in textops.slices(batches):
            if items is None:
                items = Items(*shared.value)
            data, offsets = textops.pack(piece.column("text"))
            data = textops.lower_ascii(data)
            starts, ends, first = textops.words(data, offsets)
            hashes = textops.content_hashes(data, starts, ends)
            found = []
            for doc, a, b in zip(piece.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                found += [(doc, *x) for x in items.search(hashes[a:b])]
            columns = zip(*found, strict=True) if found else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "first_word", "words", "similarity"])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item of the benchmark."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti")
