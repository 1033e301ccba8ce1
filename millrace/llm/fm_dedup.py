"""Removal of long word passages that an earlier document has, by a compressed FM-index.

A shard holds the segments (``passages``) of some anchors. Its index is the Burrows-Wheeler
transform of their words in a wavelet tree of packed bits, with the smallest document of
any interval. The documents are streamed against it from their last word to the first:
backward search extends the match by a word, and where no earlier document has the longer
string, the match is cut back to the next shorter one that others share. That gives, for
every word, the length of the longest string starting there that an earlier document has
(its matching statistic). Windows whose statistic reaches the threshold are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.passages import Windows, by_anchor, contents, finer_pieces, index_rows, indexed, live_segments, loose_windows, open_anchors, pieces
from millrace.llm.suffix_dedup import MARK, _marks
from millrace.operators.staging import stage

SHARD = 7 << 17  # bytes of text
QUERY = 64  # windows that one stream of words has at most


class Bits:
    """Packed bits with their prefix counts by block of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        room = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        room[: len(packed)] = packed
        self.blocks = room.view(np.uint64)
        counts = np.bitwise_count(self.blocks)
        self.before = (np.cumsum(counts, dtype=np.int64) - counts).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & below)


class WaveletTree:
    """A sequence of small numbers, by bit from the highest; each level sorts stably by its bit."""

    def __init__(self, values: np.ndarray, size: int):
        self.levels = []
        for bit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            bits = Bits(ones)
            zeros = len(values) - int(ones.sum())
            self.levels.append((bit, bits, zeros))
            values = np.concatenate((values[~ones], values[ones]))
        self.starts = self._descend(np.arange(size), np.zeros(size, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbol, at) - self.starts[symbol]


def _table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all stretches of 1, 2, 4, ... values."""
    out = [values]
    while 2 << (len(out) - 1) <= len(values):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


class Index:
    """FM-index of word sequences (small numbers; 0 ends a sequence) that answers about strings up to ``limit`` words."""

    def __init__(self, symbols: np.ndarray, documents: np.ndarray, limit: int):
        n = len(symbols)
        self.limit, self.n = limit, n
        ranks, rank, span = [], symbols.astype(np.int64) + 1, 1
        while True:
            padded = np.append(rank, np.zeros(span, np.int64))
            ranks.append((span, rank))
            key = np.sort((((rank.astype(np.uint64) << np.uint64(21)) | padded[span : span + n].astype(np.uint64)) << np.uint64(21)) | np.arange(n, dtype=np.uint64))
            sa = (key & np.uint64((1 << 21) - 1)).astype(np.int64)
            key >>= np.uint64(21)
            head = np.concatenate(([True], key[1:] != key[:-1]))
            rank = np.empty(n, np.int64)
            rank[sa] = np.cumsum(head)
            span *= 2
            if span > limit:
                break
        # Common prefixes of neighbours, by doubling downwards; only those up to ``limit`` are told apart.
        common, a, b = np.zeros(n, np.int64), sa[:-1].copy(), sa[1:].copy()
        for step, r in reversed([*ranks, (span, rank)]):
            r = np.append(r, np.arange(-1, -2 * span - 1, -1))  # beyond the end nothing agrees
            same = r[np.minimum(a, n + span)] == r[np.minimum(b, n + span)]
            common[1:] += step * same
            a, b = a + step * same, b + step * same
        self.lcp = np.append(np.minimum(common, limit + 1), 0)
        self.lcp[0] = 0
        size = int(symbols.max()) + 1
        self.tree = WaveletTree(symbols[sa - 1], size)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=size))))
        self.least = _table(documents[sa].astype(np.int32))
        self.cuts = _table(self.lcp.astype(np.int32))
        whole = np.flatnonzero(self.lcp[:n] < limit)
        order = np.searchsorted(whole, np.arange(n), "right")
        self.class_start, self.class_end = whole[order - 1], np.append(whole, n)[order]

    def extend(self, symbol: np.ndarray, lb: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the strings with one more word before them."""
        m = len(symbol)
        both = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((lb, rb)))
        return self.first[symbol] + both[:m], self.first[symbol] + both[m:]

    def smallest(self, lb: np.ndarray, rb: np.ndarray) -> np.ndarray:
        """Smallest document in each interval that is not empty."""
        out = np.empty(len(lb), np.int32)
        level = np.frexp((rb - lb).astype(float))[1] - 1
        for k in np.unique(level):
            own = level == k
            row = self.least[k]
            out[own] = np.minimum(row[lb[own]], row[rb[own] - (1 << int(k))])
        return out

    def parent(self, lb: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next shorter string that occurs more often: (interval, length)."""
        length = np.maximum(self.lcp[lb], self.lcp[rb])
        lb, rb = lb.copy(), rb + 1
        for k in range(len(self.cuts) - 1, -1, -1):
            row, step = self.cuts[k], 1 << k
            # To the left, while all of lcp[lb - step + 1 .. lb] is at least the length.
            near = lb - step + 1
            go = (near >= 1) & (row[np.clip(near, 0, len(row) - 1)] >= length)
            lb = np.where(go, lb - step, lb)
            far = rb - 1
            go = (far + step <= self.n) & (row[np.clip(far, 0, len(row) - 1)] >= length)
            rb = np.where(go, rb + step, rb)
        return lb, rb - 1, length


def matching_statistics(index: Index, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """For each place of ``symbols`` in one of the streams: the longest string from there on, up to the limit, that a smaller document has.

    All streams advance together, each by a word or a cut at a time.
    """
    found = np.zeros(len(symbols), np.int32)
    at, low, own = ends.copy(), starts.copy(), documents.copy()
    lb, rb, length = np.zeros(len(at), np.int64), np.full(len(at), index.n), np.zeros(len(at), np.int64)
    while len(at):
        symbol = symbols[at - 1]
        left, right = index.extend(symbol, lb, rb)
        good = right > left
        some = np.flatnonzero(good)
        good[some] = index.smallest(left[some], right[some]) < own[some]
        stuck = ~good & (length == 0)
        back = np.flatnonzero(~good & ~stuck)
        lb, rb, length = np.where(good, left, lb), np.where(good, right, rb), length + good
        over = np.flatnonzero(length > index.limit)
        rb[over], lb[over] = index.class_end[lb[over]], index.class_start[lb[over]]
        length[over] = index.limit
        at = at - (good | stuck)
        found[at[good]] = length[good]
        if len(back):
            lb[back], rb[back], length[back] = index.parent(lb[back], rb[back])
        more = at > low
        if not more.all():
            at, low, own, lb, rb, length = (x[more] for x in (at, low, own, lb, rb, length))
    return found


def earlier_windows(texts: list[np.ndarray], documents: np.ndarray, length: int) -> list[np.ndarray]:
    """For each word sequence: which of its windows of ``length`` words a smaller document has too."""
    sizes = np.array([len(t) for t in texts])
    words, codes = np.unique(np.concatenate(texts), return_inverse=True)
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    place = np.ones(len(symbols), bool)
    place[starts + sizes] = False
    symbols[place] = codes + 1
    _, order = np.unique(documents, return_inverse=True)
    index = Index(symbols, np.repeat(order, sizes + 1), length)
    # Long sequences are streamed in pieces that overlap by a window.
    windows = np.maximum(sizes - length + 1, 0)
    parts = -(-windows // QUERY)
    step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(starts, parts) + step * QUERY
    stop = np.minimum(first + QUERY, np.repeat(starts + windows, parts))
    own = np.repeat(order, parts)
    longest = int((stop - first).max(initial=0)) + length - 1
    # A place can lie in two pieces; only the windows of a piece count, so each piece answers in its own room.
    room = np.zeros(len(first) * longest, np.int64)
    spread = np.arange(longest)
    source = np.minimum(first[:, None] + spread, len(symbols) - 1)
    room = symbols[source].ravel()
    base = np.arange(len(first)) * longest
    found = matching_statistics(index, room, base, base + (stop - first) + length - 1, own).reshape(len(first), -1) if len(first) else np.zeros((0, 0))
    out = np.zeros(len(symbols), bool)
    if len(first):
        hit_row, hit_at = np.nonzero(found[:, :QUERY] >= length)
        inside = hit_at < (stop - first)[hit_row]
        out[first[hit_row[inside]] + hit_at[inside]] = True
    return [out[s : s + w] for s, w in zip(starts.tolist(), windows.tolist(), strict=True)]


ANSWER = "c1 long, c2 long, first int, stop int"


def _answer(length: int):
    def run(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = textops.pack(rows.column("units"))
        starts, ends, cuts = textops.words(data, offsets)
        codes, _ = textops.distinct(data, starts, ends)
        texts = np.split(codes.astype(np.uint64), cuts[1:-1])
        found = earlier_windows(texts, rows.column("doc_id").to_numpy(), length)
        c1, c2, firsts, stops = [], [], [], []
        for x, y, earlier in zip(rows.column("c1").to_pylist(), rows.column("c2").to_pylist(), found, strict=True):
            a, b = textops.runs(earlier)
            c1 += [x] * len(a)
            c2 += [y] * len(a)
            firsts += a.tolist()
            stops += b.tolist()
        yield pa.record_batch([pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(firsts, pa.int32()), pa.array(stops, pa.int32())], names=["c1", "c2", "first", "stop"])

    return run


def earlier_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, first, stop): ranges of window starts, in words, that a document with a smaller id has too."""
    return stage(_spans(pieces(docs), Windows("word", length, min(8, max(1, length // 2)))).drop("base"), "spans")


def _spans(docs: DataFrame, w: Windows) -> DataFrame:
    """``earlier_spans`` of pieces, with their base."""
    found = live_segments(docs, w)
    held = stage(contents(found), "contents")
    anchors = stage(open_anchors(held, w), "anchors")
    key = ["c1", "c2"]
    # Later documents with the same content: all windows go.
    later = found.join(held.filter("copies > 1").select("anchor", *key, F.col("doc_id").alias("least")), ["anchor", *key])
    later = later.filter("doc_id > least").select("doc_id", "base", "windows", F.explode("starts").alias("first"))
    later = later.select("doc_id", "base", "first", (F.col("first") + F.col("windows")).alias("stop"))
    # The smallest document of a content: what the index says of it.
    cold, hot = index_rows(docs, held, anchors, w)
    answers = indexed(by_anchor(cold), _answer(w.length), ANSWER, SHARD)
    if hot is not None:
        if finer := w.finer():
            # The base of such a piece is the start of its content.
            rest = _spans(finer_pieces(hot), finer).withColumnRenamed("base", "start")
            rest = rest.join(hot.select(*key, "doc_id", "start"), ["doc_id", "start"])
        else:
            loose = stage(loose_windows(hot, w), "windows")
            least = stage(loose.groupBy("w1", "w2").agg(F.min("doc_id").alias("least")), "first-windows")
            rest = loose.join(least, ["w1", "w2"]).filter("doc_id > least").join(hot.select(*key, "start"), key)
            rest = rest.select(*key, "start", F.col("at").alias("first"), (F.col("at") + 1).alias("stop"))
        answers = answers.union(rest.select(*key, (F.col("first") - F.col("start")).alias("first"), (F.col("stop") - F.col("start")).alias("stop")))
    answers = stage(answers, "answers")
    own = held.select(*key, F.col("doc_id").alias("least"))
    told = found.select("doc_id", "base", *key, "starts").join(answers, key).join(own, key).filter("doc_id = least")
    told = told.select("doc_id", "base", F.explode("starts").alias("start"), "first", "stop")
    told = told.select("doc_id", "base", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("stop")).alias("stop"))
    return later.union(told)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) of every document of ``docs`` (doc_id, text).

    Each word under a window of ``length`` words that also starts in a document with a
    smaller id is removed; ``kept`` has the others, joined by one blank. Windows are
    judged on the input. Null and empty texts, and those with fewer words, keep all they
    have. A passage that one document alone repeats stays. More columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            data, offsets = textops.pack(piece.column("text"))
            starts, ends, cuts = textops.words(data, offsets)
            gone = np.zeros(len(starts) + 1, np.int64)
            for i, marks in enumerate(piece.column("marks").to_pylist()):
                for m in marks or ():
                    gone[cuts[i] + m["first"]] += 1
                    gone[cuts[i] + m["stop"] + length - 1] -= 1
            keep = np.cumsum(gone[:-1]) == 0
            raw, kept, counts = data.tobytes(), [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = np.flatnonzero(keep[a:b]) + a
                kept.append(b" ".join([raw[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]).decode())
                counts.append(len(own))
            n = np.diff(cuts)
            yield pa.record_batch([piece.column("doc_id"), pa.array(kept, pa.string()), pa.array(n), pa.array(n - np.array(counts))], names=["doc_id", "kept", "n_words", "n_removed"])

    marks = stage(earlier_spans(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("first", "stop")).alias("marks")), "marks")
    joined = docs.select("doc_id", "text").join(marks, "doc_id", "left")
    return joined.mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long")
