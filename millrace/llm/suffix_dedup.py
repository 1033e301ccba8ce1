"""Removal of byte strings that occur twice, by the Burrows-Wheeler transform.

Within a shard of segments (``passages``), suffixes are sorted by their first bytes, which
gives the transform. Breadth-first backward extension then takes the intervals of strings
of length 0, 1, 2, ... and finds the places where neighbouring suffixes have exactly that
many bytes in common. It stops at the wanted length: suffixes between two places that are
still open share at least so many bytes with a neighbour, so the string there repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.passages import Windows, by_anchor, contents, distinct_windows, finer_pieces, index_rows, indexed, live_segments, open_anchors, pieces
from millrace.operators.staging import stage

FIRST = 5  # symbols in the first sort key
SHARD = 1 << 19


def suffixes(symbols: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array by the first ``order`` symbols at least, rank of the first ``FIRST`` symbols by suffix).

    ``symbols`` are below 256 and fewer than 2^21; beyond the end lies a symbol smaller than all.
    """
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.uint64) + np.uint64(1), np.zeros(FIRST, np.uint64)))
    key = np.zeros(n, np.uint64)
    for j in range(FIRST):
        key = (key << np.uint64(8 + (j > 0))) | padded[j : j + n] if j else padded[:n].copy()
    # 5 symbols of up to 9 bits and 19 bits of place fill 64 bits.
    low = np.uint64(19)
    if n > 1 << 19:
        order_by = np.argsort(key, kind="stable")
        key = key[order_by]
    else:
        key = np.sort((key << low) | np.arange(n, dtype=np.uint64))
        order_by = (key & np.uint64((1 << 19) - 1)).astype(np.int64)
        key >>= low
    head = np.concatenate(([True], key[1:] != key[:-1]))
    slot = np.arange(n)
    first = np.maximum.accumulate(np.where(head, slot, 0))
    rank = np.empty(n + 1, np.int64)
    rank[order_by] = first + 1
    rank[n] = 0
    sa = order_by.copy()
    start_heads = head.copy()
    multiple = ~(head & np.append(head[1:], True))
    active = sa[multiple]
    span = FIRST
    while span < order and len(active):
        ahead = rank[np.minimum(active + span, n)].astype(np.uint64)
        key = np.sort((((rank[active].astype(np.uint64) << np.uint64(21)) | ahead) << np.uint64(21)) | active.astype(np.uint64))
        active = (key & np.uint64((1 << 21) - 1)).astype(np.int64)
        key >>= np.uint64(21)
        group = key >> np.uint64(21)
        step = np.arange(len(active))
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        place = group.astype(np.int64) - 1 + step - np.maximum.accumulate(np.where(new_group, step, 0))
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = place[np.maximum.accumulate(np.where(head, step, 0))] + 1
        sa[place] = active
        active = active[~(head & np.append(head[1:], True))]
        span *= 2
    return sa, start_heads


def open_boundaries(symbols: np.ndarray, sa: np.ndarray, heads: np.ndarray, length: int) -> np.ndarray:
    """For each pair of neighbours in the suffix array (by the second): do they share ``length`` symbols?

    Breadth-first over the intervals of strings, by length. The places where fewer than
    ``FIRST`` symbols agree are read off the first sort.
    """
    n = len(sa)
    bwt = symbols[sa - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    change = np.concatenate(([True], bwt[1:] != bwt[:-1]))
    run = np.cumsum(change) - 1
    run_start = np.flatnonzero(change)
    run_end = np.append(run_start[1:], n)
    closed = np.append(heads, True)
    lb = np.flatnonzero(heads)
    rb = np.append(lb[1:], n)
    for _ in range(FIRST, length):
        if not len(lb):
            break
        # Intervals before which only one symbol stands move as a whole.
        a, b = run[lb], run[rb - 1]
        one = a == b
        left, right = [lf[lb[one]]], [lf[rb[one] - 1] + 1]
        if not one.all():
            wide = ~one
            lo, hi, a, b = lb[wide], rb[wide], a[wide], b[wide]
            counts = b - a + 1
            owner = np.repeat(np.arange(len(a)), counts)
            runs = np.repeat(a - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            key = (owner << 8) | bwt[run_start[runs]]
            order = np.argsort(key, kind="stable")
            key, runs, owner = key[order], runs[order], owner[order]
            head = np.concatenate(([True], key[1:] != key[:-1]))
            at, last = np.flatnonzero(head), np.append(np.flatnonzero(head)[1:], len(key)) - 1
            left.append(lf[np.maximum(run_start[runs[at]], lo[owner[at]])])
            right.append(lf[np.minimum(run_end[runs[last]], hi[owner[last]]) - 1] + 1)
        lb, rb = np.concatenate(left), np.concatenate(right)
        fresh = ~closed[rb]
        lb, rb = lb[fresh], rb[fresh]
        closed[rb] = True
    return ~closed[:n]


def repeated_windows(texts: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each byte string: which of its windows of ``length`` start at another place of the strings too."""
    sizes = np.array([len(t) for t in texts])
    used = np.zeros(256, bool)
    for t in texts:
        used[t] = True
    # Symbol 0 ends each string; UTF-8 leaves some byte values unused.
    code = np.cumsum(used).astype(np.uint8)
    gap = np.zeros(1, np.uint8)
    symbols = np.concatenate([x for t in texts for x in (code[t], gap)])
    sa, heads = suffixes(symbols, length)
    same = open_boundaries(symbols, sa, heads, length)
    twice = np.empty(len(sa), bool)
    twice[sa] = same | np.append(same[1:], False)
    starts = np.cumsum(sizes + 1) - sizes - 1
    return [twice[s : s + max(0, z - length + 1)] for s, z in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _answer(length: int):
    def run(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = [np.frombuffer(b.as_buffer(), np.uint8) for b in rows.column("units")]
        found = repeated_windows(texts, length)
        ids, ranges = [], []
        for doc, start, twice in zip(rows.column("doc_id").to_pylist(), rows.column("start").to_pylist(), found, strict=True):
            a, b = textops.runs(twice)
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                ids.append(doc)
                ranges.append((start + x, start + y))
        yield _marks(ids, ranges)

    return run


MARK = "doc_id long, first int, stop int"


def _marks(ids: list[int], ranges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array([r[0] for r in ranges], pa.int32()), pa.array([r[1] for r in ranges], pa.int32())], names=["doc_id", "first", "stop"]
    )


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, first, stop): ranges of window starts that occur elsewhere too; ranges may overlap."""
    return _spans(pieces(docs), Windows("byte", length, min(24, max(1, length // 2))))


def _spans(docs: DataFrame, w: Windows) -> DataFrame:
    """``repeated_spans`` of pieces; staged."""
    found = live_segments(docs, w)
    held = stage(contents(found), "contents")
    anchors = stage(open_anchors(held, w), "anchors")
    # Contents with several copies repeat as a whole. They still witness for others.
    many = held.filter("copies > 1").select("anchor", "c1", "c2")
    whole = found.join(many, ["anchor", "c1", "c2"]).select("doc_id", "windows", F.explode("starts").alias("first"))
    whole = whole.select("doc_id", "first", (F.col("first") + F.col("windows")).alias("stop"))
    cold, hot = index_rows(docs, held, anchors, w)
    single = indexed(by_anchor(cold), _answer(w.length), MARK, SHARD)
    if hot is None:
        return stage(whole.union(single), "spans")
    if finer := w.finer():
        rest = _spans(finer_pieces(hot), finer)
    else:
        loose = stage(distinct_windows(hot, w), "windows")
        twice = loose.filter("n > 0").groupBy("w1", "w2").agg(F.sum("n").alias("times")).filter("times > 1").select("w1", "w2")
        once = loose.filter("n = 1").join(stage(twice, "repeated-windows"), ["w1", "w2"], "left_semi")
        rest = once.union(loose.filter("n = 0").select(once.columns)).select("doc_id", "first", "stop")
    return stage(whole.union(single).union(rest), "spans")


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of every document of ``docs`` (doc_id, text).

    Every byte under a ``length``-byte string that also starts elsewhere, in the same or
    in another document, is removed; ``kept`` has the other bytes. Strings are judged on
    the input. Null and empty texts, and those shorter than ``length``, keep all they
    have. ``doc_id`` must be unique for rows to be told apart. More columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            data, offsets = textops.pack(piece.column("text"))
            kept, sizes, removed, spans = [], [], [], []
            for i, marks in enumerate(piece.column("marks").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                gone = np.zeros(len(text), bool)
                if marks:
                    a = np.array([m["first"] for m in marks])
                    b = np.array([m["stop"] for m in marks])
                    gone = textops.covered(len(text), a, b + length - 1)
                kept.append(text[~gone].tobytes())
                sizes.append(len(text))
                removed.append(int(gone.sum()))
                spans.append(len(textops.runs(gone)[0]))
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
            )

    marks = stage(repeated_spans(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("first", "stop")).alias("marks")), "marks")
    joined = docs.select("doc_id", "text").join(marks, "doc_id", "left")
    return joined.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
