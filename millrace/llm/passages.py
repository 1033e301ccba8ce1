"""Where may a passage of fixed length repeat? Content-addressed segments.

A window is ``length`` consecutive units (bytes or words) of one document. Its *anchor* is
the smallest hash among the ``gram``-unit stretches inside it, so equal windows have equal
anchors wherever they are. A *segment* is a run of windows with one anchor in one document.
A window can repeat only in segments with its anchor. So the anchors are counted first, and
segments whose anchor occurs once in the corpus are dropped on their way. Equal segments, told
by a cryptographic hash of 128 bits, are handled as one *content*; of each, one segment goes on
to the index of its anchor, with its text.

Anchors with more than ``HOT_UNITS`` units of different contents would make one task too
large: a short stretch that very many documents have, each in a context of its own. Their contents
become *pieces* that are cut anew by longer anchors (``Windows.finer``), which contexts
seldom share. Windows of anchors that are hot even so, as those of periodic texts, are told apart
one by one, by two hashes modulo a prime, in an aggregation that Spark spreads over all tasks
(``loose_windows``, ``distinct_windows``).

All functions work on pieces: ``doc_id``, ``base`` and ``text``, where the text is the part of the
document from unit ``base`` on. A whole document is one piece with base 0; windows of a document
lie in one piece each. Places are always counted from the start of the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.operators.staging import stage

HOT_UNITS = 5 << 18
#: Windows in a segment at most; longer runs (of one repeated word, say) are cut.
LONGEST = 4096
#: Windows that are hashed at a time.
CHUNK = 1 << 16


@dataclass(frozen=True)
class Windows:
    """What a unit is, how many make a window, and how many an anchor."""

    unit: str  # "byte" or "word"
    length: int
    gram: int

    def finer(self) -> Windows | None:
        """The same windows with a quarter as many places for an anchor, unless these are few."""
        places = (self.length - self.gram) // 4
        return replace(self, gram=self.length - places) if places >= max(1, self.length // 16) else None

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable]:
        """(units, unit offsets of the texts, text of each stretch of units): bytes, or hashes of words.

        The words of a stretch have one blank between them.
        """
        if self.unit == "byte":
            raw = data.tobytes()
            return data, offsets, lambda a, b: [raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        starts, ends, first = textops.words(data, offsets)
        own, cuts = textops.flat(data, starts, ends)
        place = np.arange(len(own)) + np.repeat(np.arange(len(starts)), np.diff(cuts))
        spaced = np.full(len(own) + len(starts), 32, np.uint8)
        spaced[place] = own
        raw, at = spaced.tobytes(), cuts + np.arange(len(cuts))
        texts = lambda a, b: [raw[i : j - 1] for i, j in zip(at[a].tolist(), at[b].tolist(), strict=True)]
        return textops.content_hashes(data, starts, ends), first, texts


SEGMENT = "doc_id long, base int, anchor long, c1 long, c2 long, starts array<int>, windows int, multi boolean"


def _cut(units: np.ndarray, offsets: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """(text, first window, end window, anchor, does the anchor occur twice) of the segments, in units."""
    span = w.length - w.gram + 1
    empty = np.zeros(0, np.int64)
    if len(units) < w.length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(bool)
    grams = textops.Rolling(units).grams(w.gram)
    least = textops.sliding_min(grams, span)
    n = len(units) - w.length + 1
    least = least[:n]
    valid = np.zeros(n, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= w.length:
            valid[a : b - w.length + 1] = True
    head = valid.copy()
    head[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    inside = offsets[:-1][offsets[:-1] < n]
    head[inside] |= valid[inside]
    starts = np.flatnonzero(head)
    tail = valid.copy()
    tail[:-1] &= head[1:] | ~valid[1:]
    ends = np.flatnonzero(tail) + 1
    parts = -(-(ends - starts) // LONGEST)
    if (parts > 1).any():
        step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, stop = np.repeat(starts, parts) + step * LONGEST, np.repeat(ends, parts)
        ends = np.minimum(starts + LONGEST, stop)
    anchor = least[starts]
    multi = np.zeros(len(starts), bool)
    long = np.flatnonzero(ends - starts > 1)
    for i in long.tolist():
        a, b = starts[i], ends[i] + span - 1
        multi[i] = b - a >= 2 * span or np.count_nonzero(grams[a:b] == anchor[i]) > 1
    text = np.searchsorted(offsets, starts, "right") - 1
    return text, starts, ends, anchor, multi


def pieces(docs: DataFrame) -> DataFrame:
    """Whole documents as pieces."""
    return docs.select("doc_id", F.lit(0).alias("base"), "text")


def live_segments(docs: DataFrame, w: Windows) -> DataFrame:
    """The segments whose anchor occurs in another segment too, or twice in their own; staged.

    The documents are cut twice, so that the anchors alone are counted and nothing is kept of the
    segments that nobody shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            _, _, _, anchor, multi = _cut(*w.units(*textops.pack(piece.column("text")))[:2], w)
            if len(anchor):
                own, at, n = np.unique(anchor, return_inverse=True, return_counts=True)
                twice = np.bincount(at, multi, len(own)) > 0
                yield pa.record_batch([pa.array(own.view(np.int64)), pa.array(n + twice)], names=["anchor", "n"])

    counted = docs.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    shared = stage(counted.filter("n > 1").select("anchor"), "shared-anchors")
    return stage(segments(docs, w).join(shared, "anchor", "left_semi"), "segments")


def segments(docs: DataFrame, w: Windows) -> DataFrame:
    """The segments of every piece; equal segments of one piece are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            units, offsets, texts = w.units(*textops.pack(piece.column("text")))
            text, starts, ends, anchor, multi = _cut(units, offsets, w)
            if not len(text):
                continue
            digests = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts(starts, ends + w.length - 1))
            c1, c2 = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
            order = np.lexsort((starts, c2, c1, text))
            text, starts, ends, anchor, multi, c1, c2 = (x[order] for x in (text, starts, ends, anchor, multi, c1, c2))
            head = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]))))
            ids, base = piece.column("doc_id").to_numpy(), piece.column("base").to_numpy()
            yield pa.record_batch(
                [
                    pa.array(ids[text[head]]),
                    pa.array(base[text[head]]),
                    *(pa.array(x[head].view(np.int64)) for x in (anchor, c1, c2)),
                    textops.lists(np.append(head, len(text)), (starts - offsets[text] + base[text]).astype(np.int32)),
                    pa.array((ends - starts)[head].astype(np.int32)),
                    pa.array(multi[head]),
                ],
                names=["doc_id", "base", "anchor", "c1", "c2", "starts", "windows", "multi"],
            )

    return docs.select("doc_id", "base", "text").mapInArrow(run, SEGMENT)


def contents(found: DataFrame) -> DataFrame:
    """One row for each content: its anchor, hash, number of segments, smallest document, a piece of it and a start there, windows, multi."""
    # One number for both places, which the aggregation can keep in its hash table.
    place = F.shiftleft(F.col("base").cast("long"), 32) + F.col("starts")[0]
    per = found.groupBy("anchor", "c1", "c2").agg(
        F.sum(F.size("starts")).alias("copies"),
        F.min("doc_id").alias("doc_id"),
        F.min_by(place, "doc_id").alias("place"),
        F.first("windows").alias("windows"),
        F.max("multi").alias("multi"),
    )
    places = {"base": F.shiftright("place", 32).cast("int"), "start": F.col("place").bitwiseAND((1 << 32) - 1).cast("int")}
    return per.withColumns(places).drop("place")


def open_anchors(held: DataFrame, w: Windows) -> DataFrame:
    """(anchor, hot): anchors with different contents, or that occur twice within one."""
    units = F.sum(F.col("windows") + F.lit(w.length)).alias("units")
    per = held.groupBy("anchor").agg(F.count("*").alias("contents"), F.max("multi").alias("multi"), units)
    return per.filter("contents > 1 or multi").select("anchor", (F.col("units") > HOT_UNITS).alias("hot"))


def _wanted(kept: DataFrame) -> DataFrame:
    """For each piece, the segments that are looked at; their number is bounded by its length."""
    return kept.groupBy("doc_id", "base").agg(F.collect_list(F.struct("start", "windows", "anchor", "c1", "c2", "hot")).alias("wanted"))


def _with_wanted(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pieces with the segments wanted of them. The list is written first, so that the optimizer knows its size."""
    return docs.select("doc_id", "base", "text").join(stage(_wanted(kept), "wanted"), ["doc_id", "base"])


ROW = "anchor long, c1 long, c2 long, doc_id long, start int, windows int, hot boolean, units binary"


def _index_rows(docs: DataFrame, kept: DataFrame, w: Windows) -> DataFrame:
    """The chosen segments with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            _, offsets, texts = w.units(*textops.pack(piece.column("text")))
            lists = piece.column("wanted")
            rows = lists.flatten()
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            start, windows = (rows.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("start", "windows"))
            at = offsets[text] + start - piece.column("base").to_numpy()[text]
            columns = {x: rows.field(x) for x in ("anchor", "c1", "c2", "start", "windows", "hot")}
            columns["doc_id"] = pa.array(piece.column("doc_id").to_numpy()[text])
            columns["units"] = pa.array(texts(at, at + windows + w.length - 1), pa.binary())
            names = ["anchor", "c1", "c2", "doc_id", "start", "windows", "hot", "units"]
            yield pa.record_batch([columns[x] for x in names], names=names)

    return _with_wanted(docs, kept).mapInArrow(run, ROW)


def index_rows(docs: DataFrame, held: DataFrame, anchors: DataFrame, w: Windows) -> tuple[DataFrame, DataFrame | None]:
    """The contents of open anchors with their text: those for the index, and those of hot anchors, if there are any.

    The documents are shuffled once for both.
    """
    rows = _index_rows(docs, held.join(anchors, "anchor"), w)
    if anchors.filter("hot").isEmpty():
        return rows, None
    rows = stage(rows, "texts")
    return rows.filter("not hot"), rows.filter("hot")


def finer_pieces(hot: DataFrame) -> DataFrame:
    """Hot contents as pieces; their base is the start of the content."""
    return hot.select("doc_id", F.col("start").alias("base"), F.col("units").alias("text"))


def _hashed(batches: Iterator[pa.RecordBatch], w: Windows):
    """(w1, w2, row, place in the document) of all windows of some hot contents, and these."""
    for piece in textops.slices(batches, "units"):
        units, offsets, _ = w.units(*textops.pack(piece.column("units")))
        a, b = textops.PrimeRolling(units, 0), textops.PrimeRolling(units, 1)
        windows, start = np.diff(offsets) - w.length + 1, piece.column("start").to_numpy()
        done = np.cumsum(windows)
        k = 0
        while k < len(windows):
            stop = max(k + 1, int(np.searchsorted(done, done[k] - windows[k] + CHUNK, "right")))
            n = windows[k:stop]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(offsets[k:stop], n) + step
            w1, w2 = (x.of(place, place + w.length).view(np.int64) for x in (a, b))
            yield w1, w2, np.repeat(np.arange(stop - k), n), (np.repeat(start[k:stop], n) + step).astype(np.int32), piece.slice(k, stop - k)
            k = stop


def loose_windows(hot: DataFrame, w: Windows) -> DataFrame:
    """(w1, w2, c1, c2, doc_id, at): every window of hot contents, by hashes at two points modulo a prime."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w1, w2, of, at, rows in _hashed(batches, w):
            yield pa.record_batch([pa.array(w1), pa.array(w2), *(rows.column(x).take(pa.array(of)) for x in ("c1", "c2", "doc_id")), pa.array(at)], names=["w1", "w2", "c1", "c2", "doc_id", "at"])

    return hot.mapInArrow(run, "w1 long, w2 long, c1 long, c2 long, doc_id long, at int")


def distinct_windows(hot: DataFrame, w: Windows) -> DataFrame:
    """(w1, w2, doc_id, first, stop, n): the different windows of hot contents, by hashes at two points modulo a prime.

    Those that a content has once (n is 1) lie at ``first``. Of one that it has more often there is a
    row with n of 2; all places of such windows are in further rows without hashes, as ranges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w1, w2, of, at, rows in _hashed(batches, w):
            ids = rows.column("doc_id").to_numpy()
            order = np.lexsort((at, w2, w1, of))
            x, y, z = w1[order], w2[order], of[order]
            head = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1]))))
            times = np.diff(np.append(head, len(x)))
            again = np.zeros(len(x), bool)
            again[order] = np.repeat(times > 1, times)
            first = again.copy()
            first[1:] &= ~again[:-1] | (of[1:] != of[:-1])
            last = again.copy()
            last[:-1] &= ~again[1:] | (of[1:] != of[:-1])
            a, b, one = np.flatnonzero(first), np.flatnonzero(last), order[head]
            none = pa.nulls(len(a), pa.int64())
            columns = [pa.concat_arrays([pa.array(v[one]), none]) for v in (w1, w2)]
            columns.append(pa.array(ids[of[np.concatenate((one, a))]]))
            columns.append(pa.array(at[np.concatenate((one, a))]))
            columns.append(pa.array(at[np.concatenate((one, b))] + np.int32(1)))
            columns.append(pa.array(np.concatenate((np.minimum(times, 2), np.zeros(len(a)))).astype(np.int32)))
            yield pa.record_batch(columns, names=["w1", "w2", "doc_id", "first", "stop", "n"])

    return hot.mapInArrow(run, "w1 long, w2 long, doc_id long, first int, stop int, n int")


def by_anchor(rows: DataFrame) -> DataFrame:
    """Bring the segments of an anchor together, in order of anchor."""
    return rows.repartition("anchor").sortWithinPartitions("anchor", "c1", "c2")


def indexed(rows: DataFrame, answer: Callable, schema: str, limit: int) -> DataFrame:
    """Call ``answer`` on runs of whole anchors with up to about ``limit`` bytes of units each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            sizes = np.cumsum(pa.compute.binary_length(batch.column("units")).to_numpy(zero_copy_only=False))
            heads = np.flatnonzero(np.concatenate(([not held or held[-1].column("anchor")[-1].as_py() != anchors[0]], anchors[1:] != anchors[:-1])))
            start = 0
            for head in heads.tolist():
                pending = size + int(sizes[head - 1] - (sizes[start - 1] if start else 0)) if head > start else size
                if pending >= limit:
                    if head > start:
                        held.append(batch.slice(start, head - start))
                    yield from answer(pa.Table.from_batches(held).combine_chunks())
                    held, size, start = [], 0, head
            if start < batch.num_rows:
                held.append(batch.slice(start))
                size += int(sizes[-1] - (sizes[start - 1] if start else 0))
        if held:
            yield from answer(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(run, schema)
