"""Line dedup by pairwise alignment.

Documents overlap if they share a line that is not blank, however short: each leads to the
first document with that line. That one may have the lines in another order, so the runs of
2, 4, 8 and so on of such lines, and the whole text, lead too, each to the first document
that has it. A block that an earlier document has in this order thus meets one with at least
half of it, and a copy meets the first text of all that equals it.

A document is aligned whole with every partner by patience diff: lines that occur once in
both, in their longest common order, anchor the alignment, and equal neighbours extend it.
Aligned blocks are deleted from the later document. It has at most as many partners as
leads, whatever the size of a group.

Every line lives on in the first document that has it: there is no earlier one to align it
with.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.operators.staging import stage


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, offsets of the texts) of the lines; a line does not hold its line feed."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
    # A line feed at the end of a text starts a last, empty line in that text; the next text starts at the same byte.
    text_of_feed = np.searchsorted(offsets, feeds, "right") - 1
    counts = np.bincount(text_of_feed, minlength=len(offsets) - 1) + 1
    cuts = np.concatenate(([0], np.cumsum(counts)))
    ends = np.append(starts[1:] - 1, 0)
    ends[cuts[1:] - 1] = offsets[1:]
    return starts, ends, cuts


def _leads(lines: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines and of their runs of 2, 4, 8 and so on within a text, and the text of each."""
    rolling = textops.Rolling(lines)
    keys, texts, width = [lines], [text], 2
    while width <= len(lines):
        at = np.flatnonzero(text[: len(text) - width + 1] == text[width - 1 :])
        if not len(at):
            break
        keys.append(rolling.of(at, at + width))
        texts.append(text[at])
        width *= 2
    return np.concatenate(keys), np.concatenate(texts)


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes, leads): hash of each line without white space at its ends (0: blank), and the hashes that lead elsewhere, each once: lines that are not blank, runs of them, and the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            data, offsets = textops.pack(piece.column("text"))
            starts, ends, cuts = _lines(data, offsets)
            a, b, _ = textops.words(data, offsets)
            first, last = np.searchsorted(a, starts), np.searchsorted(b, ends, "right")
            filled = last > first
            hashes = np.zeros(len(starts), np.uint64)
            hashes[filled] = textops.content_hashes(data, a[first[filled]], b[last[filled] - 1])
            solid, own = hashes[filled], np.searchsorted(cuts, np.flatnonzero(filled), "right") - 1
            keys, text = _leads(solid, own)
            # Texts with the same lines, blank ones too.
            whole = np.unique(own)
            keys = np.concatenate((keys, textops.Rolling(hashes).of(cuts[whole], cuts[whole + 1])))
            text = np.concatenate((text, whole))
            order = np.lexsort((keys, text))
            keys, text = keys[order], text[order]
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
            keys, text = keys[fresh], text[fresh]
            keep = np.searchsorted(text, np.arange(len(cuts)))
            yield pa.record_batch([piece.column("doc_id"), textops.lists(cuts, hashes.view(np.int64)), textops.lists(keep, keys.view(np.int64))], names=["doc_id", "hashes", "leads"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, hashes array<long>, leads array<long>")


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first number, that rises in the second."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for p, (_, i) in enumerate(pairs):
        t = bisect_left(tails, i)
        back[p] = at[t - 1] if t else -1
        if t == len(tails):
            tails.append(i)
            at.append(p)
        else:
            tails[t], at[t] = i, p
    chain = []
    p = at[-1] if at else -1
    while p >= 0:
        chain.append(pairs[p])
        p = back[p]
    chain.reverse()
    return chain


def patience_blocks(old: list[int], new: list[int]) -> list[tuple[int, int]]:
    """Blocks of ``new``, as (start, end), that patience diff aligns with ``old``. Blank lines (0) only extend a block."""
    out: list[tuple[int, int]] = []
    work = [(0, len(old), 0, len(new))]
    while work:
        a, b, c, d = work.pop()
        # Equal lines at both ends of the stretch.
        k = c
        while a < b and k < d and old[a] == new[k]:
            a, k = a + 1, k + 1
        if k > c:
            out.append((c, k))
        c, k = k, d
        while a < b and c < k and old[b - 1] == new[k - 1]:
            b, k = b - 1, k - 1
        if k < d:
            out.append((k, d))
        d = k
        if a == b or c == d:
            continue
        once: dict[int, list[int]] = {}
        for i in range(a, b):
            once.setdefault(old[i], [0, 0, 0, 0])
            once[old[i]][0] += 1
            once[old[i]][1] = i
        for j in range(c, d):
            if new[j] in once:
                once[new[j]][2] += 1
                once[new[j]][3] = j
        pairs = sorted((v[3], v[1]) for h, v in once.items() if h and v[0] == 1 == v[2])
        if not pairs:
            continue
        x, y = a, c
        for j, i in _rising(pairs):
            # The stretch before the anchor; the anchor itself starts the next one.
            if i > x and j > y:
                work.append((x, i, y, j))
            out.append((j, j + 1))
            x, y = i + 1, j + 1
        if b > x and d > y:
            work.append((x, b, y, d))
    return _joined(out)


def _joined(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(blocks):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_BLOCKS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def aligned_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, blocks): for each later document, the line ranges to delete."""
    lines = stage(line_table(docs), "lines")
    single = lines.select("doc_id", F.explode("leads").alias("lead"))
    found = single.groupBy("lead").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    shared = stage(found.filter("n > 1").select("lead", "first"), "shared-lines")
    # As many partners as leads at most, which the document's length bounds.
    pairs = stage(single.join(shared, "lead").filter("first < doc_id").select("doc_id", "first").distinct(), "partners")
    old = lines.select(F.col("doc_id").alias("first"), F.col("hashes").alias("old"))
    both = pairs.join(lines.select("doc_id", F.col("hashes").alias("new")), "doc_id").join(old, "first").select("doc_id", "new", "old")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One row at a time: the lists of a batch take far more memory than its arrays.
            rows = ((new.as_py(), old.as_py()) for new, old in zip(batch.column("new"), batch.column("old"), strict=True))
            found = [[{"start": a, "end": b} for a, b in patience_blocks(old, new) if any(new[a:b])] for new, old in rows]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, _BLOCKS)], names=["doc_id", "blocks"])

    blocks = both.mapInArrow(run, "doc_id long, blocks array<struct<start:int,end:int>>")
    return blocks.groupBy("doc_id").agg(F.flatten(F.collect_list("blocks")).alias("blocks"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without the aligned lines, and n_lines, n_removed (columns of these names are replaced).

    Lines are compared without white space at their ends; the lines that stay keep
    theirs. Documents are kept even if nothing is left of them. Null texts stay null, and
    empty ones empty. Copies of a document lose all lines but in the copy with the
    smallest id, but for texts of blank lines; rows that share an id are one document to the others, and none to each
    other. Blank lines go only inside or at the edge of an aligned block.
    """
    docs = docs.drop("n_lines", "n_removed", "blocks")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            texts, counts, removed = [], [], []
            for text, blocks in zip(piece.column("text").to_pylist(), piece.column("blocks").to_pylist(), strict=True):
                lines = text.split("\n") if text else []
                gone = {i for b in blocks or () for i in range(b["start"], b["end"])}
                texts.append("\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else text)
                counts.append(len(lines))
                removed.append(len(gone))
            columns = {n: piece.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            yield pa.record_batch([*columns.values(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed"])

    schema = docs.select("*", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed")).schema
    return docs.join(aligned_blocks(docs), "doc_id", "left").select(*names, "blocks").mapInArrow(run, schema)
