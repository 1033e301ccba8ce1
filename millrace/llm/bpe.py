"""Byte-level BPE by merge replay over the distinct words of a batch.

Every distinct piece of text in a batch is kept once. All their bytes lie in one linked
array of tokens, and an inverted index maps each mergeable pair to the places where it
occurs. Merges are applied in rank order over the whole array; each touches only the
neighbours of the places it merged, and files their new pairs in the index. Documents
are then put together from their pieces.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops

#: The characters with Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0  -     　"
#: Text whose distinct words are encoded together.
BATCH_BYTES = 4 << 20
_RARE_WHITE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Ranks:
    """Token ids by their bytes, and the rank of every pair of tokens that makes a token."""

    def __init__(self, raw: bytes):
        self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        size = max(self.ids.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)])
        left, right, rank = [], [], []
        for token, r in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        a, b, r = np.array(left), np.array(right), np.array(rank)
        keys = (a << 32) | b
        order = np.argsort(keys)
        self.keys, self.values = keys[order], r[order]
        self.none = size
        # The lowest rank that a merge can bring about next to the token it makes.
        self.next_rank = np.full(size + 1, size)
        np.minimum.at(self.next_rank, a, r)
        np.minimum.at(self.next_rank, b, r)
        self.lengths = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.none)


_known: dict[tuple[int, int], Ranks] = {}


def ranks_of(raw: bytes) -> Ranks:
    key = (len(raw), zlib.crc32(raw))
    if key not in _known:
        _known[key] = Ranks(raw)
    return _known[key]


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(token ids, offsets) of the words, each encoded by itself."""
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    n = len(data)
    whole = np.array([ranks.ids.get(w, -1) for w in words], np.int64)
    word = np.append(np.repeat(np.arange(len(words)), lengths), -1)
    token = np.append(ranks.byte_ids[data], 0)
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    alive = np.ones(n + 1, bool)
    alive[n] = False
    # Rank of the pair that starts at each place.
    rank = np.full(n + 1, ranks.none)
    inner = np.flatnonzero((word[:-1] == word[1:]) & (whole[word[:-1]] < 0))
    rank[inner] = ranks.pairs(token[inner], token[inner + 1])
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def file(places: np.ndarray) -> None:
        places = places[rank[places] < ranks.none]
        if not len(places):
            return
        order = np.argsort(rank[places], kind="stable")
        places = places[order]
        own = rank[places]
        heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        for r, part in zip(own[heads].tolist(), np.split(places, heads[1:]), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(queue, r)

    file(inner)
    while queue:
        r = heapq.heappop(queue)
        found = index.pop(r)
        at = found[0] if len(found) == 1 else np.concatenate(found)
        at = np.sort(at[(rank[at] == r) & alive[at]])
        if not len(at):
            continue
        if len(at) > 1:
            at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            if ranks.next_rank[r] < r:
                # A merge may bring about an earlier pair in its word; the later places of the word wait.
                first = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
                if not first.all():
                    index[r] = [at[~first]]
                    heapq.heappush(queue, r)
                    at = at[first]
            touch = after[at[:-1]] == at[1:]
            if touch.any():
                # In a chain of touching pairs, every second one merges, from the left.
                step = np.arange(len(at))
                chain = np.maximum.accumulate(np.where(np.concatenate(([True], ~touch)), step, 0))
                at = at[(step - chain) % 2 == 0]
        gone = after[at]
        token[at] = r
        alive[gone] = False
        rank[gone] = ranks.none
        follow = after[gone]
        after[at] = follow
        before[np.minimum(follow, n)] = at
        prior = before[at]
        rank[at] = np.where(word[follow] == word[at], ranks.pairs(token[at], token[follow]), ranks.none)
        prior = prior[(prior >= 0) & (word[prior] == word[at])]
        rank[prior] = ranks.pairs(token[prior], token[after[prior]])
        file(np.concatenate((at, prior)))
    lone = whole[word[:-1]] >= 0
    starts = np.zeros(n, bool)
    starts[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    keep = np.where(lone, starts, alive[:-1])
    ids = np.where(lone, whole[word[:-1]], token[:-1])[keep]
    counts = np.bincount(word[:-1][keep], minlength=len(words))
    return ids, np.concatenate(([0], np.cumsum(counts)))


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches between which no match of the pattern runs, in order: words with the blank before them, and white space.

    Of white space before a word, all but the last character is one match; the last
    belongs to the word if it is a blank, and stands alone otherwise.
    """
    starts, ends, first = textops.words(data, offsets)
    n_words = np.diff(first)
    bound = np.empty(len(starts), np.int64)
    bound[1:] = ends[:-1]
    filled = np.flatnonzero(n_words)
    bound[first[:-1][filled]] = offsets[:-1][filled]
    gap = starts - bound
    joined = (gap > 0) & (data[starts - 1] == 32)
    long = gap > 1
    single = (gap > 0) & ~joined
    last = offsets[:-1].copy()
    last[filled] = ends[first[1:][filled] - 1]
    tail = last < offsets[1:]
    a = np.concatenate((starts - joined, bound[long], starts[single] - 1, last[tail]))
    b = np.concatenate((ends, starts[long] - 1, starts[single], offsets[1:][tail]))
    order = np.argsort(a)
    return a[order], b[order]


def encode_batch(texts: pa.Array, ranks: Ranks, pattern: regex.Pattern) -> pa.Array:
    """Token ids of each text as a list column; null is empty."""
    odd = np.flatnonzero(pa.compute.match_substring_regex(texts.fill_null(""), _RARE_WHITE).to_numpy(zero_copy_only=False)).tolist()
    slots: dict[bytes, int] = {}
    parts = []
    place: dict[bytes, int] = {}  # of each piece of text so far, in the order of ``names``
    table = pa.record_batch([texts], names=["text"])
    for piece in textops.slices(iter([table])):
        data, offsets = textops.pack(piece.column("text"))
        a, b = cut_pieces(data, offsets)
        codes, found = textops.distinct(data, a, b)
        slot_of = np.array([place.setdefault(name, len(place)) for name in found], np.int32)
        parts.append((slot_of[codes] if len(codes) else slot_of, np.searchsorted(a, offsets)))
    names = list(place)
    # Matches of the pattern within the pieces, and within whole texts with rare white space.
    owners: list[list[int]] = []
    for name in [*names, *(texts[i].as_py().encode() for i in odd)]:
        owners.append([slots.setdefault(m.encode(), len(slots)) for m in pattern.findall(name.decode())])
    ids, ends = replay(list(slots), ranks) if slots else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    flat = np.fromiter((s for o in owners for s in o), np.int64)
    counts = ends[flat + 1] - ends[flat]
    ids = ids[_ranges(ends[flat], counts)].astype(np.int32)
    match_ends = np.concatenate(([0], np.cumsum(counts)))
    ends = match_ends[np.concatenate(([0], np.cumsum([len(o) for o in owners], dtype=np.int64)))]
    texts_ids, lengths = [], []
    for used, cuts in parts:
        size = ends[used + 1] - ends[used]
        texts_ids.append(ids[_ranges(ends[used], size)])
        total = np.concatenate(([0], np.cumsum(size)))
        lengths.append(np.diff(total[cuts]))
    values, lengths = np.concatenate(texts_ids), np.concatenate(lengths)
    if odd:
        rows = np.split(values, np.cumsum(lengths)[:-1])
        for k, i in enumerate(odd, len(names)):
            rows[i] = ids[ends[k] : ends[k + 1]]
        values, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    return textops.lists(np.concatenate(([0], np.cumsum(lengths))), values)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of the ranges, one after the other."""
    total = np.cumsum(counts)
    if not len(total):
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(starts - (total - counts), counts)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of each text; other columns stay.

    ``rank_file`` (base64 token and rank by line) is read by the driver and sent to the
    tasks; a vocabulary is bounded. A null or empty text gives an empty list. Column
    ``into`` is replaced if it is there already. Repeated rows are encoded each.
    """
    with open(rank_file, "rb") as f:
        raw = f.read()
    pattern = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")
    docs = docs.drop(into)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, compiled = ranks_of(raw), regex.compile(pattern)
        for batch in textops.slices(batches, text, BATCH_BYTES):
            ids = encode_batch(batch.column(text), ranks, compiled)
            yield pa.record_batch([*batch.columns, ids], names=[*names, into])

    schema = docs.select("*", F.lit(None).cast("array<int>").alias(into)).schema
    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, rank_file: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each list of token ids in place of the list; null gives empty bytes."""
    with open(rank_file, "rb") as f:
        raw = f.read()
    names = [c for c in docs.columns if c not in (ids, into)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(raw)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                column = batch.column(ids)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
                sizes = ranks.lengths[flat]
                data = ranks.blob[_ranges(ranks.starts[flat], sizes)].tobytes()
                ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
                out = pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.record_batch([*(batch.column(c) for c in names), out], names=[*names, into])

    schema = docs.select(*names, F.lit(None).cast("binary").alias(into)).schema
    return docs.mapInArrow(run, schema)
