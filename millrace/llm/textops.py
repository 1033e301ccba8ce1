"""Array arithmetic on texts: bytes, words, rolling hashes, minimizers.

Everything here runs inside a task on a slice of a few megabytes. Texts of a slice
lie end to end in one byte array; ``offsets`` has the start of each and the end of the
last. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_BASES = (_BASE, 0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece stay below ``limit`` bytes, or are one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def pack(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offset_buffer, data_buffer = texts.buffers()
    raw = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8)[raw[0] : raw[-1]] if data_buffer is not None else np.zeros(0, np.uint8)
    return data, raw - raw[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word ``[^\\x20\\x09-\\x0D]+``, and the word offsets of the texts."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    solid = ~SPACE[data]
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _table(family: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[family]))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a family's base modulo 2^64, and their inverses."""
    if family not in _powers or len(_powers[family][0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        base, inverse = _BASES[family], pow(_BASES[family], -1, 1 << 64)
        pair = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        if size > 4 * SLICE_BYTES:
            return pair[0], pair[1]
        _powers[family] = (pair[0], pair[1])
    return _powers[family]


def release() -> None:
    """At the end of a task, give back what the worker would hold while it waits: tables made anew in milliseconds, and freed memory."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def flat(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of stretches that rise and do not overlap, one after the other."""
    lengths = ends - starts
    filled = lengths > 0
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts[filled]] = 1
    steps[ends[filled]] -= 1
    return data[np.cumsum(steps[:-1], dtype=np.int8).view(bool)], np.concatenate(([0], np.cumsum(lengths)))


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each stretch's content, the contents), by comparing bytes. The stretches are less than 2 GB."""
    own, offsets = flat(data, starts, ends)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(own)]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    names, cuts = pack(coded.dictionary)
    raw, cuts = names.tobytes(), cuts.tolist()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_seen: dict[bytes, int] = {}
_REMEMBERED = 300_000


def content_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic hash of each stretch; each distinct one is hashed once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    codes, names = distinct(data, starts, ends)
    if len(_seen) > _REMEMBERED:
        _seen.clear()
    hashes = []
    for name in names:
        h = _seen.get(name)
        if h is None:
            h = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little")
            if len(name) <= 64:
                _seen[name] = h
        hashes.append(h)
    return np.array(hashes, np.uint64)[codes]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` neighbours of hashed words, by start. Not linear in the words, so no words cancel out."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_BASE) + words[i : i + n])
    return out


PRIME = (1 << 61) - 1
_POINTS = (0x0A7B3C5E91D2F486, 0x13C6EF372FE94F82)  # picked at random below the prime


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    half, rest = np.uint64(31), np.uint64((1 << 31) - 1)
    ah, al, bh, bl = a >> half, a & rest, b >> half, b & rest
    middle = al * bh + ah * bl
    carried = (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half)
    return _reduced(ah * bh * np.uint64(2) + carried + al * bl)


@lru_cache(maxsize=8)
def _prime_powers(size: int, point: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    have, step = 1, np.uint64(point)
    while have < size:
        n = min(have, size - have)
        out[have : have + n] = mulmod(out[:n], np.full(n, step))
        have += n
        step = np.uint64(int(step) * int(step) % PRIME)
    return out


class PrimeRolling:
    """Hashes of stretches of bytes or 64-bit numbers, as a polynomial modulo the prime 2^61 - 1 at one of two points.

    Two stretches of n units collide for at most n of the points. Where a hash of long stretches
    decides that they are equal, both points are used.
    """

    def __init__(self, values: np.ndarray, family: int = 0):
        point, size = _POINTS[family], 1 << max(10, int(len(values)).bit_length())
        self.up, self.down = _prime_powers(size, point), _prime_powers(size, pow(point, PRIME - 2, PRIME))
        terms = mulmod(_reduced(mix(values.astype(np.uint64) + np.uint64(1))), self.up[: len(values)])
        # Sums of up to 2^32 halves of 31 bits fit 64 bits.
        low, high = np.cumsum(terms & np.uint64((1 << 31) - 1)), _reduced(np.cumsum(terms >> np.uint64(31)))
        sums = _reduced(_reduced(low) + mulmod(high, np.full(len(high), np.uint64(1 << 31))))
        self.sums = np.concatenate((np.zeros(1, np.uint64), sums))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        difference = _reduced(self.sums[end] + np.uint64(PRIME) - self.sums[start])
        return mix(mulmod(difference, self.down[start]) + (end - start).astype(np.uint64) * np.uint64(_BASE))


class Rolling:
    """Hashes of any stretch of a sequence of bytes or of 64-bit numbers, modulo 2^64: fast, but some long stretches collide.

    For looking up candidates and counting features; equality is told by ``content_hashes``,
    ``shingles`` or ``PrimeRolling``.
    """

    def __init__(self, values: np.ndarray, family: int = 0):
        n = len(values)
        up, self.down = powers(n + 1, family)
        scrambled = _table(family)[values] if values.dtype == np.uint8 else mix(values ^ np.uint64(_BASES[family]))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(scrambled * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, q: int) -> np.ndarray:
        """Hash of each stretch of ``q``, by start."""
        n = max(0, len(self.sums) - q)
        return mix((self.sums[q:] - self.sums[:n]) * self.down[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by the first of them."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span : width - span + n])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.minimum(starts, n), 1)
    np.add.at(steps, np.minimum(ends, n), -1)
    return np.cumsum(steps[:n]) > 0


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
