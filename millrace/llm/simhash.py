"""SimHash near-duplicates by the generalised pigeonhole principle.

*Fingerprints.* Bit b is 1 if it is set in more than half of the 64-bit hashes of a text's
shingles, repeats included. Documents with one fingerprint are one class from the start;
everything after that works on distinct fingerprints.

*Parts.* The 64 bits are dealt into parts, correlated bits into the same part, so that the
few frequent patterns of the corpus spoil as few parts as possible. With thresholds t_i that
add up to radius - parts + 1, two fingerprints within the radius agree up to t_i bits in some
part i; -1 leaves a part out. Each fingerprint gets thresholds of its own: a dynamic programme
takes those with the fewest estimated probes and candidates. The estimates come from counts of
the parts' values in a table of fixed size.

*Probes.* All fingerprints are indexed by the value of each part; each one looks up the values
within its thresholds, and what it meets is verified on all bits.

*Crowds.* A fingerprint whose best thresholds still meet more candidates than it has points
within ``radius`` of the meeting below takes that other exact way, so that no part's value
makes all pairs of a crowd: it owns every point within radius // 2 bits and visits every point
within the rest of the radius; all that are at a point are linked with its smallest owner.
Two fingerprints within the radius have such a point between them, and any owner and visitor
of a point are within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.graph import components
from millrace.llm.joins import join_many
from millrace.operators.staging import stage

BITS = 64
CELLS = 1 << 16  # counts of one part's values
BLOCK = 1 << 18  # shingles or rows in hand at once


def fingerprint_of(data: np.ndarray, offsets: np.ndarray, words: int, seed: int) -> np.ndarray:
    """The fingerprint of each text, lower-cased in A-Z; shingles have their words joined by one space."""
    solid = ~textops.SPACE[data]
    starts, ends, first = textops.words(data, offsets)
    # Every word is followed by one space, so a shingle is one stretch of bytes.
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int((lengths + 1).sum()), 32, np.uint8)
    joined[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = textops.lower_ascii(data)[solid]
    stop = at + lengths
    n_words = np.diff(first)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    owner = np.repeat(np.arange(len(n_words)), n_shingles)
    begin = np.cumsum(n_shingles) - n_shingles
    head = first[owner] + np.arange(len(owner)) - begin[owner]
    tail = np.minimum(head + words, first[owner + 1]) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    counts = np.zeros((len(n_words), BITS), np.int64)
    for k in range(0, len(owner), BLOCK):
        part = slice(k, k + BLOCK)
        cuts = zip(at[head[part]].tolist(), stop[tail[part]].tolist(), strict=True)
        hashes = np.fromiter((digest(text[a:b], seed) for a, b in cuts), np.uint64, len(owner[part]))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        heads = np.flatnonzero(np.concatenate(([True], np.diff(owner[part]) > 0)))
        counts[owner[part][heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n_shingles[:, None], axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every document; fp has the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            found = fingerprint_of(*textops.pack(piece.column("text")), words, seed)
            yield pa.record_batch([piece.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=64)
def flips(mask: int, distance: int) -> np.ndarray:
    """All patterns of exactly ``distance`` bits of ``mask``."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return np.fromiter((sum(c) for c in combinations(bits, distance)), np.uint64)


def group_bits(agreement: np.ndarray, parts: int) -> list[int]:
    """Masks of ``parts`` parts of equal widths (by one bit), each grown around the strongest correlation left."""
    strength = np.abs(agreement) * (1 - np.eye(BITS))
    left = set(range(BITS))
    masks = []
    for k in range(parts):
        width = BITS * (k + 1) // parts - BITS * k // parts
        open_bits = sorted(left)
        inner = strength[np.ix_(open_bits, open_bits)]
        part = [open_bits[int(inner.max(1).argmax())]]
        while len(part) < width:
            rest = [b for b in open_bits if b not in part]
            part.append(rest[int(strength[np.ix_(rest, part)].sum(1).argmax())])
        left -= set(part)
        masks.append(sum(1 << b for b in part))
    return masks


@dataclass(frozen=True)
class Plan:
    """Parts, and how often their values occur, in ``CELLS`` cells a part."""

    radius: int
    masks: tuple[int, ...]
    counts: np.ndarray | None = None

    @property
    def most(self) -> int:
        """The largest threshold tried for one part."""
        return max(2, -(-(self.radius + 1) // len(self.masks)) - 1)

    @property
    def crowd(self) -> int:
        """Estimated probes and candidates beyond which a fingerprint meets others at points."""
        return sum(comb(BITS, d) for d in range(self.radius - self.radius // 2 + 1))

    def cells(self, part: int, keys: np.ndarray) -> np.ndarray:
        return (textops.mix(keys + np.uint64(part + 1)) >> np.uint64(64 - 16)).astype(np.int64)

    def costs(self, fps: np.ndarray) -> np.ndarray:
        """Estimated probes and candidates of each fingerprint, by part and threshold + 1."""
        out = np.zeros((len(self.masks), self.most + 2, len(fps)))
        for i, mask in enumerate(self.masks):
            # A cell also counts values that share it by chance; their mean is taken off.
            table = np.maximum(self.counts[i] - self.counts[i].sum() / CELLS, 0)
            keys = fps & np.uint64(mask)
            for t in range(self.most + 1):
                out[i, t + 1] = out[i, t]
                for flip in flips(mask, t):
                    out[i, t + 1] += 1 + table[self.cells(i, keys ^ flip)]
        return out

    def allocate(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(thresholds by part, cost) of each fingerprint: the cheapest that add up to radius - parts + 1."""
        costs = self.costs(fps)
        total = self.radius + 1  # thresholds + 1 add up to this
        best = np.full((total + 1, len(fps)), np.inf)
        best[0] = 0
        steps = []
        for i in range(len(self.masks)):
            options = np.full((total + 1, self.most + 2, len(fps)), np.inf)
            for used in range(total + 1):
                for t in range(min(used, self.most + 1) + 1):
                    options[used, t] = best[used - t] + costs[i, t]
            steps.append(options.argmin(1))
            best = options.min(1)
        thresholds = np.zeros((len(self.masks), len(fps)), np.int64)
        used = np.full(len(fps), total)
        for i in reversed(range(len(self.masks))):
            thresholds[i] = steps[i][used, np.arange(len(fps))]
            used = used - thresholds[i]
        return thresholds - 1, best[total]


def _agreement(fps: DataFrame) -> np.ndarray:
    """Correlation of every two bits over all fingerprints. 65 rows a task are added up; the driver gets 65."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            bits = (raw[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
            bits = np.hstack((bits.astype(np.float64), np.ones((len(raw), 1))))
            sums += bits.T @ bits
        yield pa.record_batch([pa.array(np.arange(BITS + 1)), pa.array(list(sums))], names=["row", "sums"])

    cells = fps.mapInArrow(run, "row long, sums array<double>").select("row", F.posexplode("sums").alias("at", "value"))
    total = np.zeros((BITS + 1, BITS + 1))
    for r in cells.groupBy("row", "at").agg(F.sum("value").alias("value")).collect():
        total[r["row"], r["at"]] = r["value"]
    n = max(total[BITS, BITS], 1.0)
    mean = total[BITS, :BITS] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return (total[:BITS, :BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)


def make_plan(fps: DataFrame, n: int, radius: int) -> Plan:
    """Parts so wide that ``n`` random values seldom meet (two parts at least, radius + 1 at most), and their counts."""
    parts = min(max(2, BITS // (max(n, 2).bit_length() + 1)), radius + 1)
    if parts < 2:
        return Plan(radius, ((1 << BITS) - 1,), np.zeros((1, CELLS)))
    plan = Plan(radius, tuple(group_bits(_agreement(fps), parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, CELLS), np.int64)
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            for i, mask in enumerate(plan.masks):
                counts[i] += np.bincount(plan.cells(i, raw & np.uint64(mask)), minlength=CELLS)
        part, cell = np.nonzero(counts)
        yield pa.record_batch([pa.array(part), pa.array(cell), pa.array(counts[part, cell])], names=["part", "cell", "n"])

    counts = np.zeros((parts, CELLS))
    # At most parts x CELLS rows, whatever the number of fingerprints.
    summed = fps.mapInArrow(run, "part long, cell long, n long").groupBy("part", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts[summed["part"], summed["cell"]] = summed["n"]
    return Plan(radius, plan.masks, counts)


def _planned(fps: DataFrame, plan: Plan) -> DataFrame:
    """(fp, crowded, thresholds) of each fingerprint."""
    shared = fps.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            thresholds, cost = plan.allocate(raw)
            ends = np.arange(len(raw) + 1) * len(plan.masks)
            columns = [batch.column("fp"), pa.array(cost > plan.crowd), textops.lists(ends, thresholds.T.ravel())]
            yield pa.record_batch(columns, names=["fp", "crowded", "thresholds"])

    return fps.mapInArrow(run, "fp long, crowded boolean, thresholds array<long>")


def _spread(raw: np.ndarray, keys: np.ndarray, patterns: np.ndarray, label: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(label, key, fp) of every key under every pattern."""
    width = max(1, BLOCK // max(1, len(patterns)))
    for k in range(0, len(raw), width):
        found = (keys[k : k + width, None] ^ patterns[None, :]).ravel().view(np.int64)
        whose = np.repeat(raw[k : k + width], len(patterns)).view(np.int64)
        yield pa.record_batch([pa.array(np.full(len(found), label, np.int32)), pa.array(found), pa.array(whose)], names=names)


def _probes(planned: DataFrame, plan: Plan) -> DataFrame:
    """(part, key, fp): every value that a fingerprint looks up."""
    radius, masks, most = plan.radius, plan.masks, plan.most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            thresholds = batch.column("thresholds").flatten().to_numpy().reshape(-1, len(masks))
            for i, mask in enumerate(masks):
                for t in range(min(most, radius) + 1):
                    own = raw[thresholds[:, i] >= t]
                    yield from _spread(own, own & np.uint64(mask), flips(mask, t), i, ["part", "key", "fp"])

    return planned.filter("not crowded").select("fp", "thresholds").mapInArrow(run, "part int, key long, fp long")


def _meetings(crowded: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between crowded fingerprints, by the points between them."""
    near, far = radius // 2, radius - radius // 2
    everything = (1 << BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            for d in range(far + 1):
                yield from _spread(raw, raw, flips(everything, d), d, ["away", "point", "fp"])

    points = crowded.select("fp").mapInArrow(run, "away int, point long, fp long")
    owner = F.min(F.when(F.col("away") <= near, F.col("fp"))).over(Window.partitionBy("point"))
    return points.select(F.col("fp").alias("a"), owner.alias("b")).filter("a <> b").distinct()


def links(fps: DataFrame, radius: int = 3, plan: Plan | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``fps`` (fp, staged) at ``radius`` bits or fewer.

    Every pair outside crowds is there; of a crowd, enough pairs to connect what is connected.
    """
    plan = plan or make_plan(fps, fps.count(), radius)
    planned = stage(_planned(fps, plan), "thresholds")
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in plan.masks]
    values = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)])
    index = planned.select(F.col("fp").alias("b"), "crowded", F.explode(values).alias("v")).select("v.part", "v.key", "b", "crowded")
    met = _probes(planned, plan).withColumnRenamed("fp", "a").join(index, ["part", "key"])
    # Of two that both probe, the larger one reports; a crowded one never probes.
    found = met.filter((F.col("crowded") | (F.col("b") < F.col("a"))) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    found = found.filter("a <> b").select("a", "b")
    crowded = planned.filter("crowded")
    return found if crowded.isEmpty() else found.union(_meetings(crowded, radius))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document of ``docs`` (doc_id, text).

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest doc_id that links
    reach. A text of fewer words than a shingle has its whole sequence as one; null, empty
    and blank texts have fingerprint zero, and are linked like any other. Repeated documents
    stay repeated. Rows without doc_id are returned, and give no component its id (null where
    no member has one). Other columns are ignored; an empty table gives an empty result.
    """
    described = stage(fingerprints(docs, words), "fingerprints")
    classes = stage(described.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    joined = components(links(classes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    groups = stage(classes.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "fingerprint-groups")
    names = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(join_many(groups, names, "component").select("fp", "component_id"), "fingerprint-names")
    out = join_many(described, named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
