"""Set-similarity join on word shingles, by vertical partitioning of the shingle order.

Shingles are ordered by a 64-bit hash, and this one global order is cut into fragments.

*Candidates.* Two sets with Jaccard similarity of at least t differ in at most
``D = (1-t)/(1+t) * (|x|+|y|)`` shingles. If the order is cut into more than ``D``
fragments, one fragment holds the same shingles in both. So each set signs every
fragment with a hash of the shingles it has there, and sets meet only where a whole
fragment agrees. The number of fragments depends on the size class of the smaller set;
a set signs for its own class and for the one below. Equal sets are one class from the start.
A shingle that very many documents share makes candidates only of those that have a fragment
to themselves with it.

*Sketches.* A common passage has fragments to itself, so documents that share no more than it
meet too. Of the sets that meet, *parity sketches* are compared, a bit a shingle or so. Every
difference of two sets flips one bit of the sketch, so two sketches that differ in more bits than
the rule allows differences rule the pair out, and no linked pair is lost. Only links that sketches
allow make clusters; those of all meetings would join a share of the table that grows with it.

*Verification.* Candidates form clusters. In a cluster, the order is cut into blocks of
shingles; a matrix product counts the overlap of each block by itself, and the sum over
blocks is the exact overlap. In a cluster larger than a tile, each set is first compared with
the smallest set it meets, which makes components; then the sketches are compared by pairs
of tiles, between sets of different components. Of the pairs left, the overlap is counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.graph import components
from millrace.llm.joins import join_many
from millrace.operators.staging import stage

TILE = 1500  # sets or sketches compared at once; any two of a cluster meet in some pair of tiles
SEEDS = 8


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words, and the least similarity as a fraction."""

    words: int = 5
    num: int = 4
    den: int = 5

    def linked(self, overlap: np.ndarray, union: np.ndarray) -> np.ndarray:
        return self.den * overlap >= self.num * union


@lru_cache(maxsize=4)
def size_classes(rule: Similarity, largest: int) -> np.ndarray:
    """Lower bounds of the size classes: partners are in the same class or in neighbours."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * rule.den // rule.num + 1))
    return np.array(bounds)


@lru_cache(maxsize=4096)
def fragments(rule: Similarity, low: int, high: int) -> tuple[int, int]:
    """(number of fragments, most empty ones) where the smaller set has ``low <= size < high`` shingles.

    With the first number of fragments and at most that many empty ones, a partner
    agrees in a fragment that is not empty. (0, 0): partners are equal sets.
    """
    both = high - 1 + (high - 1) * rule.den // rule.num
    differences = both * (rule.den - rule.num) // (rule.den + rule.num)
    if differences == 0:
        return 0, 0
    slack = 2
    while True:
        m = differences + 1 + slack
        empty = m * np.exp(-low / m)
        if slack >= empty + 3 * np.sqrt(empty) or slack > low:
            return m, slack
        slack += 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, lower-cased in A-Z.

    A text with fewer than ``k`` words has its whole sequence as one shingle; one
    without words has none.
    """
    data = textops.lower_ascii(data)
    starts, ends, first = textops.words(data, offsets)
    hashes = textops.content_hashes(data, starts, ends)
    grams = textops.shingles(hashes, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(textops.shingles(hashes[a:b], int(b - a)) if b > a else grams[:0])
    return out


def signatures(tokens: np.ndarray, rule: Similarity) -> np.ndarray:
    """Signature of every fragment that must be compared."""
    n = len(tokens)
    bounds = size_classes(rule, max(1 << 10, 1 << n.bit_length()))
    own = int(np.searchsorted(bounds, n, "right")) - 1
    out = []
    for c in (own, own - 1):
        if c < 0:
            continue
        m, spare = fragments(rule, int(bounds[c]), int(bounds[c + 1]))
        if not m:
            continue
        for seed in range(SEEDS):
            place = tokens if seed == 0 else np.sort(textops.mix(tokens + np.uint64(seed)))
            cells = ((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            heads = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            sums = np.add.reduceat(textops.mix(place), heads)
            label = np.uint64((c * SEEDS + seed) << 32) + cells[heads]
            out.append(textops.mix(sums ^ textops.mix(label)))
            if m - len(heads) <= spare:
                break
        else:
            # The last resort keeps the guarantee: fragments that are empty in both sets count as equal.
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), cells[heads])
            out.append(textops.mix(textops.mix(empty + np.uint64((c * SEEDS + SEEDS) << 32))))
    return np.concatenate(out) if out else tokens[:0]


def describe(docs: DataFrame, rule: Similarity) -> DataFrame:
    """(doc_id, n_shingles, set_hash, sketch) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            sets = shingle_sets(*textops.pack(piece.column("text")), rule.words)
            hashes = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            sketches = pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.binary())
            columns = [piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), hashes, sketches]
            yield pa.record_batch(columns, names=["doc_id", "n_shingles", "set_hash", "sketch"])
        textops.release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, sketch binary")


def meetings(docs: DataFrame, rule: Similarity) -> DataFrame:
    """(met): the documents that share a signature, as a sorted list; each list once.

    Signatures are not kept: they are shuffled once. Copies in one slice sign once. Documents
    that share many signatures, as near copies do, make few different lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            sets = shingle_sets(*textops.pack(piece.column("text")), rule.words)
            ids = piece.column("doc_id").to_numpy()
            first = {s.tobytes(): k for k, s in reversed(list(enumerate(sets))) if len(s)}
            signing = sorted(first.values())
            own = [signatures(sets[k], rule) for k in signing]
            sig = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.record_batch([pa.array(sig.view(np.int64)), pa.array(np.repeat(ids[signing], [len(s) for s in own]))], names=["sig", "doc_id"])
        textops.release()

    rows = docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "sig long, doc_id long")
    # Most signatures are those of one document; they go before anything is collected.
    same = Window.partitionBy("sig")
    shared = rows.withColumns({"least": F.min("doc_id").over(same), "most": F.max("doc_id").over(same)}).filter("least < most")
    return shared.groupBy("sig").agg(F.array_sort(F.collect_set("doc_id")).alias("met")).select("met").distinct()


def candidates(met: DataFrame, of: DataFrame, described: DataFrame, rule: Similarity) -> DataFrame:
    """(doc_id, hub): links between classes that make components of all pairs that meet and whose sketches allow a link.

    Documents that share a common passage meet although they are far apart, and a chain of such
    meetings would join most of a large table. So sketches are compared among those that meet, in
    each list by itself, and a list sends on a row a document at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("set")
            cuts, flat = lists.offsets.to_numpy(), lists.values
            ids, sizes, sketches = flat.field("doc_id").to_numpy(), flat.field("n").to_numpy(), flat.field("sketch").to_pylist()
            found = [sketch_stars(ids[a:b], sizes[a:b], sketches[a:b], rule) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["doc_id", "hub"])

    # Two lists under one hash would only be compared with each other too.
    rows = met.select(F.xxhash64("met").alias("list"), F.explode("met").alias("doc_id")).join(of, "doc_id")
    rows = rows.select("list", F.col("class_id").alias("doc_id")).distinct()
    lists = rows.groupBy("list").count().filter("count > 1").select("list")
    known = described.select("doc_id", F.col("n_shingles").alias("n"), "sketch").distinct()
    sets = rows.join(lists, "list", "left_semi").join(known, "doc_id").groupBy("list").agg(F.collect_list(F.struct("doc_id", "n", "sketch")).alias("set"))
    return sets.select("set").mapInArrow(run, "doc_id long, hub long").distinct()


def allowed(sizes: np.ndarray, others: np.ndarray, differ: np.ndarray, rule: Similarity) -> np.ndarray:
    """Whether sets of these sizes may be linked if they differ in so many shingles at least."""
    smaller, larger = np.minimum(sizes, others), np.maximum(sizes, others)
    return ((rule.den + rule.num) * differ <= (rule.den - rule.num) * (sizes + others)) & (rule.den * smaller >= rule.num * larger)


def sketch_stars(ids: np.ndarray, sizes: np.ndarray, sketches: list[bytes], rule: Similarity) -> np.ndarray:
    """Rows (id, smallest id) of the components that links allowed by sizes and sketches make."""
    width = min(map(len, sketches)) // 8
    folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width), axis=0) for s in sketches])
    rest, found = np.argsort(ids, kind="stable"), []
    while len(rest) > 1:
        root, front, rest = rest[0], [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            differ = np.bitwise_count(folded[rest] ^ folded[x]).sum(1, dtype=np.int64)
            near = allowed(sizes[rest], sizes[x], differ, rule)
            if near.any():
                joined, rest = rest[near], rest[~near]
                front.extend(joined.tolist())
                found.append(np.stack((ids[joined], np.full(len(joined), ids[root])), 1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def linked_groups(sets: list[np.ndarray], ids: np.ndarray, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) for the sets linked with another, by exact overlaps.

    The shingles that two or more sets have are taken in blocks of the global order;
    each block's overlaps are one matrix product, added up over the blocks.
    """
    n = len(sets)
    if n < 2:
        return ids[:0], ids[:0]
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column) >= 2
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    overlap = np.zeros((n, n), np.float32)  # whole numbers below 2^24
    width = 2048
    cuts = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + 1 + width, width))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            block = np.zeros((n, int(column[b - 1] - column[a]) + 1), np.float32)
            block[owner[a:b], column[a:b] - column[a]] = 1
            overlap += block @ block.T
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, np.array([i])
        while len(front):
            near = np.zeros(n, bool)
            for part in np.array_split(front, -(-len(front) // 64)):
                union = sizes[part, None] + sizes[None, :] - overlap[part]
                near |= rule.linked(overlap[part].astype(np.int64), union.astype(np.int64)).any(0)
            front = np.flatnonzero(near & (root < 0))
            root[front] = i
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    most = least[root]
    moved = most != ids
    return ids[moved], most[moved]


def _sets_of(docs: DataFrame, wanted: DataFrame, rule: Similarity) -> DataFrame:
    """``wanted`` (doc_id and more) with the shingle hashes as bytes."""
    names = [c for c in wanted.columns if c != "doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            sets = shingle_sets(*textops.pack(piece.column("text")), rule.words)
            columns = [piece.column("doc_id"), *(piece.column(c) for c in names), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", *names, "tokens"])
        textops.release()

    kinds = ", ".join(f"{c} {t}" for c, t in wanted.dtypes if c != "doc_id")
    return docs.select("doc_id", "text").join(wanted, "doc_id").mapInArrow(run, f"doc_id long, {kinds}, tokens binary")


def _group_links(rule: Similarity):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(b, np.uint64) for b in rows["tokens"]]
        a, b = linked_groups(sets, rows["doc_id"].to_numpy(), rule)
        return pd.DataFrame({"a": a, "b": b})

    return run


def _hub_links(members: DataFrame, hubs: DataFrame, rule: Similarity, lanes: int = 64) -> DataFrame:
    """Links between sets and the smallest set each met; a hub of many is repeated in several lanes."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for hub in right.itertuples():
            tokens = np.frombuffer(hub.tokens, np.uint64)
            for row in left.itertuples():
                own = np.frombuffer(row.tokens, np.uint64)
                overlap = len(np.intersect1d(tokens, own, assume_unique=True))
                if rule.linked(np.int64(overlap), np.int64(len(tokens) + len(own) - overlap)):
                    found.append((row.doc_id, hub.doc_id))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    lane = F.pmod(F.xxhash64("doc_id"), F.lit(lanes))
    left = members.withColumn("lane", lane)
    used = left.select(F.col("hub").alias("h"), F.col("lane").alias("l")).distinct()
    right = used.join(hubs.select(F.col("doc_id").alias("h"), F.col("tokens").alias("t")), "h")
    right = right.select(F.col("h").alias("doc_id"), F.col("t").alias("tokens"), F.col("h").alias("at"), F.col("l").alias("at_lane"))
    return left.groupBy("hub", "lane").cogroup(right.groupBy("at", "at_lane")).applyInPandas(run, "a long, b long")


def jaccard_components(docs: DataFrame, rule: Similarity) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every document of ``docs`` (doc_id, text).

    ``class_id`` is the smallest document with the same set, ``component_id`` the
    smallest one that links reach. A null or empty text has no shingles, and is a
    component of its own; repeated documents share their class. ``docs`` may have
    more columns, which are ignored. An empty table gives an empty result.
    """
    described = stage(describe(docs, rule), "sets")
    # The representatives of equal sets; sets without shingles are linked with nothing.
    classes = stage(described.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("class_id")), "representatives")
    own = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    members = stage(join_many(described.drop("sketch"), classes, "set_hash").select("doc_id", "n_shingles", own.alias("class_id")), "classes")
    # Copies meet where their class does.
    of = members.filter("n_shingles > 0").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    met = stage(meetings(docs, rule), "meetings")
    star = stage(candidates(met, of, described, rule), "stars")
    clusters = components(star)
    sizes = clusters.groupBy("component").count()
    clusters = stage(clusters.join(sizes, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), F.col("count").alias("size")), "clusters")
    held = stage(_sets_of(docs, clusters, rule), "candidate-sets")
    small = held.filter(F.col("size") <= TILE).groupBy("cluster").applyInPandas(_group_links(rule), "a long, b long")
    links = stage(small.union(_large_clusters(held.filter(F.col("size") > TILE), star, rule)), "links")
    joined = components(links)
    final = joined.select(F.col("node").alias("class_id"), F.col("component"))
    return members.join(final, "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))


def _large_clusters(held: DataFrame, star: DataFrame, rule: Similarity) -> DataFrame:
    """Links (a, b) within clusters larger than a tile; enough of them to connect every component."""
    if held.isEmpty():
        return held.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    nearest = star.groupBy("doc_id").agg(F.min("hub").alias("hub"))
    first = stage(_hub_links(held.select("doc_id", "tokens").join(nearest, "doc_id"), held.select("doc_id", "tokens"), rule), "hub-links")
    known = components(first).select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    parts = held.select("doc_id", "cluster").join(known, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    counts = parts.groupBy("cluster", "part").count()
    # A component larger than a tile gets tiles of its own; the others share the rest.
    parts = parts.join(counts, ["cluster", "part"]).select("doc_id", "cluster", "part", F.when(F.col("count") > TILE, F.col("part")).otherwise(F.lit(-1)).alias("lane"))
    lanes = parts.groupBy("cluster", "lane").agg(F.ceil(F.count("*") / F.lit(TILE)).alias("tiles"))
    # Sketches only: a set is sent once a pair of tiles, so it must be small.
    tiles = lanes.select("cluster", "lane", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    x = tiles.select("cluster", F.struct("lane", "tile").alias("x"))
    y = tiles.select("cluster", F.struct("lane", "tile").alias("y"))
    # Two tiles of one known component need no comparison; tiles of the rest always do.
    pairs = x.join(y, "cluster").filter("x <= y").filter("x.lane <> y.lane or x.lane = -1").withColumn("pair", F.struct("x", "y"))
    sides = pairs.select("cluster", "pair", F.explode(F.array_distinct(F.array("x", "y"))).alias("at"))
    sides = sides.select("cluster", "pair", F.col("at.lane").alias("lane"), F.col("at.tile").alias("tile"))
    placed = parts.join(lanes, ["cluster", "lane"]).withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")))
    placed = stage(placed.join(_sketches(held), "doc_id"), "sketches")
    work = placed.join(sides, ["cluster", "lane", "tile"]).select("cluster", "pair", "doc_id", "part", "n", "sketch")
    near = stage(work.groupBy("cluster", "pair").applyInPandas(_near_sketches(rule), "a long, b long").distinct(), "near-sketches")
    return first.union(_verified(near, held, rule))


def parity_sketch(tokens: np.ndarray) -> bytes:
    """As many bits as there are tokens, up to the next power of two, each the parity of the tokens that fall on it."""
    size = 1 << max(9, (len(tokens) - 1).bit_length())
    parity = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def near_sketches(sizes: np.ndarray, sketches: list[bytes], part: np.ndarray, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all sets of different parts whose sizes and sketches allow a link."""
    words = np.array([len(s) // 8 for s in sketches])
    left, right = [], []
    for width in np.unique(words).tolist():
        # A linked set is at most 1 / similarity as large, so its sketch is as long or the next longer ones.
        own, other = np.flatnonzero(words == width), np.flatnonzero(words >= width)
        folded = np.zeros((len(other), width), np.uint64)
        for k, i in enumerate(other.tolist()):
            folded[k] = np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, width), axis=0)
        place = np.searchsorted(other, own)
        step = max(1, (1 << 21) // max(1, folded.size))
        for k in range(0, len(own), step):
            rows = own[k : k + step]
            differ = np.zeros((len(rows), len(other)), np.int64)
            for w in range(width):
                differ += np.bitwise_count(folded[place[k : k + step], w][:, None] ^ folded[None, :, w])
            good = allowed(sizes[rows][:, None], sizes[other][None, :], differ, rule)
            good &= part[rows][:, None] != part[other][None, :]
            i, j = np.nonzero(good)
            left.append(rows[i])
            right.append(other[j])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    pairs = np.unique(np.stack((np.maximum(i, j), np.minimum(i, j))), axis=1)
    return pairs[0], pairs[1]


def _sketches(held: DataFrame) -> DataFrame:
    """(doc_id, n, sketch) of the sets of ``held``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in batch.column("tokens")]
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity_sketch(s) for s in sets], pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "n", "sketch"])

    return held.select("doc_id", "tokens").mapInArrow(run, "doc_id long, n long, sketch binary")


def _near_sketches(rule: Similarity):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = near_sketches(rows["n"].to_numpy(), rows["sketch"].tolist(), rows["part"].to_numpy(), rule)
        ids = rows["doc_id"].to_numpy()
        return pd.DataFrame({"a": np.maximum(ids[i], ids[j]), "b": np.minimum(ids[i], ids[j])})

    return run


def _verified(pairs: DataFrame, held: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) whose overlap, counted whole, links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(rule.linked(np.int64(overlap), np.int64(len(x) + len(y) - overlap))))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    both = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x")), "a")
    both = both.join(held.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
