"""The prefix trie of rebuilt conversations, by collapsing whole sequences.

A sequence's prefix of d turns is named by d and by running sums, over its turns, of two 60-bit
numbers cut from SHA-256 of (place, role, text); equal names stand for equal prefixes.

*Collapse.* Conversations with the same whole sequence become one weighted sequence with the
list of those that end there. A sequence that is a proper prefix of another is found by an
anti-join against the names of all proper prefixes; what is left are the leaves.

*Aggregate.* The weighted sequences' prefixes are added up to the nodes. Sums over subtrees
need no walk: a node's own value is charged to one leaf below it, and every prefix of a leaf
gets what is charged to the leaf from there on down, a running sum along the leaf. Adding up
by prefix gives the sum over the subtree, from as many rows as the leaves have turns.

Long conversations and common prefixes are split over tasks: the running sums through
``ordered_scan``, the joins through ``join_many``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.joins import join_many
from millrace.operators.ordered import Scan, ordered_scan
from millrace.operators.staging import stage

FAMILY, HEADS = 5, 9  # conversations share turns in fives; 0 to 8 of them
CHUNK = 1 << 16  # conversation ids joined at once


def _name(depth: Column, a: Column, b: Column) -> Column:
    """16 bytes for a prefix."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(":", depth, a, b).cast("binary"), 256), 1, 32))


ROOT = "unhex(repeat('0', 32))"  # no turns


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, content, n_bytes): the turns of each conversation counted from 1, contents by SHA-256.

    Ordered by turn, null first, then by role and text.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    placed = ordered_scan(turns, ["conv_id"], order, Scan(row_number="i"))
    # The length of the role keeps (ab, c) and (a, bc) apart.
    content = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    return placed.select("conv_id", "i", content.alias("content"), F.octet_length("text").cast("long").alias("n_bytes"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every rebuilt conversation with its length, its turns as (conv_id, length, pos, content, n_bytes)).

    A conversation starts with the first turns of the first one of its five, and goes on with its own.
    """
    heads = F.crc32(F.col("conv_id").cast("string")) % HEADS
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    sizes = stage(sizes, "conversation-sizes")
    given = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    shapes = sizes.join(given, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    shapes = stage(shapes, "conversation-shapes")
    shared = turns.filter(F.col("i") < HEADS).withColumnRenamed("conv_id", "base").join(shapes, "base").filter("i <= h")
    # At most 8 turns of each of at most 9 conversations (below 0, % rounds up) come from one base.
    shared = shared.select("conv_id", "length", F.col("i").alias("pos"), "content", "n_bytes")
    own = join_many(turns, shapes, "conv_id", "inner").filter("i > h")
    own = own.select("conv_id", "length", (F.col("i") - F.col("h") + F.col("taken")).alias("pos"), "content", "n_bytes")
    return shapes.select("conv_id", "length"), shared.unionByName(own)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, length, pos, key, parent, n_bytes): the name of every prefix and of the one before it."""
    digest = F.sha2(F.concat(F.concat_ws(":", "pos", F.hex("content"))).cast("binary"), 256)
    number = lambda start: F.conv(F.substring("digest", start, 15), 16, 10).cast("decimal(19,0)")
    marked = rebuilt.withColumn("digest", digest).withColumn("a", number(1)).withColumn("b", number(16)).drop("digest", "content")
    summed = ordered_scan(marked, ["conv_id"], [F.col("pos").asc()], Scan(running_sums={"sum_a": "a", "sum_b": "b"}))
    before = F.when(F.col("pos") == 1, F.expr(ROOT)).otherwise(_name(F.col("pos") - 1, F.col("sum_a") - F.col("a"), F.col("sum_b") - F.col("b")))
    return summed.select("conv_id", "length", "pos", _name(F.col("pos"), F.col("sum_a"), F.col("sum_b")).alias("key"), before.alias("parent"), "n_bytes")


def id_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of ``ends`` (key, conv_id): SHA-256 of each key's ids, ascending, joined by commas.

    Range partitions join stretches of ids into chunks; the chunks of a key stream through one task,
    which holds one of them and the state of the hash.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, done = None, 0, [], []
        for batch in batches:
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if k != key or len(ids) == CHUNK:
                    if ids:
                        done.append((key, first, ",".join(map(str, ids))))
                    key, first, ids = k, c, []
                ids.append(c)
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], names=["key", "first", "ids"])
                done = []
        if ids:
            yield pa.record_batch([pa.array([key]), pa.array([first]), pa.array([",".join(map(str, ids))])], names=["key", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], names=["key", "ends_sha256"])
                done = []
        if state:
            yield pa.record_batch([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    chunks = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = chunks.mapInArrow(joined, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the trie: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``conversations`` has (conv_id, turn, role, text). Rows without conv_id belong to no
    conversation and are left out; a null turn comes first, null roles and texts are empty.
    Turns with one number are ordered by role, then text, and repeated rows are turns of their
    own. Other columns are ignored. An empty table has no node, not even the root.
    """
    turns = stage(numbered_turns(conversations), "turns")
    shapes, rebuilt = rebuilt_turns(turns)
    paths = stage(prefixes(stage(rebuilt, "rebuilt")), "prefixes")
    # Whole sequences: the conversations that end at each key, and the smallest of them stands for all.
    ended = paths.filter("pos = length").select("key", "conv_id")
    ends = stage(ended.unionByName(shapes.filter("length = 0").select(F.expr(ROOT).alias("key"), "conv_id")), "ends")
    sequences = stage(ends.groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    proper = paths.filter("pos < length").select("key").distinct()
    leaves = sequences.filter(F.col("key") != F.expr(ROOT)).join(proper, "key", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weighted = sequences.join(leaves, "conv_id", "left").select("conv_id", "weight", F.coalesce("leaf", F.lit(0)).alias("leaf"))
    kept = stage(join_many(paths, weighted, "conv_id", "inner"), "weighted-prefixes")

    counts = [
        F.sum("weight").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"),
    ]
    nodes = stage(kept.groupBy("key", "parent", F.col("pos").alias("depth"), "n_bytes").agg(*counts), "nodes")
    charged = nodes.select(F.col("owner").alias("conv_id"), F.col("depth").alias("pos"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("own"))
    along = kept.filter("leaf = 1").select("conv_id", "pos", "key").join(charged, ["conv_id", "pos"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    below = ordered_scan(stage(along, "leaf-paths"), ["conv_id"], [F.col("pos").desc()], Scan(running_sums={"below": "own"}))
    saved = stage(below.groupBy("key").agg(F.sum("below").alias("saved_tokens")), "saved")

    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    joined = nodes.join(saved, "key").select("key", "parent", "depth", "conv_id", "n_convs", "n_leaves", "saved_tokens")
    top = shapes.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    whole = joined.filter("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    root = top.join(whole, F.lit(True)).select(  # two rows of one
        F.expr(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    everything = stage(joined.unionByName(root), "trie")
    parents = everything.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = join_many(everything, parents, "parent")
    full = named.join(children, "key", "left").join(id_digests(ends), "key", "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
