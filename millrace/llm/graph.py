"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that an edge names; a component's id is its smallest node.

    ``edges`` has two columns of one ordered type. Each round hangs every node under its
    smallest neighbour, jumps the pointers twice, and goes on with the edges between the
    roots, so the edge table shrinks geometrically. Nothing of the graph reaches the
    driver but the number of edges left. Null ends, loops and repeated edges are
    ignored; an empty table gives an empty result.
    """
    a, b = edges.columns
    left = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("v"), F.col("u")))
        parent = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "parents")
        for _ in range(2):
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = stage(parent.join(up, "p").select("u", F.col("pp").alias("p")), "parents")
        seen = parent.select(F.col("u").alias("node"), F.col("p").alias("component"))
        if labels is None:
            labels = seen
        else:
            step = parent.select(F.col("u").alias("component"), F.col("p").alias("next"))
            labels = labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        labels = stage(labels, "labels")
        roots = parent.select(F.col("u").alias("x"), F.col("p").alias("y"))
        moved = left.join(roots, F.col("u") == F.col("x")).select(F.col("y").alias("u"), "v")
        moved = moved.join(roots, F.col("v") == F.col("x")).select("u", F.col("y").alias("v"))
        left = stage(moved.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    if labels is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
