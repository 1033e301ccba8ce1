"""Joins with one row a key on the right, where a key may hold a third of the rows on the left."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.ordered import hot_keys, split_hot
from millrace.operators.staging import stage

MOST_HOT = 2000  # keys that can be hot: each has more than one in so many of the rows
LEAST_HOT = 1000


def join_many(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` (staged) joined to ``right``, which has one row a key, both on ``key``.

    Hot keys' rows meet a table of at most ``MOST_HOT`` rows, which is small enough to go to
    every task; so no task reads all rows of a hot key. Null keys match nothing.
    """
    hot = hot_keys(left.filter(left[key].isNotNull()), [key], max(LEAST_HOT, left.count() // MOST_HOT))
    if hot is None:
        return left.join(right, key, how)
    common = stage(right.join(hot, key, "left_semi"), "hot-rows")
    ordinary, huge = split_hot(left, hot, [key])
    return ordinary.join(right, key, how).unionByName(huge.join(common, key, how))
