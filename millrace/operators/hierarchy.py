"""Level-by-level walk over parent links (the recursive-CTE jobs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.staging import stage


def walk(anchor: DataFrame, step: Callable[[DataFrame], DataFrame], max_depth: int) -> DataFrame:
    """UNION ALL of ``anchor`` and repeated ``step(previous level)``.

    Each level is written before the next reads it, so the plan does not grow with
    the depth and no level is computed twice. Stops at the first empty level or
    after ``max_depth`` steps.
    """
    level = stage(anchor, "level")
    result = level
    for _ in range(max_depth):
        level = stage(step(level).select(*anchor.columns), "level")
        if level.isEmpty():
            break
        result = result.unionByName(level)
    return result


def category_tree(nodes: DataFrame, max_depth: int = 8) -> DataFrame:
    """Every category with its depth and its path from the root."""
    roots = nodes.where(F.col("parent_id").isNull()).select(
        "category_id", "parent_id", "name", F.lit(0).alias("depth"), F.col("name").alias("path")
    )
    links = nodes.select(
        F.col("category_id").alias("c_id"), F.col("parent_id").alias("c_parent"), F.col("name").alias("c_name")
    )

    def children(level: DataFrame) -> DataFrame:
        below = level.where(F.col("depth") < max_depth)
        return below.join(links, F.col("category_id") == F.col("c_parent")).select(
            F.col("c_id").alias("category_id"),
            F.col("c_parent").alias("parent_id"),
            F.col("c_name").alias("name"),
            (F.col("depth") + 1).alias("depth"),
            F.concat_ws(" > ", "path", "c_name").alias("path"),
        )

    return walk(roots, children, max_depth)
