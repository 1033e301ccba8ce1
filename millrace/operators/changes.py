"""Change feeds between two versions of a table, and validity-interval reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ between two versions, with ``action``, ``is_update``, ``row_id``.

    An update gives a DELETE row holding the old values and an INSERT row holding
    the new ones, both with ``is_update`` set. Keys are unique and not NULL.
    """
    data = new.columns
    condition = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    left = old.select(*data, F.lit(True).alias("_here")).alias("o")
    right = new.select(*data, F.lit(True).alias("_here")).alias("n")
    both = left.join(right, condition, "full")

    def row(side: str):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in data])

    in_old, in_new = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    same = row("o").eqNullSafe(row("n"))
    is_update = in_old & in_new
    deleted = F.when(in_old, F.struct(F.lit("DELETE").alias("action"), is_update.alias("is_update"), row("o").alias("r")))
    inserted = F.when(in_new, F.struct(F.lit("INSERT").alias("action"), is_update.alias("is_update"), row("n").alias("r")))
    changes = both.where(~(is_update & same)).select(
        F.explode(F.filter(F.array(deleted, inserted), lambda c: c.isNotNull())).alias("c")
    )
    flat = changes.select("c.r.*", "c.action", "c.is_update")
    return flat.withColumn("row_id", F.sha1(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))


def initial_feed(table: DataFrame, keys: list[str]) -> DataFrame:
    """The feed of a stream that shows a table's initial rows: all of them as inserts."""
    row_id = F.sha1(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    return table.select(
        "*", F.lit("INSERT").alias("action"), F.lit(False).alias("is_update"), row_id.alias("row_id")
    )


def collapse_feed(feed: DataFrame) -> DataFrame:
    """One row per key: the old half of each update is dropped."""
    return feed.where(~((F.col("action") == "DELETE") & F.col("is_update")))


def last_change(feed: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One row per key: its last change by ``sequence``, for feeds that hold several of one key.

    ``is_update`` says whether the key was there before the first change of the feed, so that
    a delete and a later insert are an update. An insert that is deleted again is left as a delete
    of nothing. The old half of an update comes before the new one.
    """
    rest = [c for c in feed.columns if c not in keys]
    at = [F.col(sequence), F.col("action")]
    ends = feed.groupBy(*keys).agg(
        F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(at)])).alias("first"),
        F.max_by(F.struct(*rest), F.struct(*at)).alias("last"),
    )
    existed = F.col("first.o1") == "DELETE"
    flat = ends.select(*keys, "last.*", existed.alias("_existed"))
    return flat.withColumn("is_update", F.col("_existed") & (F.col("action") == "INSERT")).select(*feed.columns)


def as_of_read(df: DataFrame, ts) -> DataFrame:
    """Rows valid at ``ts`` in a table with ``valid_from`` / ``valid_to``."""
    return df.where((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (ts < F.col("valid_to"))))
